"""Stream messages into the raw layer, and refused messages into a folder of their own.

One query takes the source in batches. A batch is not kept, however large: one pass stores what is accepted and counts, and
only a batch with refused messages is read again to set those aside, each into folders that carry the batch's name: a batch
that runs again after a crash replaces its own folders, so every message is stored once. No log of files is kept; readers list
the folders of their window. Nothing is shuffled, and a task of up to `OPEN_HOURS` hours sorts nothing either: it holds one
small row group per hour. `operators.merge_batches` merges the folders of hours that are over.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paylake.operators.envelope import count_outcomes, read_envelopes, rejected_rows, valid_rows
from paylake.schemas import HOUR_PARTS
from paylake.sources.layers import BATCH, OPEN_HOURS, ROW_GROUP_BYTES, replace_parts
from paylake.sources.streams import POLL


class Outcomes:
    """Messages accepted and refused in all batches a query has finished here; a repeated batch counts once."""

    def __init__(self) -> None:
        self.accepted = self.refused = 0
        self._last = -1

    def add(self, batch_id: int, counted: dict) -> None:
        if batch_id > self._last:
            self._last = batch_id
            self.accepted += counted["accepted"]
            self.refused += counted["refused"]

    def totals(self) -> dict[str, int]:
        return {"accepted": self.accepted, "refused": self.refused}


def _store(messages: DataFrame, batch: str, raw_root: str, rejects_root: str) -> dict:
    # The session of a batch is the stream's own, so nothing else is written that way.
    messages.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_HOURS))
    counts, envelopes = Observation(), read_envelopes(messages)
    accepted = valid_rows(count_outcomes(envelopes, counts)).withColumn(BATCH, F.lit(batch))
    replace_parts(accepted, raw_root, ["source", *HOUR_PARTS, BATCH], **{"parquet.block.size": ROW_GROUP_BYTES})
    counted = counts.get
    refused = rejected_rows(envelopes) if counted["refused"] else rejected_rows(envelopes).limit(0)
    replace_parts(refused.withColumn(BATCH, F.lit(batch)), rejects_root, [BATCH, "reason"])
    return counted


def start_ingest(
    messages: DataFrame, raw_root: str, rejects_root: str, checkpoints: str, drain: bool = False, counted: Outcomes | None = None
) -> StreamingQuery:
    """Start the query; `drain` takes what is available and ends. Finished batches are added to `counted`."""
    counted = counted or Outcomes()
    # Streams that share a layer differ in their checkpoints, and so do the names of their batches.
    stream = hashlib.sha256(checkpoints.encode()).hexdigest()[:12]

    def store(batch: DataFrame, batch_id: int) -> None:
        counted.add(batch_id, _store(batch, f"{stream}-{batch_id}", raw_root, rejects_root))

    trigger = {"availableNow": True} if drain else {"processingTime": POLL}
    return messages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoints).trigger(**trigger).start()


def drain_ingest(messages: DataFrame, raw_root: str, rejects_root: str, checkpoints: str) -> dict[str, int]:
    """Take what is available and return what was counted."""
    counted = Outcomes()
    start_ingest(messages, raw_root, rejects_root, checkpoints, True, counted).awaitTermination()
    return counted.totals()
