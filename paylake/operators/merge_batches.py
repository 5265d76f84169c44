"""Merge the small batch folders of a raw layer's closed hours, one folder per source and hour.

A stream adds a folder per source, hour and batch. The merge reads the folders of hours that are over, writes their rows once
more into one folder each, and publishes that as a swap (`sources.swaps`): readers see all of a day's old folders or all of its
new ones. What is replaced stays on disk until `clean_merged`, so readers that began before the swap can end.

Only folders at rest are merged: those whose newest file is older than `settle`. A batch that comes later is merged next time,
together with the folder merged before. The driver holds one entry per replaced folder, as the listing of the layer does.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paylake.schemas import DAY_PARTS, HOUR_PARTS, RAW
from paylake.sources.layers import Days, gathered, scan_raw_batches
from paylake.sources.swaps import BATCH, MERGED, Swap, file_system, folder_of, is_visible, keep_hidden, key_of, place_key, publish, read_swaps

SETTLE = timedelta(hours=1)
#: How long a reader may take that began before a swap.
RETAIN = timedelta(days=1)


def stored_batches(rows: DataFrame) -> DataFrame:
    """One row per batch folder: `source, year, month, day, hr, batch, files, rows, bytes, newest`. Reads no columns."""
    files = rows.groupBy("source", *HOUR_PARTS, BATCH, F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("_metadata.file_size").alias("bytes"),
        F.max("_metadata.file_modification_time").alias("newest"),
    )
    return files.groupBy("source", *HOUR_PARTS, BATCH).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.max("newest").alias("newest")
    )


def _utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def merge_batches(spark: SparkSession, root: str, window: Days, now: datetime | None = None, settle: timedelta = SETTLE) -> dict[str, int]:
    """Merge the hours of a window that ended before `now - settle` (UTC). Returns hours merged, folders replaced, and rows.

    Hours with a single folder stay as they are, so a second run over the same hours does nothing. An hour that holds no rows
    has no folder. Rows are written without change, repeated ones included; if another number of them than was listed comes
    out, nothing is published. A run that fails leaves folders that nobody sees.
    """
    limit = (now or _utc_now()) - settle
    swaps = read_swaps(spark, root, window.day_folders())
    layer = scan_raw_batches(spark, root, window)
    ended = F.to_timestamp_ntz(F.concat_ws(" ", *HOUR_PARTS), F.lit("yyyy MM dd HH")) + F.expr("INTERVAL '1' HOUR") <= F.lit(limit).cast("timestamp_ntz")
    batches = stored_batches(layer.filter(is_visible(swaps) & ended))
    resting = batches.filter(F.col("newest").cast("timestamp_ntz") <= F.lit(limit).cast("timestamp_ntz"))
    many = resting.groupBy("source", *HOUR_PARTS).agg(F.collect_list(BATCH).alias("batches"), F.sum("rows").alias("rows")).filter("size(batches) > 1")
    hours = many.collect()  # an entry per folder to replace
    if not hours:
        return {"hours": 0, "folders": 0, "rows": 0}

    replaced = defaultdict(list)
    for hour in hours:
        replaced[hour.year, hour.month, hour.day] += [(hour.source, hour.hr, batch) for batch in sorted(hour.batches)]
    name, seen = f"{MERGED}{uuid.uuid4().hex}", Observation()
    keys = [key_of(day, place) for day, places in replaced.items() for place in places]
    rows = layer.filter(place_key().isin(keys)).select(*RAW.names)
    parts = ["source", *HOUR_PARTS]
    told = gathered(rows, parts).withColumn(BATCH, F.lit(name)).observe(seen, F.count(F.lit(1)).alias("rows"))
    told.write.mode("append").partitionBy(*parts, BATCH).parquet(root)
    expected = sum(hour.rows for hour in hours)
    if seen.get["rows"] != expected:
        raise RuntimeError(f"{seen.get['rows']} rows written of {expected}; nothing was replaced")

    for day, places in sorted(replaced.items()):
        last = max((swap.number for swap in swaps if swap.day == day), default=0)
        publish(spark, root, Swap(day, last + 1, name, places))
    return {"hours": len(hours), "folders": len(keys), "rows": expected}


def clean_merged(spark: SparkSession, root: str, window: Days, now: datetime | None = None, retain: timedelta = RETAIN) -> int:
    """Remove folders that were replaced before `now - retain`, and what failed merges left before then. Returns how many."""
    limit = (now or _utc_now()) - retain
    swaps = read_swaps(spark, root, window.day_folders())
    gone = 0

    def remove(day: tuple[str, str, str], place: tuple[str, str, str]) -> None:
        nonlocal gone
        path, files = file_system(spark, folder_of(spark, root, day, place))
        gone += files.delete(path, True)

    for swap in swaps:
        if not swap.kept and swap.at <= limit:
            for place in swap.hidden:
                remove(swap.day, place)
            keep_hidden(spark, root, swap)
    published = {(swap.day, swap.published) for swap in swaps}
    left = stored_batches(scan_raw_batches(spark, root, window).filter(F.col(BATCH).startswith(MERGED)))
    old = left.filter(F.col("newest").cast("timestamp_ntz") <= F.lit(limit).cast("timestamp_ntz"))
    for row in old.select(*DAY_PARTS, "source", "hr", BATCH).collect():  # at most one per hour and failed or published merge
        day = (row.year, row.month, row.day)
        if (day, row.batch) not in published:
            remove(day, (row.source, row.hr, row.batch))
    return gone
