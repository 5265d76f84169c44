"""Keep the results of a stream as files: one folder per batch, the newest row of a key counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paylake.session import settings

#: Parts of a new stream's state, per core.
STATE_PARTS = 2


def start_updates(results: DataFrame, path: str, checkpoint: str, mode: str = "update", drain: bool = False) -> StreamingQuery:
    """Store every batch of results in a folder of its own. A batch that runs again replaces its own folder.

    `drain` takes what is available and ends; otherwise the query goes on. Every batch commits every part of the state, with or
    without rows for it, so a new stream has as many parts as the cores need, and no more than shuffles have. A stream that goes
    on from its checkpoint keeps the parts it began with.
    """
    spark, parts = results.sparkSession, "spark.sql.shuffle.partitions"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    stream = results.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    with settings(spark, {parts: str(min(int(spark.conf.get(parts)), STATE_PARTS * spark.sparkContext.defaultParallelism))}):
        return (stream.trigger(availableNow=True) if drain else stream).start()


def store_updates(updates: DataFrame, path: str, checkpoint: str, mode: str = "update") -> None:
    start_updates(updates, path, checkpoint, mode, drain=True).awaitTermination()


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key. Batches are numbers, whatever partition values are read as: 10 comes after 9."""
    stored = spark.read.parquet(path)
    values = [name for name in stored.columns if name not in (*keys, "batch")]
    newest = F.max_by(F.struct(*values), F.col("batch").cast("bigint")).alias("newest")
    return stored.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def appended(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a stream that only appends."""
    return spark.read.parquet(path).drop("batch")
