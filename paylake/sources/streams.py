"""Message streams and sinks. Every source yields at least `value`.

The Kafka reader and writer need the Kafka connector on the cluster's class path; it is not part of this
environment, so those two functions are untested. The file source has the same shape.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from paylake.schemas import MESSAGE

# By default a batch starts at this many messages, or this long after the last one.
BATCH_MESSAGES = 1000
BATCH_DELAY = "180s"
POLL = "5 seconds"


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    smallest_batch: int = BATCH_MESSAGES,
    longest_wait: str = BATCH_DELAY,
    largest_batch: int | None = None,
) -> DataFrame:
    """Messages of several topics from the earliest on.

    A busy topic wants a larger `smallest_batch`, as every batch writes files; `largest_batch` cuts a backlog.
    """
    reader = spark.readStream.format("kafka")
    if largest_batch:
        reader = reader.option("maxOffsetsPerTrigger", largest_batch)
    return (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("minOffsetsPerTrigger", smallest_batch)
        .option("maxTriggerDelay", longest_wait)
        .load()
    )


def send_to_kafka(keyed: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Send `key, value` rows; a stream needs a checkpoint folder and returns its query."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if keyed.isStreaming:
        return keyed.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()
    return keyed.write.format("kafka").options(**options).save()


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages from a folder of text files, one message a line."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def table_rows(spark: SparkSession, path: str) -> DataFrame:
    """A stored Parquet table, a file or a folder, read as a stream, whole and once."""
    # A stream takes a plain path for a folder; a pattern may also name a file.
    pattern = re.sub(r"([^/])([^/]*)\Z", r"[\1]\2", path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(pattern)
