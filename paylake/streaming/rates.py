"""Live counts and rates: the streaming form of `operators.metrics`.

A watermark needs an instant, so event times are read as UTC, and window bounds are given back without a zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Events later than this no longer change a window.
LATENESS = "10 minutes"


def _counted(events: DataFrame, labels: Sequence[str], lateness: str, *window: str) -> DataFrame:
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    return timed.groupBy(F.window("ts", *window).alias("w"), *labels).agg(F.count(F.lit(1)).alias("n"))


def _bound(name: str) -> Column:
    return F.col(f"w.{name}").cast("timestamp_ntz")


def live_rates(
    events: DataFrame, labels: Sequence[str] = (), step: int = 30, width: int = 60, lateness: str = LATENESS
) -> DataFrame:
    """Events per second over sliding windows, kept until the watermark passes them."""
    counted = _counted(events, labels, lateness, f"{width} seconds", f"{step} seconds")
    return counted.select(_bound("end").alias("window_end"), *labels, (F.col("n") / float(width)).alias("rate"))


def live_counts(events: DataFrame, labels: Sequence[str] = (), lateness: str = LATENESS) -> DataFrame:
    """Events per minute."""
    return _counted(events, labels, lateness, "60 seconds").select(_bound("start").alias("minute"), *labels, "n")
