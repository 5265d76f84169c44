"""Counts and rates over event time. Event tables have a TIMESTAMP_NTZ column `ts`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts_by(events: DataFrame, *labels: str) -> DataFrame:
    return events.groupBy(*labels).agg(F.count(F.lit(1)).alias("n"))


def _tumbling(ts: Column, seconds: int) -> Column:
    """Start of the window a time is in. Native windows on a whole number of seconds start at the epoch."""
    return F.window(ts, f"{seconds} seconds")["start"]


def trailing_rate(events: DataFrame, labels: Sequence[str] = (), step: int = 30, width: int = 60) -> DataFrame:
    """Events per second in the trailing `width` seconds, every `step` seconds: `window_end, [labels], rate`.

    Events are first counted per step, map-side, and only these counts are copied into the windows that cover
    them; a native sliding window would copy every event. `width` must be a multiple of `step`.
    """
    if width % step:
        raise ValueError("width must be a multiple of step")
    per_step = events.groupBy(_tumbling(F.col("ts"), step).alias("start"), *labels).agg(F.count(F.lit(1)).alias("n"))
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(width // step)), lambda i: F.timestamp_add("SECOND", i * step, F.col("start"))
    )
    return (
        per_step.select(F.explode(ends).alias("window_end"), *labels, "n")
        .groupBy("window_end", *labels)
        .agg((F.sum("n") / float(width)).alias("rate"))
    )


def per_minute(events: DataFrame, labels: Sequence[str] = ()) -> DataFrame:
    """Events in each minute: `minute, [labels], n`."""
    return events.groupBy(_tumbling(F.col("ts"), 60).alias("minute"), *labels).agg(F.count(F.lit(1)).alias("n"))


def cumulative(events: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Running total per label set at the end of each minute with events: `minute, [labels], total`.

    The ordered rows are minutes of the calendar, not events: half a million a year for a label set.
    """
    so_far = Window.partitionBy(*labels).orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    return per_minute(events, labels).select("minute", *labels, F.sum("n").over(so_far).alias("total"))
