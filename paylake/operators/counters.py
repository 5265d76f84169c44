"""Rates of counters that restart with the process that counts.

A counter only grows until its process restarts, and then starts from zero. Samples of it are rows of labels (they name the
series), a time `ts` and a `value`. A value below the one before it tells of a restart, and counts as a whole.

Samples are ordered within slices of time only, so a series that holds a third of all samples is ordered by many tasks. What a
slice hands on is one row: its ends, its count and its gain. The last value of the slice before it is found among the slices of
a day, and for the first slice of a day among the days. Sliding windows are put together from slices, not from samples.

Rows without a time or a value are no samples. Of samples of one series and time the largest value stays. Null is a label like
any other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: beyond this many mean distances between samples, a series is taken to begin or end inside the window.
FAR = 1.1


def _micros(seconds: int) -> Column:
    return F.lit(seconds * 1_000_000).cast("bigint")


def _gain(value: Column, before: Column) -> Column:
    """What a sample adds to the one before it; null for the first of a series."""
    return F.when(before.isNull(), None).when(value >= before, value - before).otherwise(value)


def counter_slices(samples: DataFrame, labels: Sequence[str], step: int) -> DataFrame:
    """One row per series and slice of `step` seconds with samples; a slice holds its end and not its start.

    Times are microseconds: `[labels], slice (its end), n, first_at, first_value, last_at, last_value, lead, inner, restarts`.
    `lead` is the gain of the first sample over the slice before, null at the start of a series; `inner` that of the others;
    `restarts` counts values that fell, the first one's included.
    """
    if step <= 0:
        raise ValueError("step must be positive")
    width = _micros(step)
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = samples.filter("ts IS NOT NULL AND value IS NOT NULL").select(
        *labels, (at + F.pmod(-at, width)).alias("slice"), at.alias("at"), "value"
    )
    once = ends.groupBy(*labels, "slice", "at").agg(F.max("value").alias("value"))
    inside = Window.partitionBy(*labels, "slice").orderBy("at")
    stepped = once.withColumn("before", F.lag("value").over(inside))
    slices = stepped.groupBy(*labels, "slice").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("at").alias("first_at"),
        F.min_by("value", "at").alias("first_value"),
        F.max("at").alias("last_at"),
        F.max_by("value", "at").alias("last_value"),
        F.coalesce(F.sum(_gain(F.col("value"), F.col("before"))), F.lit(0)).alias("inner"),
        F.count_if(F.col("value") < F.col("before")).alias("fell"),
    )
    slices = slices.withColumn("_day", F.col("slice") - F.pmod("slice", _micros(86_400)))
    in_day = Window.partitionBy(*labels, "_day").orderBy("slice")
    # One row per series and day: the last value of the day with samples before it.
    days = slices.groupBy(*labels, "_day").agg(F.max_by("last_value", "slice").alias("_last"))
    over_days = Window.partitionBy(*labels).orderBy("_day")
    days = days.select(*labels, "_day", F.lag("_last").over(over_days).alias("_carried"))
    s, d = slices.withColumn("_before", F.lag("last_value").over(in_day)).alias("s"), days.alias("d")
    same = reduce(lambda a, b: a & b, [F.col(f"s.{c}").eqNullSafe(F.col(f"d.{c}")) for c in labels], F.col("s._day") == F.col("d._day"))
    before = F.coalesce("s._before", "d._carried")
    return s.join(d, same, "left").select(
        *[F.col(f"s.{c}") for c in (*labels, "slice", "n", "first_at", "first_value", "last_at", "last_value")],
        _gain(F.col("s.first_value"), before).alias("lead"),
        F.col("s.inner"),
        (F.col("s.fell") + F.coalesce((F.col("s.first_value") < before).cast("bigint"), F.lit(0))).alias("restarts"),
    )


def _extrapolated(width: int) -> Column:
    """The increase as if the samples' pace went on to the window's edges.

    An edge farther than FAR mean distances from the nearest sample is met by half such a distance. Before the first sample
    the pace goes back no farther than to where the counter would have been zero.
    """
    increase, spread = F.col("increase").cast("double"), (F.col("last_at") - F.col("first_at")).cast("double")
    mean = spread / (F.col("n") - 1)

    def reach(distance: Column) -> Column:
        return F.when(distance >= mean * FAR, mean / 2).otherwise(distance.cast("double"))

    from_start = reach(F.col("first_at") - (F.col("window") - _micros(width)))
    to_zero = F.when((increase > 0) & (F.col("first_value") >= 0), spread * (F.col("first_value") / increase))
    to_end = reach(F.col("window") - F.col("last_at"))
    return increase * ((spread + F.least(from_start, to_zero) + to_end) / spread)


def windowed_increase(samples: DataFrame, labels: Sequence[str] = (), step: int = 30, width: int = 60) -> DataFrame:
    """How much each counter grew in the trailing `width` seconds, every `step` seconds, restarts included.

    Gives `window_end, [labels], n, increase, extrapolated, rate`: samples in the window, their plain increase, the increase
    reached up to the window's edges, and that per second. Windows with fewer than two samples have no row.
    `width` must be a multiple of `step`.
    """
    if step <= 0 or width % step:
        raise ValueError("width must be a multiple of step")
    slices = counter_slices(samples, labels, step)
    ends = F.transform(F.sequence(F.lit(0), F.lit(width // step - 1)), lambda i: F.col("slice") + i * _micros(step))
    gained = F.sum(F.coalesce("lead", F.lit(0)) + F.col("inner"))
    windows = (
        slices.withColumn("window", F.explode(ends))
        .groupBy("window", *labels)
        .agg(
            F.sum("n").alias("n"),
            F.min("first_at").alias("first_at"),
            F.min_by("first_value", "first_at").alias("first_value"),
            F.max("last_at").alias("last_at"),
            # The gain of the window's first sample lies before the window.
            (gained - F.min_by(F.coalesce("lead", F.lit(0)), "first_at")).alias("increase"),
        )
        .filter("n >= 2")
    )
    kind = samples.schema["ts"].dataType
    end = F.timestamp_micros("window")
    return windows.select(
        (end.cast("timestamp_ntz") if isinstance(kind, T.TimestampNTZType) else end).alias("window_end"),
        *labels,
        "n",
        "increase",
        _extrapolated(width).alias("extrapolated"),
        (_extrapolated(width) / float(width)).alias("rate"),
    )


def counter_totals(samples: DataFrame, labels: Sequence[str] = (), slice_seconds: int = 3600) -> DataFrame:
    """`[labels], samples, restarts, total`: all a counter has counted since before its first sample, over every restart."""
    slices = counter_slices(samples, labels, slice_seconds)
    added = F.coalesce("lead", "first_value") + F.col("inner")
    return slices.groupBy(*labels).agg(F.sum("n").alias("samples"), F.sum("restarts").alias("restarts"), F.sum(added).alias("total")).filter("samples > 0")
