"""Distinct counts from stored sketches: one per day and label, united, subtracted and intersected later without the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Nominal entries of a sketch as a power of two, and four standard errors of an estimate from one.
LOG_ENTRIES = 12
ERROR = 4 / 2 ** (LOG_ENTRIES / 2)


def daily_sketches(events: DataFrame, key: str, at: str, labels: Sequence[str] = ()) -> DataFrame:
    """`day, [labels], sketch`, of bounded size. Keys combine map-side, so a hot label reaches the shuffle as sketches.

    Null keys are not counted. A day that is stored again replaces its sketches; two that overlap unite to the same.
    """
    return events.groupBy(F.col(at).cast("date").alias("day"), *labels).agg(F.theta_sketch_agg(key, F.lit(LOG_ENTRIES)).alias("sketch"))


def united(sketches: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """One sketch per group, for instance of the seven of a week."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("sketch", F.lit(LOG_ENTRIES)).alias("sketch"))


def estimate(sketch: Column | str) -> Column:
    return F.theta_sketch_estimate(sketch)


def only_in(first: Column | str, second: Column | str) -> Column:
    """Keys of the first that are not in the second. Its error is in shares of the first's keys, not of the result."""
    return estimate(F.theta_difference(first, second))


def in_both(first: Column | str, second: Column | str) -> Column:
    """Keys of both; its error is in shares of the united keys."""
    return estimate(F.theta_intersection(first, second))
