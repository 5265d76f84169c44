"""Interval join: pairs of an interval and a point inside it, without any column to join on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(f"`{name}`").cast("timestamp")) / F.lit(1e6)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(f"`{name}`")) / F.lit(1e6)
    return F.col(f"`{name}`").cast("double")


def range_join(intervals: DataFrame, points: DataFrame, start: str, end: str, point: str, width: float | None = None) -> DataFrame:
    """Every pair with `start <= point < end`; times or numbers, and no name may be on both sides.

    Both sides meet on a bucket key: an interval has one for each bucket it touches, a point one, so a pair is found once.
    A bucket is as wide as the mean interval unless `width` is given, so intervals become two rows each on average, however
    unlike they are. The join is an equality, which is split where a bucket is hot. Rows with a NULL bound match nothing.
    """
    clash = set(intervals.columns) & set(points.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    low, high = _number(intervals, start), _number(intervals, end)
    usable = intervals.filter(low < high)
    if width is None:
        # One number; a bucket of any width gives the same pairs.
        width = usable.agg(F.avg(high - low)).first()[0] or 1.0
    buckets = F.sequence(F.floor(low / width), F.floor(high / width))
    left = usable.withColumn("_bucket", F.explode(buckets))
    right = points.withColumn("_bucket", F.floor(_number(points, point) / width))
    inside = (F.col(f"`{start}`") <= F.col(f"`{point}`")) & (F.col(f"`{point}`") < F.col(f"`{end}`"))
    return left.join(right, "_bucket").filter(inside).drop("_bucket")
