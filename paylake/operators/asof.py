"""As-of join: for each left row, the last right row with the same keys at or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A bucket with more distinct times than this is cut, by the second, into parts of about as many.
POINTS_PER_PART = 100_000


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    on: str,
    bucket: str = "1 hour",
    suffix: str = "_right",
    points_per_part: int = POINTS_PER_PART,
) -> DataFrame:
    """Left rows, all kept, with the other columns of the matching right row (NULL without a match).

    `by` and `on` are columns of both sides, with any names; `on` is a TIMESTAMP_NTZ. Of right rows at the same time the
    one that is greatest by its remaining columns counts, those that have an order. Right columns that exist on the left
    get `suffix`, more than once if need be.

    The match depends on (keys, time) only, so both sides are first reduced, map-side, to one row per (keys, time);
    copies never meet in one task. These points are swept in time buckets rather than whole keys, and a busy bucket in
    parts of bounded size. A part starts from the last right row before it, which is found from one row per part.
    """
    carried = [name for name in right.columns if name not in by and name != on]
    taken, named = set(left.columns), {}
    for name in carried:
        new = name
        while new in taken:
            new += suffix
        named[name] = new
        taken.add(new)

    # Inside, keys and time have names of their own, so those of the caller can be anything.
    keys = [f"_k{i}" for i in range(len(by))]
    renamed = [F.col(f"`{name}`").alias(key) for name, key in zip(by, keys, strict=True)] + [F.col(f"`{on}`").alias("_t")]
    usable = " AND ".join(f"{name} IS NOT NULL" for name in [*keys, "_t"])
    row = F.struct(*(F.col(f"`{name}`").alias(named[name]) for name in carried)).alias("_row")
    order = F.struct(F.lit(0), *(F.col(f"_row.`{named[name]}`") for name in carried if _orderable(right.schema[name].dataType)))
    known = right.select(*renamed, row).filter(usable).groupBy(*keys, "_t").agg(F.max_by("_row", order).alias("_row"))
    asked = left.select(*renamed).filter(usable).distinct().withColumn("_row", F.lit(None).cast(known.schema["_row"].dataType))
    points = (
        known.withColumn("_side", F.lit(0))
        .unionByName(asked.withColumn("_side", F.lit(1)))
        .withColumn("_bucket", F.window("_t", bucket)["start"])
        .withColumn("_second", F.date_trunc("second", "_t"))
        # Always true; the joins below would add it to one of their uses, and the plan would compute the points twice.
        .filter(F.col("_bucket").isNotNull() & F.col("_second").isNotNull())
    )
    of_bucket = Window.partitionBy(*keys, "_bucket")
    seconds = points.groupBy(*keys, "_bucket", "_second").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(of_bucket.orderBy("_second").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    cut = seconds.withColumn("_part", F.floor(before / points_per_part)).filter("_part > 0").select(*keys, "_second", "_part")
    points = points.join(cut, [*keys, "_second"], "left").withColumn("_part", F.coalesce("_part", F.lit(0).cast("bigint")))

    keyed = [*keys, "_bucket", "_part"]
    last = points.groupBy(*keyed).agg(F.max_by("_row", F.when(F.col("_side") == 0, F.col("_t"))).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    start = last.select(*keyed, F.last("_last", ignorenulls=True).over(earlier).alias("_start"))

    sweep = Window.partitionBy(*keyed).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    swept = points.withColumn("_within", F.last("_row", ignorenulls=True).over(sweep)).filter("_side = 1")
    matches = swept.join(start, keyed).select(*keys, "_t", F.coalesce("_within", "_start").alias("_match"))
    own = [F.col(f"l.`{name}`") for name in left.columns]
    same = [F.col(f"l.`{name}`") == F.col(f"m.{key}") for name, key in zip([*by, on], [*keys, "_t"], strict=True)]
    return left.alias("l").join(matches.alias("m"), same, "left").select(*own, *(F.col(f"m._match.`{named[name]}`") for name in carried))
