"""Ranks, row numbers and running sums over a whole table, or within keys of any size.

A window without PARTITION BY brings all rows to one task, and one with a hot key most of them. Here rows are dealt by ranges
of their order, each range is ranked by itself, and what lies before a range is added: one row of totals per range, and only
for keys that cross a boundary. These are fewer than two per partition, so the driver adds them up.

Ranks and sums of peers need each distinct value of the order once. Rows are counted per value first, so a value that a third
of all rows share is one row when it is dealt.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paylake.session import scratch_folder

#: An order: column names, each with `DESC` behind it where it descends. Nulls come first, or last where it descends.
Order = Sequence[str]


def _names(order: Order) -> list[str]:
    return [name.removesuffix(" DESC") for name in order]


def _sorted_by(order: Order) -> list[Column]:
    return [F.col(name.removesuffix(" DESC")).desc() if name.endswith(" DESC") else F.col(name).asc() for name in order]


def _staged(df: DataFrame) -> DataFrame:
    """Written once: ranges are cut by a sample, and must be the same for totals and rows."""
    path = scratch_folder(df.sparkSession, "ordered")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(a: str, b: str, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(f"{a}.{name}").eqNullSafe(F.col(f"{b}.{name}"))
    return condition


def _dealt(df: DataFrame, order: Order, keys: Sequence[str], sums: Mapping[str, str], partitions: int | None) -> DataFrame:
    """Rows by ranges of keys and order, with running values within their range, and `_before_*`: what lies before it.

    sums: name to the column that is added up, which must not be null.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys, *_sorted_by(order)).withColumn("_range", F.spark_partition_id())
    ranged = _staged(ranged)
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_sum_{name}") for name, c in sums.items()])
    if keys:
        totals = totals.withColumn("_ranges", F.count(F.lit(1)).over(W.partitionBy(*keys))).filter("_ranges > 1")
    found = totals.orderBy("_range").collect()  # a row per range and key that crosses into it: fewer than two per range
    so_far: dict[tuple, list] = {}
    rows = []
    for row in found:
        key = tuple(row[k] for k in keys)
        before = so_far.setdefault(key, [0] * len(sums))
        rows.append((*key, row["_range"], *before))
        so_far[key] = [b + row[f"_sum_{name}"] for b, name in zip(before, sums, strict=True)]
    kinds = {f.name: f.dataType.simpleString() for f in totals.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, "_range"]) + "".join(f", `_before_{name}` {kinds[f'_sum_{name}']}" for name in sums)
    before = F.broadcast(spark.createDataFrame([_typed(r, len(keys) + 1, totals, sums) for r in rows], schema))
    local = W.partitionBy(*keys, "_range").orderBy(*_sorted_by(order)).rowsBetween(W.unboundedPreceding, 0)
    run = ranged.select("*", *[F.sum(c).over(local).alias(f"_run_{name}") for name, c in sums.items()])
    joined = run.alias("r").join(before.alias("b"), _same("r", "b", [*keys, "_range"]), "left")
    values = [(F.col(f"r._run_{name}") + F.coalesce(f"b._before_{name}", F.lit(0))).cast(kinds[f"_sum_{name}"]).alias(f"_run_{name}") for name in sums]
    return joined.select(*[F.col(f"r.`{c}`") for c in df.columns], *values)


def _typed(row: tuple, head: int, totals: DataFrame, sums: Mapping[str, str]) -> tuple:
    """Zeros of the totals' own types."""
    from decimal import Decimal

    kinds = [totals.schema[f"_sum_{name}"].dataType.typeName() for name in sums]
    make = {"decimal": Decimal, "double": float, "float": float}
    return (*row[:head], *(make.get(kind, int)(v) for kind, v in zip(kinds, row[head:], strict=True)))


def with_row_numbers(
    df: DataFrame, order: Order, keys: Sequence[str] = (), sums: Mapping[str, str] | None = None, ntile: int | None = None, partitions: int | None = None
) -> DataFrame:
    """Add `row_number`, a running sum (ROWS UNBOUNDED PRECEDING) per entry of `sums` under its name, and `ntile`.

    Rows that the order does not tell apart are numbered in any order, as in SQL; name more columns to make it one. Nulls
    add nothing, and a sum is null until the first value. An empty table stays empty.
    """
    sums = dict(sums or {})
    for name in ("row_number", "ntile", *sums):
        if name in df.columns:
            raise ValueError(f"there is a column {name}")
    rows = df.withColumn("_one", F.lit(1).cast("bigint"))
    parts = {"row_number": "_one"}
    for i, (name, column) in enumerate(sums.items()):
        rows = rows.withColumn(f"_value_{i}", F.coalesce(F.col(column), F.lit(0).cast(df.schema[column].dataType)))
        rows = rows.withColumn(f"_some_{i}", F.col(column).isNotNull().cast("bigint"))
        parts |= {name: f"_value_{i}", f"some_{i}": f"_some_{i}"}
    made = _dealt(rows, order, keys, parts, partitions)
    out = [F.col("_run_row_number").alias("row_number")]
    out += [F.when(F.col(f"_run_some_{i}") > 0, F.col(f"_run_{name}")).alias(name) for i, name in enumerate(sums)]
    made = made.select(*df.columns, *out)
    if ntile is None:
        return made
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if keys:
        made = made.alias("r").join(counts.alias("c"), _same("r", "c", keys)).select(*[F.col(f"r.`{c}`") for c in made.columns], "c._n")
    else:
        made = made.withColumn("_n", F.lit(counts.first()["_n"]).cast("bigint"))
    small, more = F.col("_n") - F.col("_n") % ntile, F.col("_n") % ntile
    size, at = (small / ntile).cast("bigint"), F.col("row_number") - 1
    first = more * (size + 1)
    tile = F.when(at < first, F.floor(at / (size + 1))).otherwise(more + F.floor((at - first) / F.greatest(size, F.lit(1)))) + 1
    return made.withColumn("ntile", tile.cast("bigint")).drop("_n")


def with_ranks(df: DataFrame, order: Order, keys: Sequence[str] = (), sums: Mapping[str, str] | None = None, partitions: int | None = None) -> DataFrame:
    """Add `rank`, `dense_rank`, `percent_rank`, `cume_dist`, and a running sum with peers (RANGE UNBOUNDED PRECEDING) per
    entry of `sums`. Peers share all of these. Nulls of the order are peers; nulls add nothing to a sum.
    """
    sums = dict(sums or {})
    for name in ("rank", "dense_rank", "percent_rank", "cume_dist", *sums):
        if name in df.columns:
            raise ValueError(f"there is a column {name}")
    by = [*keys, *_names(order)]
    adds = [F.coalesce(F.sum(c), F.lit(0).cast(df.schema[c].dataType)).alias(f"_value_{i}") for i, c in enumerate(sums.values())]
    some = [F.count(c).alias(f"_some_{i}") for i, c in enumerate(sums.values())]
    values = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_peers"), *adds, *some).withColumn("_one", F.lit(1).cast("bigint"))
    parts = {"rows": "_peers", "values": "_one"} | {f"{kind}_{i}": f"_{kind}_{i}" for i in range(len(sums)) for kind in ("value", "some")}
    made = _dealt(values, order, keys, parts, partitions)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if keys:
        made = made.alias("r").join(counts.alias("c"), _same("r", "c", keys)).select(*[F.col(f"r.`{c}`") for c in made.columns], "c._n")
    else:
        made = made.withColumn("_n", F.lit(counts.first()["_n"]).cast("bigint"))
    rank = F.col("_run_rows") - F.col("_peers") + 1
    share = F.when(F.col("_n") > 1, (rank - 1).cast("double") / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    made = made.select(
        *by, rank.alias("rank"), F.col("_run_values").alias("dense_rank"), share.alias("percent_rank"), (F.col("_run_rows").cast("double") / F.col("_n")).alias("cume_dist"),
        *[F.when(F.col(f"_run_some_{i}") > 0, F.col(f"_run_value_{i}")).alias(name) for i, name in enumerate(sums)],
    )
    added = [c for c in made.columns if c not in by]
    # One row per value on the right, so rows of a value that many share may be split among tasks.
    both = df.alias("r").join(made.alias("m").hint("merge"), _same("r", "m", by))
    return both.select(*[F.col(f"r.`{c}`") for c in df.columns], *[F.col(f"m.`{c}`") for c in added])
