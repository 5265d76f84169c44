"""Quantiles of groups of any size: exact by selection, and within a stated rank error by mergeable sketches."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.operators.ordered import _dealt, _same

#: Size parameter of the quantile sketches, and the normalised rank error it stands for with 99 percent confidence.
SKETCH_K, RANK_ERROR = 400, 0.0067


def exact_percentiles(df: DataFrame, value: str, fractions: Sequence[float], keys: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """`keys, fraction, percentile`: the value at each fraction of the sorted values, interpolated between two (PERCENTILE_CONT).

    Values are counted, dealt by ranges, and numbered by totals per range; only the values at the wanted places are kept, so
    no task holds a group's values. Nulls are left out; a group without values gives null percentiles.
    """
    known = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    counts = known.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_peers"))
    run = _dealt(counts, ["_v"], keys, {"rows": "_peers"}, partitions)
    sizes = df.groupBy(*keys).agg(F.count(value).alias("_n"))
    wanted = F.explode(F.array(*[F.lit(float(f)) for f in fractions])).alias("fraction")
    # Two places per group and fraction.
    places = sizes.select(*keys, "_n", wanted).withColumn("_at", F.col("fraction") * (F.col("_n") - 1))
    held = [c for c in places.columns]
    if keys:
        both = run.alias("r").join(places.alias("p"), _same("r", "p", keys))
    else:
        both = run.alias("r").crossJoin(F.broadcast(places.alias("p")))  # a row per fraction
    first, last = F.col("r._run_rows") - F.col("r._peers"), F.col("r._run_rows") - 1
    low, high = F.floor("p._at"), F.ceil("p._at")
    hit = both.filter(((first <= low) & (low <= last)) | ((first <= high) & (high <= last)))
    hit = hit.select(*[F.col(f"p.`{c}`") for c in held], "r._v", ((first <= low) & (low <= last)).alias("_is_low"), ((first <= high) & (high <= last)).alias("_is_high"))
    found = hit.groupBy(*keys, "fraction", "_at").agg(F.max(F.when(F.col("_is_low"), F.col("_v"))).alias("_a"), F.max(F.when(F.col("_is_high"), F.col("_v"))).alias("_b"))
    between = F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_at") - F.floor("_at"))
    made = found.select(*keys, "fraction", between.alias("percentile"))
    missing = places.filter("_n = 0").select(*keys, "fraction", F.lit(None).cast("double").alias("percentile"))
    return made.unionByName(missing)


def quantile_sketches(df: DataFrame, value: str, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """`keys, sketch`: a sketch of bounded size per group. Sketches of parts of a group merge to one of the whole."""
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def estimated_percentiles(sketches: DataFrame, fractions: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """`keys, fraction, percentile` of merged sketches; ranks are off by RANK_ERROR of the group's rows, as a rule."""
    each = [sketches.select(*keys, F.lit(float(f)).alias("fraction"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(f))).alias("percentile")) for f in fractions]
    return reduce(DataFrame.unionByName, each)


def rank_errors(df: DataFrame, estimates: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """`keys, fraction, rank_error`: how far an estimate's share of smaller rows is from its fraction, in shares of the group.

    An estimate that many rows equal is right if its fraction lies anywhere among them.
    """
    v = F.col(f"d.{value}").cast("double")
    both = df.alias("d").join(estimates.alias("e"), _same("d", "e", keys)).filter(v.isNotNull())
    shares = both.groupBy(*[F.col(f"e.{k}").alias(k) for k in keys], F.col("e.fraction").alias("fraction")).agg(
        F.avg((v < F.col("e.percentile")).cast("int")).alias("below"), F.avg((v <= F.col("e.percentile")).cast("int")).alias("up_to")
    )
    off = F.greatest(F.col("below") - F.col("fraction"), F.col("fraction") - F.col("up_to"), F.lit(0.0))
    return shares.select(*keys, "fraction", off.alias("rank_error"))
