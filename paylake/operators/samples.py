"""Samples that follow the rows alone: the same for any file split, partitioning or retry.

A row's place is the md5 of a seed and its key columns. A share of rows is those below a threshold; a fixed number per
stratum is those with the smallest places. A task keeps the smallest of its own rows before anything is shuffled, and a
stratum is first cut by pieces of its places, so a hot one is chosen by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Pieces of a stratum: by the first two digits of the place.
PIECE_DIGITS = 2


def place(keys: Sequence[str], seed: int) -> Column:
    """Hexadecimal digits that order rows; nulls are told from empty texts."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return F.md5(F.concat_ws("/", F.lit(str(seed)), *parts).cast("binary"))


def share(df: DataFrame, keys: Sequence[str], per_mille: int, seed: int = 0) -> DataFrame:
    """About `per_mille` thousandths of the rows; rows with equal keys stay or go together. Nothing is shuffled."""
    if not 0 <= per_mille <= 1000:
        raise ValueError("per_mille is between 0 and 1000")
    limit = f"{(per_mille << 32) // 1000:09x}"
    return df.filter(F.concat(F.lit("0"), F.substring(place(keys, seed), 1, 8)) < limit)


def bottom_k(df: DataFrame, strata: Sequence[str], keys: Sequence[str], k: int, seed: int = 0) -> DataFrame:
    """Exactly `k` rows per stratum, or all if it has fewer: those with the smallest places. Keys should tell rows apart;
    rows with equal keys are taken in any order. A null stratum is one like any other."""
    placed = df.withColumn("_place", place(keys, seed))
    piece = W.partitionBy(*strata, F.substring("_place", 1, PIECE_DIGITS)).orderBy("_place")
    some = placed.withColumn("_at", F.row_number().over(piece)).filter(F.col("_at") <= k).drop("_at")
    best = W.partitionBy(*strata).orderBy("_place")
    return some.withColumn("_at", F.row_number().over(best)).filter(F.col("_at") <= k).drop("_at", "_place")
