"""`NOT IN` over several columns and tables of any size, without a broadcast.

A row is kept if its comparison with every row of the other side is false: some pair of columns has two values that differ.
So it goes if a row there equals it in all columns where both have values. Which columns those are is told by where either
side has nulls, and rows are split by that: for each two patterns that occur, an anti join on the columns that both have.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pattern(names: Sequence[str]) -> F.col:
    """A bit per column that has a value."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(F.col(name).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(names)])


def _patterns(df: DataFrame, names: Sequence[str]) -> set[int]:
    """Those that occur: a number per set of columns, 2^columns at most."""
    return {row["p"] for row in df.select(_pattern(names).alias("p")).distinct().collect()}


def not_in(left: DataFrame, right: DataFrame, names: Sequence[str], others: Sequence[str] | None = None) -> DataFrame:
    """Rows of `left` for which `(names) NOT IN (SELECT others FROM right)` is true; columns and repeats stay.

    With no row on the right all stay. A row of nulls only, on either side, leaves nothing to differ: on the right it removes
    every row, on the left it stays only if the right is empty.
    """
    others = list(others or names)
    if len(others) != len(names):
        raise ValueError("both sides of NOT IN need the same number of columns")
    values = right.select(*[F.col(o).alias(f"_{i}") for i, o in enumerate(others)])
    marked = [f"_{i}" for i in range(len(names))]
    theirs = _patterns(values, marked)
    if not theirs:
        return left
    kept = []
    for mine in sorted(_patterns(left, names)):
        rows = left.filter(_pattern(names) == mine)
        if any(not mine & pattern for pattern in theirs):
            continue
        for pattern in sorted(theirs):
            both = [i for i in range(len(names)) if mine & pattern & 1 << i]
            found = values.filter(_pattern(marked) == pattern).select(*[marked[i] for i in both]).distinct()
            rows = rows.join(found.hint("merge"), [F.col(names[i]) == F.col(marked[i]) for i in both], "left_anti")
        kept.append(rows)
    return reduce(DataFrame.unionByName, kept) if kept else left.limit(0)
