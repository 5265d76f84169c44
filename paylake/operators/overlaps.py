"""Overlap join: pairs of intervals that share a moment, with or without columns to join on.

Two intervals overlap exactly if one starts inside the other, so the join is two lookups of starts in intervals. An interval
becomes its dyadic cover: aligned cells of 1, 2, 4, ... ticks, at most two of each size, however long it is. A start lies in
one cell of every size, and meets an interval in exactly one cell of its cover. So a pair is found once, by an equality.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.operators.ranges import _number

#: Ticks in a mean interval. More make covers finer and candidates fewer; pairs are the same.
TICKS = 2
#: Sizes of cells, as powers of two: enough for any pair of ticks.
SIZES = 60


def _halved(tick: Column, size: Column) -> Column:
    return F.call_function("shiftright", tick, size)


def _size_and_cell(low: Column, high: Column, place: Column) -> tuple[Column, Column]:
    """The cell of the cover at a place: two places per size, null where the cover has no such cell.

    Cells `first` to `end - 1` of a size lie inside as a whole. An odd first one and an even last one have no brother inside,
    so they are taken; all others are halves of cells of the next size.
    """
    size = F.shiftright(place, 1)
    first, end = _halved(low - 1, size) + 1, _halved(high + 1, size)
    at_end = place.bitwiseAND(F.lit(1)) == 1
    odd = F.when(at_end, end).otherwise(first).bitwiseAND(F.lit(1)) == 1
    return size, F.when((first < end) & odd, F.when(at_end, end - 1).otherwise(first))


def dyadic_cover(low: Column, high: Column, sizes: int = SIZES) -> Column:
    """Cells `(size, cell)` that make up the ticks from low to high, both included; size is a power of two below `sizes`,
    which must be enough for the longest interval."""
    low, high = low.cast("bigint"), high.cast("bigint")
    cells = []
    for place in range(2 * sizes):
        size, cell = _size_and_cell(low, high, F.lit(place))
        cells.append(F.when(cell.isNotNull(), F.struct(size.alias("size"), cell.alias("cell"))))
    return F.array_compact(F.array(*cells))


def _starts_inside(holders: DataFrame, starters: DataFrame, keys: Sequence[str], unit: float, longest: int, strict: bool) -> DataFrame:
    """(holder, starter) rows with the starter's beginning in the holder; `strict` leaves out equal beginnings."""
    ticks = lambda c: F.floor(F.col(c) / unit).cast("bigint")
    # A row per place, and its cell then: one expression over all of a cover's cells is too long for the JIT compiler.
    places = holders.select("*", ticks("_low").alias("_first"), ticks("_high").alias("_last"), F.explode(F.lit(list(range(2 * longest)))).alias("_place"))
    size, cell = _size_and_cell(F.col("_first"), F.col("_last"), F.col("_place"))
    cells = places.select(*holders.columns, size.alias("_size"), cell.alias("_cell")).filter("_cell IS NOT NULL")
    # The sizes that occur: sixty numbers at most.
    sizes = sorted(r[0] for r in cells.select("_size").distinct().collect())
    if not sizes:
        sizes = [0]
    starts = starters.select("*", ticks("_low").alias("_first"), F.explode(F.lit(sizes)).alias("_size"))
    starts = starts.select(*starters.columns, "_size", _halved(F.col("_first"), F.col("_size")).alias("_cell"))
    a, b = cells.alias("a"), starts.alias("b")
    # The keys that tell most rows apart come first: rows are sorted by the first one's bytes, and compared only where those agree.
    same = reduce(and_, [*[F.col(f"a._row.`{key}`") == F.col(f"b._row.`{key}`") for key in keys], *[F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("_cell", "_size")]])
    after = F.col("a._low") < F.col("b._low") if strict else F.col("a._low") <= F.col("b._low")
    return a.join(b, same & after & (F.col("b._low") < F.col("a._high"))).select(F.col("a._row").alias("holder"), F.col("b._row").alias("starter"))


def overlap_join(left: DataFrame, right: DataFrame, left_bounds: tuple[str, str], right_bounds: tuple[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """Pairs `left, right` (structs of the two rows) whose intervals `[start, end)` share a moment and whose `keys` are equal.

    Bounds are dates, times or numbers. A null bound, an end that is not after its start, and a null key match nothing.
    Repeated rows pair like any others. Rows of an interval are bounded by the sizes of cells, so one over the whole axis
    has two per size.
    """
    sides = []
    for df, (start, end) in ((left, left_bounds), (right, right_bounds)):
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), _number(df, start).alias("_low"), _number(df, end).alias("_high"))
        sides.append(rows.filter("_low < _high"))
    # Two numbers; any unit gives the same pairs.
    lengths = sides[0].select("_low", "_high").unionByName(sides[1].select("_low", "_high")).select((F.col("_high") - F.col("_low")).alias("n"))
    mean, most = lengths.agg(F.avg("n"), F.max("n")).first()
    unit = (mean or 1.0) / TICKS
    longest = min(SIZES, int((most or 0.0) / unit + 2).bit_length() + 1)
    one = _starts_inside(sides[0], sides[1], keys, unit, longest, strict=False).select(F.col("holder").alias("left"), F.col("starter").alias("right"))
    two = _starts_inside(sides[1], sides[0], keys, unit, longest, strict=True).select(F.col("starter").alias("left"), F.col("holder").alias("right"))
    return one.unionByName(two)
