"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

An item of m characters that lies in a text with at most k edits shares at least m - q + 1 - kq of its q-grams with it, all
on diagonals (place in the text minus place in the item) no more than k apart. So shared q-grams are counted in overlapping
bands of 2(k + 1) diagonals, one of which holds such a stretch whole; bands that reach the bound are aligned.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm.common import small_batches, staged, table, unused

Q = 10
#: Edits allowed, as a share of an item's characters.
EDIT_RATE = 0.05
#: Items are compared in blocks of at most this many characters (a longer item is a block of its own), so neither a task nor
#: the driver holds more of a benchmark of any size.
BLOCK_CHARS = 4_000_000
#: Longer texts are searched in overlapping pieces.
PIECE = 1 << 19
_BASE = np.uint32(0x01000193)
_FILTER_BITS = 21


def normalise(text: str | None) -> str:
    """Lower case, and one space for each run of white space."""
    return " ".join((text or "").lower().split())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash for each run of q code points, built by doubling."""
    if len(points) < q:
        return np.zeros(0, np.uint32)
    out, size, power, at = None, 0, points * np.uint32(0x9E3779B1), 1
    while True:
        if q & at:
            out = power if out is None else out[: len(out) - at] * np.uint32(pow(int(_BASE), at, 1 << 32)) + power[size:][: len(out) - at]
            size += at
        if size == q:
            return out[: len(points) - q + 1]
        power = power[:-at] * np.uint32(pow(int(_BASE), at, 1 << 32)) + power[at:]
        at *= 2


def _slot(h: np.ndarray) -> np.ndarray:
    return (h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - _FILTER_BITS)


@dataclass
class Items:
    """Benchmark items with their q-grams in order of hash. Items shorter than q characters have none; see `short_items`."""

    ids: list[int] = field(default_factory=list)
    texts: list[np.ndarray] = field(default_factory=list)
    edits: np.ndarray = None
    bound: np.ndarray = None
    hashes: np.ndarray = None
    first: np.ndarray = None
    item: np.ndarray = None
    place: np.ndarray = None
    seen: np.ndarray = None

    @staticmethod
    def of(rows: Sequence[tuple[int, str]], edit_rate: float = EDIT_RATE) -> Items:
        kept = [(i, _points(t)) for i, t in ((i, normalise(t)) for i, t in rows) if len(t) >= Q]
        out = Items([i for i, _ in kept], [p for _, p in kept])
        sizes = np.array([len(p) for p in out.texts], np.int64)
        out.edits = np.floor(sizes * edit_rate + 1e-9).astype(np.int64)
        out.bound = sizes - Q + 1 - out.edits * Q
        if (out.bound < 1).any():
            raise ValueError("the q-gram lemma needs fewer edits or a smaller q")
        grams = [qgrams(p) for p in out.texts] or [np.zeros(0, np.uint32)]
        item = np.repeat(np.arange(len(kept)), [len(g) for g in grams[: len(kept)]])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        every = np.concatenate(grams)
        order = np.argsort(every, kind="stable")
        out.item, out.place = item[order].astype(np.int64), place[order]
        out.hashes, out.first = np.unique(every[order], return_index=True)
        out.first = np.append(out.first, len(every))
        out.seen = np.zeros(1 << _FILTER_BITS, bool)
        out.seen[_slot(out.hashes)] = True
        return out

    def find(self, text: str | None) -> dict[int, int]:
        """Item number to its fewest edits, for every item that the normalised text holds within the item's budget."""
        whole, found = _points(normalise(text)), {}
        if not self.ids:
            return found
        overlap = max(len(t) for t in self.texts) + int(self.edits.max())
        for at in range(0, max(1, len(whole) - overlap), PIECE):
            for item, edits in self._find(whole[at : at + PIECE + overlap]):
                found[item] = min(edits, found.get(item, edits))
        return found

    def _find(self, points: np.ndarray) -> Iterator[tuple[int, int]]:
        grams = qgrams(points)
        maybe = np.flatnonzero(self.seen[_slot(grams)])
        if not len(maybe):
            return
        at = np.searchsorted(self.hashes, grams[maybe])
        at[at == len(self.hashes)] = 0
        hit = self.hashes[at] == grams[maybe]
        at, maybe = at[hit], maybe[hit]
        n = self.first[at + 1] - self.first[at]
        entry = np.repeat(self.first[at] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        item = self.item[entry]
        diagonal = np.repeat(maybe, n) - self.place[entry]
        # Each hit counts in the two bands of 2(k + 1) diagonals it lies in.
        band = np.floor_divide(diagonal, self.edits[item] + 1)
        keys = (np.concatenate((item, item)) << 32) + np.concatenate((band, band - 1)) + (1 << 31)
        keys, counts = np.unique(keys, return_counts=True)
        for key in keys[counts >= self.bound[keys >> 32]]:
            i, first = int(key >> 32), (int(key & 0xFFFFFFFF) - (1 << 31)) * (int(self.edits[key >> 32]) + 1)
            edits = align(self.texts[i], points, first, first + 2 * int(self.edits[i]) + 1, int(self.edits[i]))
            if edits is not None:
                yield i, edits


def short_items(rows: Sequence[tuple[int, str]]) -> list[tuple[int, str]]:
    """Items without q-grams, normalised. No edit is allowed them, so containment decides; empty ones say nothing."""
    return [(i, t) for i, t in ((i, normalise(t)) for i, t in rows) if 0 < len(t) < Q]


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> int | None:
    """Fewest edits of the item against any stretch of the text on diagonals low to high, or None if more than `most`."""
    shifts = np.arange(low, high + 1)
    steps = np.arange(len(shifts))
    padded = np.full(len(item) + len(shifts), 0xFFFFFFFF, np.uint32)
    start, end = max(0, low), min(len(text), low + len(padded))
    if end > start:
        padded[start - low : end - low] = text[start:end]
    # A cell is on row i and diagonal d, at text place i + d; places outside the text cost more than allowed.
    far = most + 1
    cost = np.where((shifts >= 0) & (shifts <= len(text)), 0, far)
    # The item may start at any place of the text; before the text's start only by dropping characters of the item.
    for i in range(len(item)):
        kept = cost + (padded[i : i + len(shifts)] != item[i])
        kept[(shifts + i < 0) | (shifts + i >= len(text))] = far
        dropped = np.append(cost[1:] + 1, far)
        cost = np.minimum(kept, dropped)
        cost[shifts + i + 1 == 0] = min(i + 1, far)
        cost = np.minimum.accumulate(cost - steps) + steps
        cost = np.minimum(cost, far)
        if cost.min() > most:
            return None
    return int(cost.min())


def dealt(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, list[int]]:
    """Distinct items (item_id, text, block), stored, and the blocks; rows without id or text are left out.

    If all items are within the bound they are one block. Otherwise an item of more than an eighth of it has a block of its
    own, and the others are dealt by a hash, into twice as many blocks until each is within the bound.
    """
    items = staged(benchmark.select("item_id", "text").filter("item_id IS NOT NULL AND text IS NOT NULL").distinct(), "benchmark")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if total <= block_chars:
        return items.withColumn("block", F.lit(0)), [0]
    n, own = 2 * -(-total // block_chars), F.length("text") > block_chars // 8
    while True:
        place = F.xxhash64("item_id", "text")
        numbered = items.withColumn("block", F.when(own, place).otherwise(F.pmod(place, F.lit(n))))
        if numbered.filter(~own).groupBy("block").agg(F.sum(F.length("text")).alias("size")).filter(F.col("size") > block_chars).isEmpty():
            return numbered, [r["block"] for r in numbered.select("block").distinct().collect()]
        n *= 2


def _finder(docs: DataFrame, rows: list[tuple[int, str]], edit_rate: float):
    """The column function that finds the items of one block in whole texts, and what its tasks hold of it."""
    sent = docs.sparkSession.sparkContext.broadcast(rows)

    @F.pandas_udf("array<struct<item_id: bigint, edits: int>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items, short = Items.of(sent.value, edit_rate), short_items(sent.value)
        for batch in batches:
            out = []
            for value in batch:
                best: dict[int, int] = {}
                for item, edits in items.find(value).items():
                    best[items.ids[item]] = min(edits, best.get(items.ids[item], edits))
                if short:
                    whole = normalise(value)
                    best.update((key, 0) for key, t in short if t in whole)
                out.append([{"item_id": i, "edits": e} for i, e in sorted(best.items())])
            yield pd.Series(out)

    return found, sent


def with_leaks(
    docs: DataFrame, benchmark: DataFrame, edit_rate: float = EDIT_RATE, text: str = "text", leaks: str = "leaks", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Add the items each whole text holds: array of (item_id, edits), in order of id, empty where there is none.

    A column named as `leaks` is replaced. Null and empty texts hold nothing, an empty benchmark and an empty item are held
    by no text, and of items with one id the best match is given. A benchmark of one block, as its size was counted to be, is
    sent to the tasks, and documents are read once and not shuffled. A larger one takes a pass per block, which sends that
    block alone and writes only what it found, by the text's digest; the findings then meet the documents in a join.
    """
    items, places = dealt(benchmark, block_chars)
    if len(places) == 1:
        found, _ = _finder(docs, [tuple(r) for r in items.drop("block").collect()], edit_rate)
        return docs.withColumn(leaks, found(F.col(text)))
    hits = None
    for block in places:
        found, sent = _finder(docs, [tuple(r) for r in items.filter(F.col("block") == block).drop("block").collect()], edit_rate)
        one = docs.select(F.sha2(F.col(text).cast("binary"), 256).alias("_digest"), found(F.col(text)).alias("_found"))
        one = staged(one.filter(F.size("_found") > 0).select("_digest", F.explode("_found").alias("_hit")).distinct(), "leaks")
        sent.destroy()
        hits = one if hits is None else hits.union(one)
    digest, told = unused(docs, "_digest"), unused(docs, "_leaks")
    hits = hits.groupBy("_digest", "_hit.item_id").agg(F.min("_hit.edits").alias("edits"))
    hits = hits.groupBy(F.col("_digest").alias(digest)).agg(F.array_sort(F.collect_list(F.struct("item_id", "edits"))).alias(told))
    met = docs.withColumn(digest, F.sha2(F.col(text).cast("binary"), 256)).join(hits.hint("merge"), digest, "left")
    none = F.expr("cast(array() AS array<struct<item_id: bigint, edits: int>>)")
    rest = [F.col(f"`{c}`") for c in docs.columns if c != leaks]
    return met.select(*rest, F.coalesce(F.col(told), none).alias(leaks))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = with_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return docs.select(
        "doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").cast("long").alias("n_items"),
        F.col("leaks.item_id").alias("item_ids"), F.array_min("leaks.edits").alias("fewest_edits"),
    )
