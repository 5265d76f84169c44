"""Cross-tokenizer alignment: which tokens of two vocabularies meet, counted by external spilling.

A task encodes its documents with both tokenizers, lays the tokens' byte ranges over each other, and collects the linked
pairs of ids of a block of documents. The block's pair-document records are combined per pair, radix-partitioned, sorted by
side A and then B, and spilled as zstd runs. The task of a radix merges its runs with a heap: equal pairs follow each
other, so a pair's documents are counted and an A id's highest count is known when its pairs end. Counts go back to each
run in the run's own order, and the block that spilled it adds them up per document. A pair comes once per block, however
many documents hold it, and pairs of one A id spread over all radixes; their partial maxima meet in a table of one row per
A id, which is bounded by the vocabulary.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm.bpe import NAME, Encoder, Merges, character_classes, class_table
from paylake.llm.common import merge_joins, small_batches, staged, table
from paylake.llm.packing import VOCABULARY

PIECES = "piece_bpe_32k.model"
#: Links gathered in a block before it is spilled, unless one document has more.
BLOCK_LINKS = 1 << 20
#: Entries of a run that are decoded at a time while runs are merged.
DECODED = 1 << 12
#: Fixed value: how the pieces of vocabulary B write a blank.
BLANK = "▁"


class SideA:
    """Byte-level ids of space and text; strings of special tokens are ordinary text."""

    def __init__(self, folder: str, name: str, runs: tuple[list[int], list[int]]):
        merges = Merges(folder, name)
        self.encode, self.bytes_of = Encoder(merges, class_table(runs), special=False), merges.bytes_of

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, "<u4") for ids in self.encode([" " + t for t in texts])]


class SideB:
    """Piece ids of the text; the tokenizer adds the space itself."""

    def __init__(self, folder: str, name: str):
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, name))
        one = self.pieces
        self.bytes_of = [
            bytes([int(p[3:-1], 16)]) if one.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in ((i, one.id_to_piece(i)) for i in range(one.get_piece_size()))
        ]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, "<u4") for ids in self.pieces.encode(texts, num_threads=1)]


@dataclass
class Aligned:
    """One document: linked A and B token numbers by byte, and the ends of its groups as token counts of both sides."""

    a: np.ndarray
    b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    groups_a: np.ndarray
    groups_b: np.ndarray


NOTHING = Aligned(*(np.zeros(0, np.int64) for _ in range(6)))


def align(text: str, a: np.ndarray, b: np.ndarray, bytes_a: list[bytes], bytes_b: list[bytes], sizes: tuple[np.ndarray, np.ndarray]) -> Aligned:
    """Overlay both tokenisations. Texts that are empty, or that either side does not spell as space and text, have none."""
    whole = (" " + text).encode()
    if not text or b"".join(map(bytes_a.__getitem__, a.tolist())) != whole or b"".join(map(bytes_b.__getitem__, b.tolist())) != whole:
        return NOTHING
    # Which sides have a token that ends at a byte: 1 for A, 2 for B.
    ended = np.zeros(len(whole) + 1, np.uint8)
    ended[np.cumsum(sizes[0][a])] = 1
    ended[np.cumsum(sizes[1][b])] |= 2
    ended = ended[np.flatnonzero(ended)]
    # Between two ends that follow each other lies one overlap of one A with one B token.
    upto_a, upto_b = np.cumsum(ended & 1, dtype=np.int64), np.cumsum(ended >> 1, dtype=np.int64)
    both = np.flatnonzero(ended == 3)
    return Aligned(a, b, np.concatenate(([0], upto_a[:-1])), np.concatenate(([0], upto_b[:-1])), upto_a[both], upto_b[both])


class Spelling:
    """Groups as text, `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, largest: int):
        digits = [str(i) for i in range(largest)]
        self.with_mark = [d + m for m in ",|;" for d in digits]
        self.largest = largest

    def __call__(self, x: Aligned) -> str:
        if not len(x.groups_a):
            return ""
        mark_a, mark_b = np.zeros(len(x.a), np.int64), np.zeros(len(x.b), np.int64)
        mark_a[x.groups_a - 1], mark_b[x.groups_b - 1] = 1, 2
        # A group's A tokens come before its B tokens, after all tokens of earlier groups.
        sizes_a, sizes_b = np.diff(x.groups_a, prepend=0), np.diff(x.groups_b, prepend=0)
        spelled = np.empty(len(x.a) + len(x.b), np.int64)
        spelled[np.arange(len(x.a)) + np.repeat(x.groups_b - sizes_b, sizes_a)] = x.a + mark_a * self.largest
        spelled[np.arange(len(x.b)) + np.repeat(x.groups_a, sizes_b)] = x.b + mark_b * self.largest
        return "".join(map(self.with_mark.__getitem__, spelled.tolist()))[:-1]


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def mixed(pairs: np.ndarray) -> np.ndarray:
    """Spread pairs over radixes: those of one A id as well."""
    h = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)


_SPILL = pa.schema(
    [
        ("block", pa.int64()), ("radix", pa.int32()), ("pairs", pa.binary()), ("counts", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
        ("totals", pa.binary()), ("digests", pa.list_(pa.string())), ("records", pa.binary()), ("links", pa.binary()),
    ]
)
_SPILL_DDL = (
    "block bigint, radix int, pairs binary, counts binary, doc_ids array<bigint>, totals binary, digests array<string>, "
    "records binary, links binary"
)
#: Radix of the row that keeps a block's documents.
KEPT = -1


class Block:
    """Documents whose records are spilled together."""

    def __init__(self, number: int, radixes: int, shift: int):
        self.number, self.radixes, self.shift, self.links = number, radixes, shift, 0
        self.ids: list[int | None] = []
        self.totals: list[tuple[int, ...]] = []
        self.digests: list[str] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, doc_id: int | None, x: Aligned, digest: str) -> None:
        pairs, times = np.unique(x.a[x.link_a].astype(np.uint64) << np.uint64(self.shift) | x.b[x.link_b].astype(np.uint64), return_counts=True)
        self.ids.append(doc_id)
        self.totals.append((len(x.a), len(x.b), len(x.groups_a), len(x.link_a), len(pairs)))
        self.digests.append(digest)
        self.pairs.append(pairs)
        self.times.append(times)
        self.links += len(x.link_a)

    def spilled(self) -> pa.RecordBatch:
        """A run per radix: its sorted pairs and in how many of the block's documents each is; and one row of documents,
        whose records point into the runs laid end to end."""
        pairs, inverse = np.unique(np.concatenate(self.pairs), return_inverse=True)
        counts, radix = np.bincount(inverse, minlength=len(pairs)), mixed(pairs) % np.uint64(self.radixes)
        order = np.argsort(radix, kind="stable")
        place = np.empty(len(order), "<u4")
        place[order] = np.arange(len(order))
        pairs, counts, radix = pairs[order], counts[order].astype("<u4"), radix[order]
        cuts = np.flatnonzero(np.concatenate(([True], radix[1:] != radix[:-1]))).tolist() if len(radix) else []
        rows = [
            (self.number, int(radix[i]), _packed(np.diff(pairs[i:j], prepend=np.uint64(0))), _packed(counts[i:j]), None, None, None, None, None)
            for i, j in zip(cuts, [*cuts[1:], len(pairs)])
        ]
        totals, times = np.array(self.totals, "<i8"), np.concatenate(self.times).astype("<u4")
        rows.append((self.number, KEPT, None, None, self.ids, _packed(totals), self.digests, _packed(place[inverse]), _packed(times)))
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _SPILL, strict=True)], schema=_SPILL)


def spill(docs: DataFrame, side_a: Callable[[], SideA], side_b: Callable[[], SideB], radixes: int, doc_id: str, text: str) -> DataFrame:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, block = side_a(), side_b(), None
        shift, first = (len(b.bytes_of) - 1).bit_length(), TaskContext.get().partitionId() << 33
        sizes = tuple(np.array([len(t) for t in side.bytes_of], np.int64) for side in (a, b))
        spell = Spelling(max(len(a.bytes_of), len(b.bytes_of)))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for key, body, ids_a, ids_b in zip(batch.column(0).to_pylist(), texts, a(texts), b(texts), strict=True):
                x = align(body, ids_a, ids_b, a.bytes_of, b.bytes_of, sizes)
                spelled = spell(x)
                block = block or Block(first, radixes, shift)
                block.add(key, x, hashlib.sha256(spelled.encode()).hexdigest() if spelled else "")
                if block.links >= BLOCK_LINKS:
                    yield block.spilled()
                    first, block = first + 1, None
        if block:
            yield block.spilled()

    return docs.selectExpr(f"cast(`{doc_id}` as bigint)", f"`{text}`").mapInArrow(blocks, _SPILL_DDL)


def _entries(run: int, runs: int, pairs: bytes, counts: bytes) -> Iterator[tuple[int, int]]:
    """The run's pairs, each made distinct by the run, with counts. Few are decoded at a time."""
    keys, ns, last = zstandard.ZstdDecompressor().stream_reader(pairs), zstandard.ZstdDecompressor().stream_reader(counts), np.uint64(0)
    while data := keys.read(8 * DECODED):
        part = last + np.cumsum(np.frombuffer(data, "<u8"), dtype=np.uint64)
        last = part[-1]
        yield from zip((part.astype(np.int64) * runs + run).tolist(), np.frombuffer(ns.read(4 * len(part)), "<u4").tolist(), strict=True)


def merge_runs(runs: list[tuple[bytes, bytes]], shift: int) -> tuple[list[np.ndarray], dict[int, int]]:
    """Counts of each run's pairs over all runs, in the run's order, and the highest count of each A id."""
    answers = [array("Q") for _ in runs]
    highest: dict[int, int] = {}
    pair, total, holders = -1, 0, []

    def ended() -> None:
        for run in holders:
            answers[run].append(total)
        if holders:
            highest[pair >> shift] = max(total, highest.get(pair >> shift, 0))

    for key, n in heapq.merge(*(_entries(i, len(runs), *run) for i, run in enumerate(runs))):
        now, run = divmod(key, len(runs))
        if now != pair:
            ended()
            pair, total, holders = now, 0, []
        total += n
        holders.append(run)
    ended()
    return [np.frombuffer(a, "<u8") for a in answers], highest


def count(spilled: DataFrame, radixes: int, shift: int) -> DataFrame:
    """(block, radix, totals) with counts in the run's order, and (null, A id, highest) rows, per radix."""

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks, runs = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if runs:
                answers, highest = merge_runs(runs, shift)
                rows = [(block, now, _packed(a), None) for block, a in zip(blocks, answers, strict=True)]
                rows += [(None, a, None, n) for a, n in highest.items()]
                for i in range(0, len(rows), DECODED):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows[i : i + DECODED], strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.int64()), strict=True)],
                        ["block", "radix", "counts", "highest"],
                    )

        for batch in batches:
            for radix, block, pairs, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if radix != now:
                    yield from done()
                    now, blocks, runs = radix, [], []
                blocks.append(block)
                runs.append((pairs, counts))
        yield from done()

    runs = spilled.filter(F.col("radix") != KEPT).select("radix", "block", "pairs", "counts")
    return runs.repartitionById(radixes, "radix").sortWithinPartitions("radix", "block").mapInArrow(merged, "block bigint, radix int, counts binary, highest bigint")


_RESULT_DDL = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def contribute(spilled: DataFrame, counted: DataFrame, highest: DataFrame, shift: int, partitions: int) -> DataFrame:
    """Add the counts that came back to a block's documents. `highest` has one row per A id."""
    # At most one number per id of vocabulary A.
    top = {r["a"]: r["n"] for r in highest.collect()}
    tops = np.zeros(1 + max(top, default=0), np.int64)
    tops[list(top)] = list(top.values())
    sent = spilled.sparkSession.sparkContext.broadcast(tops)
    answers = counted.filter("block IS NOT NULL")
    runs = spilled.filter(F.col("radix") != KEPT).select("block", "radix", "pairs").join(answers.hint("merge"), ["block", "radix"])
    kept = spilled.filter(F.col("radix") == KEPT)
    both = kept.select("block", "radix", "pairs", F.lit(None).cast("binary").alias("counts"), "doc_ids", "totals", "digests", "records", "links").union(
        runs.select("block", "radix", "pairs", "counts", *[F.lit(None).cast(kept.schema[c].dataType).alias(c) for c in ("doc_ids", "totals", "digests", "records", "links")])
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, counts, best, now = None, [], [], None

        def done() -> pa.RecordBatch:
            ids, totals, digests, records, links = docs
            totals = _unpacked(totals, "<i8").reshape(-1, 5)
            at, times = _unpacked(records, "<u4"), _unpacked(links, "<u4").astype(np.int64)
            empty = [np.zeros(0, np.int64)]
            doc = np.repeat(np.arange(len(ids)), totals[:, 4])
            n, top = np.concatenate(counts or empty)[at], np.concatenate(best or empty)[at]
            sums, tops = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            np.add.at(sums, doc, n * times)
            np.add.at(tops, doc, top * times)
            columns = [pa.array(ids, pa.int64()), *(pa.array(totals[:, i]) for i in range(4)), pa.array(tops), pa.array(sums), pa.array(digests)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

        for batch in batches:
            for block, radix, pairs, found, *kept in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if radix == KEPT:
                    if docs:
                        yield done()
                    docs, counts, best, now = kept, [], [], block
                    continue
                assert block == now
                a = np.cumsum(_unpacked(pairs, "<u8"), dtype=np.uint64) >> np.uint64(shift)
                counts.append(_unpacked(found, "<u8").astype(np.int64))
                best.append((sent.value[a.astype(np.int64)] == counts[-1]).astype(np.int64))
        if docs:
            yield done()

    return both.repartition(partitions, "block").sortWithinPartitions("block", "radix").mapInArrow(summed, _RESULT_DDL)


def alignment(
    docs: DataFrame, folder: str = VOCABULARY, name_a: str = NAME, name_b: str = PIECES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: tokens of both sides, groups, links, and how links count in the whole table.

    Null and empty texts, and texts that a side cannot spell exactly, have zeros and an empty digest. Rows with equal or null
    ids are separate documents, and each counts; ties for an A id's highest count are all best. An empty table gives no
    rows. Only the two named columns are read, whatever others are called.
    """
    spark, classes = docs.sparkSession, character_classes(folder, name_a)
    radixes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    side_b = SideB(folder, name_b)
    shift = (len(side_b.bytes_of) - 1).bit_length()
    with merge_joins(spark):
        spilled = staged(spill(docs, lambda: SideA(folder, name_a, classes), lambda: SideB(folder, name_b), radixes, doc_id, text), "alignment-runs")
        counted = staged(count(spilled, radixes, shift), "alignment-counts")
        highest = counted.filter("block IS NULL").groupBy(F.col("radix").alias("a")).agg(F.max("highest").alias("n"))
        return contribute(spilled, counted, highest, shift, radixes)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(small_batches(spark), sf_dir, "documents"))
