"""Removal of repeated byte strings by suffix sorting, deep and shallow.

All suffixes of a corpus cannot be sorted for every string that occurs once, so strings first meet by content: every window
of `length` bytes picks an anchor, its gram with the smallest hash, and equal windows pick equal anchors. Anchors that occur
once end there. Of the others, the stretch of bytes whose windows share an anchor is a snippet; occurrences of one snippet
are settled by the first of them. Only different snippets around one anchor hash need their bytes: their windows are
suffixes of known depth, dealt to tasks by the bytes they must share, and sorted there, by multikey quicksort to a shallow
depth and by blind tries below. Windows that end up equal are repeats of the earliest. Where many rows share such bytes, as at
the edges of a passage that is everywhere, no task gathers them: each window is dealt by a hash of all its bytes, and a task
sends on the earliest of the equal ones it holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm.common import small_batches, staged, table

LENGTH = 100
GRAM = 32
#: Windows of a snippet are dealt in ranges of this many starts, which share the bytes all of them cover.
RANGE = 35
#: Depth of the multikey quicksort in 8-byte words; blind tries order what is still equal there.
SHALLOW = 4
#: Windows sorted together in a task, unless one group has more.
WINDOWS = 400_000
#: Anchors a task combines before they are shuffled. Of a snippet that is everywhere, one occurrence per so many goes on.
COMBINED = 1 << 19
#: Different snippets of one anchor hash beyond this many in a combination are spread by content.
KINDS = 256
#: Cores are counted in so many slots; the windows of a slot with more rows than HOT_ROWS are dealt one by one.
SLOTS = 1 << 20
HOT_ROWS = 2_000
#: Longer texts are scanned in pieces of so many windows.
PIECE = 1 << 18
_INDEX = np.uint64((1 << 20) - 1)
_BASE = 0x100000001B3
_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    if len(_tables[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _tables[k] = np.cumprod(steps, dtype=np.uint64)
    return _tables


def stretch_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each data[start:end], from running sums."""
    up, down = _powers(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)))
    return _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """For each anchor: its hash, place, the first and last start of the windows that pick it, and its snippet's hash."""
    out = []
    for at in range(0, len(data) - length + 1, PIECE):
        piece = data[at : at + PIECE + length - 1]
        h, size = piece.astype(np.uint64) + np.uint64(1), 1
        while size < GRAM:
            h = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
            size *= 2
        h = _mix(h)
        # Of equal hashes in a window the last counts: the lower bits fall with the place.
        low = (h & ~_INDEX) | (_INDEX - np.arange(len(h), dtype=np.uint64))
        width, wide = 1, length - GRAM + 1
        while 2 * width <= wide:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        n = len(piece) - length + 1
        picked = (_INDEX - (np.minimum(low[:n], low[wide - width :][:n]) & _INDEX)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(picked)) + 1))
        last = np.concatenate((first[1:] - 1, [n - 1]))
        place = picked[first]
        out.append((h[place].view(np.int64), place + at, first + at, last + at, stretch_hashes(piece, first, last + length).view(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else tuple(np.zeros(0, np.int64) for _ in range(5))


def _bytes(text: pa.Scalar) -> np.ndarray:
    buffer = text.as_buffer()
    return np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)


def quicksort(words: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of suffixes within groups, all groups a step at a time, to `depth` words of 8 bytes.

    A segment splits around a pivot word into less, equal and greater; the equal part goes on to the next word. Returns the
    order and a number per place that tells segments apart; suffixes of one segment agree to the depth.
    """
    order = np.argsort(group, kind="stable")
    segment = np.concatenate(([0], np.cumsum(np.diff(group[order]) != 0)))
    level = np.zeros(len(order), np.int64)
    done = np.zeros(len(order), bool)
    while len(order):
        first = np.concatenate(([0], np.flatnonzero(np.diff(segment)) + 1))
        sizes = np.diff(np.append(first, len(order)))
        done = np.repeat(sizes == 1, sizes) | (level >= depth)
        active = np.flatnonzero(~done)
        if not len(active):
            break
        word = words[starts[order[active]] + 8 * level[active]]
        seg = segment[active]
        begin = np.concatenate(([0], np.flatnonzero(np.diff(seg)) + 1))
        count = np.diff(np.append(begin, len(active)))
        pivot = np.repeat(word[begin + count // 2], count)
        side = np.where(word < pivot, 0, np.where(word == pivot, 1, 2))
        moved = np.argsort(seg * 3 + side, kind="stable")
        order[active], level[active] = order[active][moved], (level[active] + (side == 1))[moved]
        # Three parts of a segment are told apart by their side; the others keep their number.
        key = segment * 3
        key[active] = (seg * 3 + side)[moved]
        segment = np.concatenate(([0], np.cumsum(np.diff(key) != 0)))
    return order, segment


class BlindTrie:
    """Strings of one length by the bytes at which they part. Descent looks at those bytes only; one comparison with the
    leaf it ends in then tells where a new string really leaves."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, text: bytes, item: int) -> None:
        """Nodes are [depth, children by byte]; leaves are [None, text, items]."""
        if self.root is None:
            self.root = [None, text, [item]]
            return
        node = self.root
        while node[0] is not None:
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        if node[1] == text:
            node[2].append(item)
            return
        differ = int.from_bytes(node[1], "big") ^ int.from_bytes(text, "big")
        at = len(text) - (differ.bit_length() + 7) // 8
        other, parent, byte, node = node[1][at], None, 0, self.root
        while node[0] is not None and node[0] < at:
            parent, byte, node = node, text[node[0]], node[1][text[node[0]]]
        leaf = [None, text, [item]]
        if node[0] == at:
            node[1][text[at]] = leaf
            return
        fork = [at, {other: node, text[at]: leaf}]
        if parent is None:
            self.root = fork
        else:
            parent[1][byte] = fork

    def leaves(self) -> Iterator[list[int]]:
        """Items of equal strings, in order of their strings."""
        waiting = [self.root] if self.root else []
        while waiting:
            node = waiting.pop()
            if node[0] is None:
                yield node[2]
            else:
                waiting.extend(node[1][b] for b in sorted(node[1], reverse=True))


def equal_windows(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int = LENGTH) -> Iterator[np.ndarray]:
    """Numbers of windows, two at least, that are equal and of one group."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.zeros(len(data), np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | padded[i : i + len(data)]
    depth = min(SHALLOW, length // 8)
    order, segment = quicksort(words, starts, group, depth)
    first = np.concatenate(([0], np.flatnonzero(np.diff(segment)) + 1))
    sizes = np.diff(np.append(first, len(order)))
    raw = data.tobytes()
    for begin, size in zip(first[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
        members, trie = order[begin : begin + size].tolist(), BlindTrie()
        for m in members:
            trie.add(raw[starts[m] + 8 * depth : starts[m] + length], m)
        for items in trie.leaves():
            if len(items) > 1:
                yield np.array(items)


# A span is the place of an anchor, the bytes before it from where its first window starts, the number of its windows less
# one, and whether all of them are repeats: 38, 12, 12 and 1 bits.
_ROWS = "key bigint, doc bigint, sn bigint, span bigint"
LONGEST = 1 << 12
#: The sign of a span on its way to `meet`: its anchor hash has several snippets.
_SEVERAL = np.int64(-1 << 63)


def _span(place: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return (place << 25) | ((place - lo) << 13) | ((hi - lo) << 1)


def _unspan(span: int) -> tuple[int, int, int]:
    place = span >> 25
    lo = place - (span >> 13 & 0xFFF)
    return place, lo, lo + (span >> 1 & 0xFFF)


def _spread(doc: np.ndarray, span: np.ndarray) -> np.ndarray:
    return _mix(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + span.view(np.uint64)).view(np.int64)


def settled(key: np.ndarray, doc: np.ndarray, sn: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, of which the first occurrence of each snippet, and which are later ones. Rows of one place are alike."""
    order = np.lexsort((span, doc, sn, key))
    key, doc, sn, span = key[order], doc[order], sn[order], span[order]
    new = np.concatenate(([True], (np.diff(key) != 0) | (np.diff(sn) != 0))) if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    return order, new, (doc != doc[first]) | (span != span[first])


_PARTS = "core bigint, doc bigint, span bigint, sn bigint, first int, bytes binary"
_RUNS = "doc bigint, span bigint, sn bigint, runs array<int>"
#: runs: the start of one window that is still open, or else the runs found.
_WINDOWS = "key bigint, doc bigint, span bigint, sn bigint, runs array<int>"


def _batch(columns: list, ddl: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    names, types = zip(*(c.split(" ") for c in ddl.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names))


def repeated_strings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_bytes, removed (array of start and end, end exclusive), kept.

    A byte is removed if a string of `length` bytes that covers it also starts earlier: in a smaller doc_id, or earlier in
    the same document. kept: the other bytes. Null texts are empty. Rows of one doc_id are alike: where they hold the same
    string at the same place neither is earlier. A row without doc_id is compared with nothing. Other columns are not read.
    """
    if not GRAM + 8 <= length <= LONGEST:
        raise ValueError(f"strings have {GRAM + 8} to {LONGEST} bytes")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    named = docs.filter("doc_id IS NOT NULL")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                h, place, lo, hi, sn = anchors(_bytes(text), length)
                waiting.append((h, np.full(len(h), doc, np.int64), sn, _span(place, lo, hi)))
                size += len(h)
            if size >= COMBINED:
                yield from combined(waiting)
                waiting, size = [], 0
        if size:
            yield from combined(waiting)

    def combined(waiting: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, doc, sn, span = (np.concatenate(c) for c in zip(*waiting, strict=True))
        order, first, later = settled(key, doc, sn, span)
        # Later occurrences need no other task; they travel by their own hash, so no key gathers them.
        some, more = order[first], order[later]
        whole = span[more] | 1
        # An anchor hash with many snippets has several for certain, so all but one of them can do without its other tasks.
        begin = np.flatnonzero(np.concatenate(([True], np.diff(key[some]) != 0)))
        kinds = np.diff(np.append(begin, len(some)))
        many = np.repeat(kinds, kinds) > KINDS
        span[some[many]] |= _SEVERAL
        many[begin] = False
        key[some[many]] = _mix(key[some[many]].view(np.uint64) + sn[some[many]].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
        rows = [np.concatenate(c) for c in ((key[some], _spread(doc[more], whole)), (doc[some], doc[more]), (sn[some], sn[more]), (span[some], whole))]
        for at in range(0, len(rows[0]), 1 << 16):
            yield _batch([c[at : at + (1 << 16)] for c in rows], _ROWS)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cut = np.searchsorted(rows[0], rows[0][-1])
            if cut and sum(len(w[0]) for w in waiting) + cut >= COMBINED // 4:
                yield decided([*waiting, [c[:cut] for c in rows]])
                waiting, rows = [], [c[cut:] for c in rows]
            waiting.append(rows)
        if waiting:
            yield decided(waiting)

    def decided(waiting: list[list[np.ndarray]]) -> pa.RecordBatch:
        """Spans to remove, and those whose anchor hash has several snippets; the rest occurs once."""
        key, doc, sn, span = (np.concatenate(c) for c in zip(*waiting, strict=True))
        known = span & 1 == 1
        done = [c[known] for c in (key, doc, sn, span)]
        key, doc, sn, span = (c[~known] for c in (key, doc, sn, span))
        several = np.unique(key[span < 0])
        span = span & ~_SEVERAL
        order, first, later = settled(key, doc, sn, span)
        some, more = order[first], order[later]
        begin = np.flatnonzero(np.concatenate(([True], np.diff(key[some]) != 0))) if len(some) else np.zeros(0, np.int64)
        kinds = np.diff(np.append(begin, len(some)))
        some = some[(np.repeat(kinds, kinds) > 1) | np.isin(key[some], several)]
        picked = [np.concatenate((d, c[more], c[some])) for d, c in zip(done, (key, doc, sn, span), strict=True)]
        picked[3][len(done[0]) : len(done[0]) + len(more)] |= 1
        return _batch(picked, _ROWS)

    every = named.mapInArrow(scan, _ROWS).repartition("key").sortWithinPartitions("key")
    found = staged(every.mapInArrow(meet, _ROWS), "snippets")
    whole = found.filter("span & 1 = 1").select("doc", "span", "sn", F.lit(None).cast("array<int>").alias("runs"))

    # Different snippets around one anchor hash: their bytes are fetched, first occurrences only. The documents are dealt
    # by id once, for this and for the removal.
    asked = found.filter("span & 1 = 0").groupBy("doc").agg(F.collect_list(F.struct("span", "sn")).alias("asked"))
    dealt = named.repartition("doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                rows += snippet_parts(doc, _bytes(text), wanted, length)
            for at in range(0, len(rows), 4096):
                yield _batch(list(zip(*rows[at : at + 4096], strict=True)), _PARTS)

    parts = dealt.join(asked, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "asked").mapInArrow(cut, _PARTS)
    parts = staged(parts, "snippet-parts")
    # A core that many documents share is not gathered. Of slots only the crowded come to the driver, a bounded number.
    slot = F.pmod("core", F.lit(SLOTS))
    crowded = np.zeros(SLOTS, bool)
    crowded[parts.groupBy(slot.alias("slot")).count().filter(F.col("count") > HOT_ROWS).toArrow()["slot"].to_numpy()] = True
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(crowded))

    def chosen(batches: Iterator[pa.RecordBatch], hot: bool) -> Iterator[pa.RecordBatch]:
        crowded = np.unpackbits(sent.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(crowded[batch.column(0).to_numpy() % SLOTS] == hot))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, windows = [], 0
        for batch in chosen(batches, True):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                waiting.append(row)
                windows += len(row[5]) - length + 1
                if windows >= WINDOWS:
                    yield from single_windows(waiting, length)
                    waiting, windows = [], 0
        if waiting:
            yield from single_windows(waiting, length)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            keys = batch.column(0).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut and sum(w.num_rows for w in waiting) + cut >= WINDOWS:
                yield later_windows([*waiting, batch.slice(0, cut)])
                waiting, batch = [], batch.slice(cut)
            waiting.append(batch)
        if waiting:
            yield later_windows(waiting)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, windows = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if windows >= WINDOWS and row[0] != waiting[-1][0]:
                    yield repeats(waiting, length)
                    waiting, windows = [], 0
                waiting.append(row)
                windows += len(row[5]) - length + 1
        if waiting:
            yield repeats(waiting, length)

    few = parts.mapInArrow(lambda batches: chosen(batches, False), _PARTS) if crowded.any() else parts
    runs = few.repartition("core").sortWithinPartitions("core").mapInArrow(sort, _RUNS)
    if crowded.any():
        alone = parts.mapInArrow(spread, _WINDOWS).repartition("key").sortWithinPartitions("key")
        runs = runs.union(alone.mapInArrow(judge, _RUNS))
    spans = whole.union(runs).groupBy("doc").agg(F.collect_list(F.struct("span", "sn", "runs")).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
        for batch in batches:
            made = []
            for doc, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = _bytes(text)
                removed, kept = without(data, wanted or [], length)
                made.append((doc, len(data), removed, kept))
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t.type) for i, t in enumerate(kinds)], schema=kinds)

    ddl = "doc_id bigint, n_bytes bigint, removed array<struct<start: bigint, end: bigint>>, kept binary"
    out = dealt.join(spans, F.col("doc_id") == F.col("doc"), "left").select("doc_id", "text", "spans").mapInArrow(remove, ddl)
    unnamed = docs.filter("doc_id IS NULL").select("doc_id", "text", F.lit(None).cast("array<struct<span: bigint, sn: bigint, runs: array<int>>>").alias("spans"))
    return out.union(unnamed.mapInArrow(remove, ddl))


def _own(data: np.ndarray, wanted: list[dict], length: int) -> list[tuple]:
    """(asked, place, lo, hi) of those snippets that this text holds; another text of the same doc_id may have the others."""
    rows = [(w, *_unspan(w["span"])) for w in wanted]
    rows = [r for r in rows if r[3] + length <= len(data)]
    if not rows:
        return []
    lo, hi = (np.array([r[i] for r in rows], np.int64) for i in (2, 3))
    same = stretch_hashes(data, lo, hi + length).view(np.int64) == np.array([r[0]["sn"] for r in rows], np.int64)
    return [r for r, s in zip(rows, same.tolist(), strict=True) if s]


def snippet_parts(doc: int, data: np.ndarray, wanted: list[dict], length: int = LENGTH) -> list[tuple]:
    """Rows of a snippet's windows by range of their lead, the bytes before the anchor; `core` names the bytes shared."""
    cuts = []
    for w, place, lo, hi in _own(data, wanted, length):
        for r in range((place - hi) // RANGE, (place - lo) // RANGE + 1):
            first, last = max(lo, place - RANGE * r - RANGE + 1), min(hi, place - RANGE * r)
            cuts.append((w, r, first, last, place - RANGE * r, place - RANGE * r - RANGE + 1 + length, place))
    if not cuts:
        return []
    core = stretch_hashes(data, np.array([c[4] for c in cuts]), np.array([c[5] for c in cuts]))
    place = np.array([c[6] for c in cuts])
    core = _mix(core ^ (stretch_hashes(data, place, place + GRAM) + np.array([c[1] for c in cuts], np.uint64))).view(np.int64).tolist()
    raw = data.tobytes()
    return [(k, doc, w["span"], w["sn"], first, raw[first : last + length]) for k, (w, _, first, last, *_) in zip(core, cuts, strict=True)]


def _windows(rows: list[tuple], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window of the rows: its row, its number in there, and its place in their joined bytes."""
    sizes = np.array([len(r[5]) for r in rows], np.int64)
    base = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    count = sizes - length + 1
    row = np.repeat(np.arange(len(rows)), count)
    step = np.arange(len(row)) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return row, step, base[row] + step


def _found(rows: list[tuple], row: np.ndarray, start: np.ndarray, repeat: np.ndarray) -> list[tuple]:
    """(doc, span, sn, runs) of the rows with repeats."""
    made = []
    for i in np.unique(row[repeat]).tolist():
        begin, end = np.searchsorted(row, [i, i + 1])
        found = start[begin:end][repeat[begin:end]]
        edge = np.flatnonzero(np.diff(found) != 1)
        runs = np.stack((found[np.concatenate(([0], edge + 1))], found[np.concatenate((edge, [len(found) - 1]))]), 1).ravel().tolist()
        made.append((rows[i][1], rows[i][2], rows[i][3], runs))
    return made


def single_windows(rows: list[tuple], length: int = LENGTH) -> Iterator[pa.RecordBatch]:
    """Windows of crowded cores by a hash of core, lead and bytes: the first of each is left open, later ones are repeats."""
    row, step, at = _windows(rows, length)
    data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
    core, doc, span, sn, first = (np.array([r[i] for r in rows], np.int64) for i in range(5))
    start = first[row] + step
    lead = ((span >> 25)[row] - start).view(np.uint64)
    key = _mix(stretch_hashes(data, at, at + length) ^ _mix(core[row].view(np.uint64) + lead)).view(np.int64)
    low, repeat = _later(key, doc[row], start)
    made = _found(rows, row, start, repeat)
    # What is settled travels by its own hash, so no key gathers it.
    if made:
        docs, spans = (np.array([m[i] for m in made], np.int64) for i in (0, 1))
        yield _batch([_spread(docs, spans), *zip(*made, strict=True)], _WINDOWS)
    for i in range(0, len(low), 1 << 16):
        some = low[i : i + (1 << 16)]
        yield _batch([key[some], doc[row[some]], span[row[some]], sn[row[some]], [[s] for s in start[some].tolist()]], _WINDOWS)


def _later(key: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the earliest windows of each key, all of one place, and which windows are later ones."""
    order = np.lexsort((start, doc, key))
    new = np.concatenate(([True], np.diff(key[order]) != 0)) if len(order) else np.zeros(0, bool)
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = np.zeros(len(key), bool)
    later[order] = (doc[order] != doc[first]) | (start[order] != start[first])
    return np.flatnonzero(~later), later


def later_windows(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Runs of whole keys: those settled before, and each open window that is not the earliest of its key."""
    key, doc, span, sn = (np.concatenate([b.column(i).to_numpy() for b in batches]) for i in range(4))
    runs = [r for b in batches for r in b.column(4).to_pylist()]
    open_ = np.flatnonzero(np.array([len(r) == 1 for r in runs], bool))
    done = np.setdiff1d(np.arange(len(runs)), open_)
    start = np.array([runs[i][0] for i in open_.tolist()], np.int64)
    more = open_[_later(key[open_], doc[open_], start)[1]]
    picked = np.concatenate((done, more))
    ends = [runs[i] for i in done.tolist()] + [runs[i] * 2 for i in more.tolist()]
    return _batch([doc[picked], span[picked], sn[picked], ends], _RUNS)


def repeats(rows: list[tuple], length: int = LENGTH) -> pa.RecordBatch:
    """For rows of whole groups: the runs of window starts, first and last, that hold a repeat of an earlier window."""
    row, step, place = _windows(rows, length)
    core = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)[1]
    doc, span, first = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 4))
    # Windows can only be equal if they share core and lead.
    group = core[row] * (length + 1) + ((span >> 25) - first)[row] - step
    numbers, counts = np.unique(group, return_inverse=True, return_counts=True)[1:]
    several = np.flatnonzero(counts[numbers] > 1)
    repeat = np.zeros(len(row), bool)
    if len(several):
        data = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
        starts = place[several]
        for items in equal_windows(data, starts, numbers[several], length):
            own = several[items]
            at, start = doc[row[own]], first[row[own]] + step[own]
            low = np.lexsort((start, at))[0]
            repeat[own[(at != at[low]) | (start != start[low])]] = True
    made = _found(rows, row, first[row] + step, repeat)
    return _batch(list(zip(*made, strict=True)) if made else [[]] * 4, _RUNS)


def without(data: np.ndarray, wanted: list[dict], length: int = LENGTH) -> tuple[list[dict], bytes]:
    """Maximal removed runs and the bytes left, of a text with the spans found for its doc_id."""
    change = np.zeros(len(data) + 1, np.int64)
    for w, _, lo, hi in _own(data, wanted, length):
        ends = w["runs"] if w["runs"] is not None else [lo, hi]
        for a, b in zip(ends[::2], ends[1::2], strict=True):
            change[a] += 1
            change[b + length] -= 1
    gone = np.cumsum(change)[: len(data)] > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)], data[~gone].tobytes()


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_strings(table(small_batches(spark), sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda s, r: s + r["end"] - r["start"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
