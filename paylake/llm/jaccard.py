"""N-gram Jaccard join: size-aware heavy-light join over sets of word shingles.

Light sets enumerate their subsets of the size that two sets must share; sets that meet in a subset are linked without
further comparison. Heavy sets scan inverted lists, cut to the prefix in which two similar sets must meet, rarest shingles
first. The boundary between them is where enumeration stops being cheaper, by the sizes found in the data.

Lists of heavy sets are not expanded into all pairs. Each set is first compared with one leader, the most typical set of
its lists, so a family of near copies gets one label; then only sets of different labels meet, where the shingles they
share in their prefixes can still reach the threshold. Every link between different texts is found or implied by others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm.common import connected_components, merge_joins, small_batches, staged, table

WORDS = 4
#: Jaccard similarity in percent.
PERCENT = 85
#: The largest set that may be light, whatever its cost.
LARGEST_LIGHT = 24
#: What a list entry costs, in subset keys: it is shuffled twice and may lead to a comparison.
ENTRY_COST = 4
#: Shingles of slots with this many times the mean, and this many more, are common: their lists are not gathered to see
#: whether they have two sets.
COMMON_TIMES, COMMON_MORE = 8, 10_000
#: List entries looked at together in a task, unless one list has more.
GATHERED = 1 << 18
#: 64-bit words of the bitmap by which sets of one list are compared before they are paired.
BITMAP_WORDS = 4
#: Shingles are counted in so many slots to order prefixes; order decides cost, never results.
SLOT_BITS = 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x100000001B3
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles, A-Z lower-cased; of fewer words, one hash of them all; else none."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    space = _SPACE[data]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    if not len(starts):
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
    up, down = _power_tables(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)))
    each = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    width = min(words, len(each))
    out = np.full(len(each) - width + 1, width, np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(_BASE) + each[i : i + len(out)])
    return np.unique(out)


def digest(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    total = mix(tokens + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def needed(a: int, b: int, percent: int = PERCENT) -> int:
    """The least overlap of sets of sizes a and b at the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def partners(size: int, percent: int = PERCENT) -> range:
    return range(-(-percent * size // 100), 100 * size // percent + 1)


def prefix_size(size: int, percent: int = PERCENT) -> int:
    return size + percent * -size // 100 + 1


def boundary(histogram: dict[int, int], percent: int = PERCENT) -> int:
    """The size up to which sets are light: there the summed cost of subsets and list entries is lowest."""
    best, best_cost, cost = 0, 0, 0
    for size in range(1, LARGEST_LIGHT + 1):
        subsets = sum(comb(size, needed(size, t, percent)) * (1 + (t == size)) for t in partners(size, percent) if needed(size, t, percent) <= size)
        cost += histogram.get(size, 0) * (subsets - ENTRY_COST * prefix_size(size, percent))
        if cost <= best_cost:
            best, best_cost = size, cost
    return best


def subset_keys(tokens: np.ndarray, light: int, percent: int = PERCENT) -> tuple[list[int], list[int]]:
    """Keys of a light set as the smaller and as the larger side of a pair; two sets that share one on opposite sides link."""
    low, high, size = [], [], len(tokens)
    values = mix(tokens).tolist()
    for t in partners(size, percent):
        share = needed(size, t, percent)
        if t > light or share > min(size, t):
            continue
        pair = hash((min(size, t), max(size, t))) & 0xFFFFFFFF
        sums = np.array([sum(c) & 0xFFFFFFFFFFFFFFFF for c in combinations(values, share)], np.uint64)
        keys = mix(mix(sums) + np.uint64(pair)).view(np.int64).tolist()
        if size <= t:
            low += keys
        if size >= t:
            high += keys
    return low, high


_SETS = pa.schema(
    [
        ("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("typical", pa.float64()),
        ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())),
    ]
)
_SETS_DDL = "doc_id bigint, node bigint, n bigint, typical double, low array<bigint>, high array<bigint>"
_ENTRIES_DDL = "key bigint, token bigint, node bigint"


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _count_slots(words: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, sizes = np.zeros(1 << SLOT_BITS, np.int64), np.zeros(LARGEST_LIGHT + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                tokens = shingles(text.as_py(), words)
                np.add.at(slots, _slots(tokens), 1)
                if len(tokens) <= LARGEST_LIGHT:
                    sizes[len(tokens)] += 1
        found, small = np.flatnonzero(slots), np.flatnonzero(sizes)
        # Sizes of small sets go along under negative numbers.
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((found, -1 - small))), pa.array(np.concatenate((slots[found], sizes[small])))], ["slot", "n"])

    return count


def feasible(x: str, y: str, common: str, percent: int = PERCENT) -> Column:
    """Whether sets of sizes x.n and y.n with `common` shingles shared in their prefixes can reach the threshold.

    Of two similar sets, one's prefix ends first in the order of shingles; what they share beyond it is in its rest.
    """
    rest = lambda s: f"(({percent} * {s}.n + 99) div 100 - 1)"
    need = f"({percent} * ({x}.n + {y}.n) + {99 + percent}) div {100 + percent}"
    return F.expr(f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n) AND {common} >= {need} - greatest({rest(x)}, {rest(y)})")


def _columns(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "token", "node"])


def _shared(waiting: list[list[np.ndarray]]) -> pa.RecordBatch:
    """Of whole lists, the entries of those with two sets; those of common shingles were not gathered and stay."""
    key, token, node = (np.concatenate(c) for c in zip(*waiting, strict=True))
    order = np.lexsort((node, token))
    key, token, node = key[order], token[order], node[order]
    begin = np.flatnonzero(np.concatenate(([True], np.diff(token) != 0)))
    size = np.diff(np.append(begin, len(token)))
    several = np.repeat(node[begin] != node[begin + size - 1], size)
    keep = several | (key != token)
    return pa.RecordBatch.from_arrays([pa.array(token[keep]), pa.array(node[keep])], ["token", "node"])


def verified(pairs: DataFrame, texts: DataFrame, others: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the threshold, compared whole. texts, others: (node, text) of a and of b."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for a, b, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = shingles(left, words), shingles(right, words)
                both = len(np.intersect1d(x, y, assume_unique=True))
                # A doc_id may come with several texts; only that of the named set counts.
                if 100 * both >= percent * (len(x) + len(y) - both) and digest(x) == a and digest(y) == b:
                    kept.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in kept], pa.int64()) for i in (0, 1)], ["a", "b"])

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = others.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return staged(rows.mapInArrow(compare, "a bigint, b bigint"), "jaccard-links")


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id.

    A null or empty text and one without words has an empty set, which links with nothing. Rows with equal sets are one
    class, compared once. A row without doc_id links with nothing and has no component. Rows that share a doc_id are separate
    documents. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    with merge_joins(spark):
        rows, known = _classes(docs, words, percent)
    linked = rows.select("doc_id", "node", F.col("n").alias("n_shingles")).join(known, "node", "left")
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return linked.select("doc_id", "n_shingles", alone.alias("component_id"))


def _classes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, n) of every row, and (node, component_id) of every set."""
    spark = docs.sparkSession
    counts = docs.select("text").mapInArrow(_count_slots(words), "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slot, n = counts["slot"].to_numpy(), counts["n"].to_numpy()
    seen = np.zeros(1 << SLOT_BITS, np.int64)
    seen[slot[slot >= 0]] = n[slot >= 0]
    light = boundary(dict(zip((-1 - slot[slot < 0]).tolist(), n[slot < 0].tolist(), strict=True)), percent)
    common = COMMON_TIMES * seen.mean() + COMMON_MORE
    sent = spark.sparkContext.broadcast(np.minimum(seen, 0xFFFFFFFF).astype(np.uint32))

    def first_of(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The prefix, rarest shingles first, and how often their slots were seen."""
        often = sent.value[_slots(tokens)]
        first = np.lexsort((tokens, often))[: prefix_size(len(tokens), percent)]
        return tokens[first], often[first]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = shingles(text.as_py(), words)
                low, high, typical = [], [], 0.0
                if len(tokens):
                    typical = float(np.log(first_of(tokens)[1].astype(np.float64)).mean())
                if 0 < len(tokens) <= light:
                    low, high = subset_keys(tokens, light, percent)
                made.append((key, digest(tokens), len(tokens), typical, low, high))
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t.type) for i, t in enumerate(_SETS)], schema=_SETS)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in batches:
            keys, found, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for text in batch.column(0):
                tokens = shingles(text.as_py(), words)
                if not len(tokens) or partners(len(tokens), percent)[-1] <= light:
                    continue
                node = digest(tokens)
                # Copies that a task reads together are one set.
                if node in known:
                    continue
                known.add(node)
                tokens, often = first_of(tokens)
                owner = np.full(len(tokens), node, np.int64)
                spread = mix(tokens ^ owner.view(np.uint64))
                keys.append(np.where(often > common, spread, tokens).view(np.int64))
                found.append(tokens.view(np.int64))
                owners.append(owner)
            yield _columns([np.concatenate(c) for c in (keys, found, owners)])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cut = np.searchsorted(rows[0], rows[0][-1])
            if cut and sum(len(w[0]) for w in waiting) + cut >= GATHERED:
                yield _shared([*waiting, [c[:cut] for c in rows]])
                waiting, rows = [], [c[cut:] for c in rows]
            waiting.append(rows)
        if waiting:
            yield _shared(waiting)

    rows = staged(docs.mapInArrow(sets, _SETS_DDL), "jaccard-sets")
    named = rows.filter("doc_id IS NOT NULL AND n > 0")
    nodes = named.groupBy("node").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("typical").alias("typical"))

    # Light sets: those on one side of a key link with the first one on the other side, and so with all.
    sides = [named.select(F.explode(c).alias("key"), "node") for c in ("low", "high")]
    firsts = [s.groupBy("key").agg(F.min("node").alias("other")) for s in sides]
    edges = sides[0].join(firsts[1], "key").union(sides[1].join(firsts[0], "key")).filter("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b"))
    edges = staged(edges.distinct(), "jaccard-links")

    # Heavy sets: lists with two sets at least.
    every = docs.filter("doc_id IS NOT NULL").select("text").mapInArrow(entries, _ENTRIES_DDL)
    lists = staged(every.repartition("key").sortWithinPartitions("key").mapInArrow(gather, "token bigint, node bigint").distinct(), "jaccard-lists")
    met = staged(lists.groupBy("node").agg(F.count("*").alias("k")).join(nodes, "node"), "jaccard-met")
    full = staged(lists.join(met.select("node", "n", "k", "typical"), "node"), "jaccard-entries")

    # Each set with the leader it meets in most lists; a list's leader is its most typical set, with the commonest shingles.
    leaders = full.groupBy("token").agg(F.max_by("node", F.struct("typical", -F.col("node"))).alias("leader"))
    often = lists.join(leaders, "token").filter("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("times"))
    best = often.groupBy("node").agg(F.max_by("leader", F.struct("times", -F.col("leader"))).alias("leader")).alias("p")
    pairs = best.join(met.alias("x"), F.expr("p.node = x.node")).join(met.alias("y"), F.expr("p.leader = y.node"))
    pairs = pairs.filter(feasible("x", "y", "least(x.k, y.k)", percent)).select(F.col("p.node").alias("a"), F.col("p.leader").alias("b"))
    pairs = staged(pairs, "jaccard-pairs")
    # Texts are fetched once, marked by the part they play in the first comparison; few are needed for the second.
    led = pairs.select(F.col("a").alias("node"), F.lit(True).alias("follows")).join(
        pairs.select(F.col("b").alias("node"), F.lit(True).alias("leads")).distinct(), "node", "full")
    part = met.select("node", F.col("rep").alias("doc_id")).join(led, "node", "left")
    texts = staged(docs.join(part, "doc_id").select("node", "text", "follows", "leads"), "jaccard-texts")
    edges = edges.union(verified(pairs, texts.filter("follows"), texts.filter("leads"), words, percent))

    # Sets of different labels in one list: one of the two is outside the list's commonest label.
    labels = connected_components(edges).withColumnRenamed("component", "label")
    full = full.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    per_label = full.groupBy("token", "label").agg(F.count("*").alias("times"))
    mixed = per_label.groupBy("token").agg(F.count("*").alias("labels"), F.max_by("label", F.struct("times", -F.col("label"))).alias("major"))
    open_ = full.join(mixed.filter("labels > 1"), "token").select("token", "node", "n", "k", "label", "major")
    open_ = staged(open_, "jaccard-open")
    # A set brings a bitmap of its open shingles along. Two sets share no more of them than the bits they share and the
    # shingles that fell on a bit taken already, so most pairs that cannot reach the threshold never leave the join.
    slot = F.pmod(F.xxhash64("token"), F.lit(64 * BITMAP_WORDS))
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(token), 64) AS int))")
    words_ = [F.bit_or(F.when(F.floor(slot / 64) == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"w{i}") for i in range(BITMAP_WORDS)]
    maps = open_.groupBy("node").agg(F.count("*").alias("open"), *words_)
    taken = sum((F.bit_count(F.col(f"w{i}")) for i in range(1, BITMAP_WORDS)), F.bit_count("w0"))
    open_ = open_.join(maps.withColumn("spare", F.col("open") - taken), "node")
    x, y = open_.filter("label <> major").alias("x"), open_.alias("y")
    meet = F.expr("x.token = y.token AND x.label <> y.label AND (y.label = y.major OR x.node < y.node)")
    shared = " + ".join(f"bit_count(x.w{i} & y.w{i})" for i in range(BITMAP_WORDS))
    pairs = x.join(y, meet & feasible("x", "y", f"least(x.k, y.k, {shared} + least(x.spare, y.spare))", percent))
    pairs = pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    pairs = staged(pairs, "jaccard-pairs")
    ends = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node")
    few = staged(texts.join(ends, "node").select("node", "text"), "jaccard-texts")
    edges = edges.union(verified(pairs, few, few, words, percent))

    found = connected_components(edges)
    known = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    return rows, staged(known.join(names, "component").select("node", "component_id"), "jaccard-classes")


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(small_batches(spark), sf_dir, "documents"))


ORACLE = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {WORDS - 1}], ' ') AS sh FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WORDS - 2}, 2))) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
    o AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS o FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o >= {PERCENT} * (p.n + q.n - o)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
    c AS (SELECT a, MIN(b) AS component_id FROM r GROUP BY a)
    SELECT doc_id, COALESCE(n, 0)::BIGINT AS n_shingles, component_id FROM documents JOIN c ON c.a = doc_id LEFT JOIN n USING (doc_id)"""
