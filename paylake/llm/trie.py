"""Conversation prefix trie: shared beginnings of conversations, their members and what sharing them saves.

A prefix is named by a running digest of its turns. A count-min sketch over all prefixes screens them: where one of a
prefix's counters says one, no other conversation has it, and neither has any longer prefix of that conversation. Such tails
are written by the task that reads them. Only prefixes that may be shared travel, are grouped exactly, and get their places
in the tree; a prefix that the sketch passes in vain is found to have one member, so the sketch decides cost, never results.

Nothing walks the tree level by level. A node's smallest member carries the node's own figures; sums along that member's
turns, from the last to the first, give every ancestor its share, and one grouping adds them up. A conversation of any length
is cut into parts of a range partitioning, and running digests and sums pass from part to part as totals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paylake.llm.common import staged, table

#: Conversations come in families of this many ids; a member starts with at most SHARED - 1 turns of the family's first.
FAMILY, SHARED = 100, 6
#: The sketch: rows of counters, per row about twice as many as prefixes but no more than 2^LARGEST_BITS. What is sent to
#: the tasks is a bit per counter, 8 MB at most. With more prefixes it proves fewer singletons, and results are the same.
SKETCH_ROWS, LARGEST_BITS = 2, 25
#: Counters travel in blocks of so many.
BLOCK_BITS = 16
#: Ids whose text is joined before pieces meet to be digested.
PIECE_IDS = 4096

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODE = ["depth", "p1", "p2"]
MADE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _long(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


def ordered_turns(turns: DataFrame, partitions: int) -> DataFrame:
    """(conv_id, part, place in part, turn digests, characters), one row per turn, written.

    Rows without conv_id belong to no conversation. Of equal turn numbers the smaller md5 of role and text comes first.
    Texts do not travel: a turn becomes its digest where it is read.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.filter("conv_id IS NOT NULL").select(_long("conv_id"), _long("turn"), F.unhex(name).alias("name"), F.char_length(text).cast("bigint").alias("chars"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            if not len(ids):
                continue
            at, starts = np.arange(len(ids)), np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            begun = np.repeat(starts, np.diff([*starts, len(ids)]))
            places = at - begun
            if ids[0] == last:
                places[: starts[1] if len(starts) > 1 else len(ids)] += seen
            last, seen = ids[-1], int(places[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(np.full(len(ids), part, np.int64)), pa.array(places), batch.column("name"), batch.column("chars")],
                ["conv_id", "part", "place", "name", "chars"],
            )

    order = ["conv_id", F.col("turn").asc_nulls_first(), "name"]
    dealt = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return staged(dealt.mapInArrow(placed, "conv_id bigint, part bigint, place bigint, name binary, chars bigint"), "turns")


def _crossing(parts: DataFrame, partitions: int, *columns: Column) -> DataFrame:
    """What is carried into the parts of conversations that have several. Each of these crosses a boundary of the range
    partitioning, so there are fewer than two rows per partition, and they may be broadcast."""
    several = parts.withColumn("several", F.count("*").over(W.partitionBy("conv_id"))).filter("several > 1")
    found = staged(several.select("conv_id", "part", *columns), "crossing")
    return F.broadcast(found) if found.count() <= 2 * partitions else found


def rebuilt(turns: DataFrame, partitions: int, family: int = FAMILY, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """(turns of rebuilt conversations with running digests, conversations with their lengths), both written."""
    rows = ordered_turns(turns, partitions)
    parts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("conv_id").orderBy("part")) - F.col("n")
    offsets = _crossing(parts, partitions, before.alias("offset"))
    rows = rows.join(offsets, ["conv_id", "part"], "left").withColumn("place", F.col("place") + F.coalesce("offset", F.lit(0))).drop("offset")

    own = parts.groupBy("conv_id").agg(F.sum("n").alias("own"), F.min("part").alias("first"))
    own = own.withColumn("head", F.expr(f"conv_id - conv_id % {family}")).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared)
    heads = own.select(F.col("conv_id").alias("head"), F.col("own").alias("given"))
    convs = own.join(heads, "head", "left").withColumn("taken", F.least("h", F.coalesce("given", F.lit(0))))
    convs = staged(convs.select("conv_id", "head", "first", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "conversations")

    start = rows.filter(f"conv_id % {family} = 0 AND place < {shared - 1}").select(F.col("conv_id").alias("head"), "place", "name", "chars")
    taken = convs.filter("taken > 0").join(start, "head").filter("place < taken").select("conv_id", "first", "place", "name", "chars", "length")
    kept = rows.join(convs, "conv_id").filter("place >= h").select("conv_id", "part", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "name", "chars", "length")
    both = taken.withColumnRenamed("first", "part").unionByName(kept)
    # A turn's digest depends on its place, so exclusive or over places 1 to d names the sequence of d turns.
    each = both.select("conv_id", "part", (F.col("place") + 1).alias("depth"), "chars", "length", F.xxhash64(F.lit(1), "place", "name").alias("t1"), F.xxhash64(F.lit(2), "name", "place").alias("t2"))
    inside = W.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    run = each.select("*", F.bit_xor("t1").over(inside).alias("p1"), F.bit_xor("t2").over(inside).alias("p2"))
    run = staged(run, "running")
    totals = run.groupBy("conv_id", "part").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
    earlier = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = _crossing(totals, partitions, *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(c) for c in ("s1", "s2")])
    done = run.join(carried, ["conv_id", "part"], "left")
    p1, p2 = (F.col(f"p{i}").bitwiseXOR(F.coalesce(f"s{i}", F.lit(0))) for i in (1, 2))
    prefixes = done.select("conv_id", "part", "depth", "chars", "length", p1.alias("p1"), p2.alias("p2"), p1.bitwiseXOR(F.col("t1")).alias("q1"), p2.bitwiseXOR(F.col("t2")).alias("q2"))
    return staged(prefixes, "prefixes"), convs


def _slots(p1: np.ndarray, p2: np.ndarray, bits: int) -> list[np.ndarray]:
    a, b = p1.view(np.uint64), p2.view(np.uint64) | np.uint64(1)
    return [((a + np.uint64(j) * b) >> np.uint64(64 - bits)).astype(np.int64) for j in range(SKETCH_ROWS)]


def sketch(prefixes: DataFrame, bits: int) -> np.ndarray:
    """Per row of counters, packed bits: whether a counter saw more than one prefix. Counts stop at 2, as no more is asked."""
    width, block = 1 << bits, 1 << min(bits, BLOCK_BITS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros((SKETCH_ROWS, width), np.uint8)
        for batch in batches:
            for j, slots in enumerate(_slots(batch.column(0).to_numpy(), batch.column(1).to_numpy(), bits)):
                found, n = np.unique(slots, return_counts=True)
                counters[j, found] = np.minimum(counters[j, found] + np.minimum(n, 2), 2)
        flat = counters.reshape(-1, block)
        for i in np.flatnonzero(flat.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([zstandard.compress(flat[i].tobytes(), 1)])], ["block", "counters"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zstandard.decompress(data), np.uint8)
                if i == now:
                    total = np.minimum(total + part, 2)
                else:
                    if now is not None:
                        yield _packed_block(now, total)
                    now, total = i, part
        if now is not None:
            yield _packed_block(now, total)

    sent = prefixes.select("p1", "p2").mapInArrow(counted, "block bigint, counters binary")
    rows = sent.repartition("block").sortWithinPartitions("block").mapInArrow(added, "block bigint, bits binary")
    out = np.zeros((SKETCH_ROWS * width // block, block // 8), np.uint8)
    for r in rows.collect():  # at most 2^LARGEST_BITS bits per row of counters
        out[r["block"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out.reshape(SKETCH_ROWS, -1)


def _packed_block(i: int, counters: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([np.packbits(counters > 1).tobytes()])], ["block", "bits"])


def screened(prefixes: DataFrame, held: np.ndarray, bits: int) -> DataFrame:
    """Add whether a prefix, and the prefix before its last turn, may be shared. The empty prefix counts as shared."""
    sent = prefixes.sparkSession.sparkContext.broadcast(held)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = sent.value

        def several(p1: np.ndarray, p2: np.ndarray) -> np.ndarray:
            out = np.ones(len(p1), bool)
            for row, slots in zip(packed, _slots(p1, p2, bits), strict=True):
                out &= (row[slots >> 3] >> (7 - (slots & 7)) & 1).astype(bool)
            return out

        for batch in batches:
            digest = [batch.column(c).to_numpy() for c in ("p1", "p2", "q1", "q2")]
            first = batch.column("depth").to_numpy() == 1
            columns = [*batch.columns, pa.array(several(*digest[:2])), pa.array(first | several(*digest[2:]))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "shared", "after_shared"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prefixes.schema.fields)
    return prefixes.mapInArrow(looked_up, f"{ddl}, shared boolean, after_shared boolean")


def ends_digests(ends: DataFrame, partitions: int) -> DataFrame:
    """(node, ends_sha256): the ids that end at each node, ascending, joined by commas and digested.

    Ids are sorted by range, so a crowded node's ids lie in many tasks; these join them to pieces, and what meets to be
    digested is a piece per PIECE_IDS ids.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids = None, []

        def taken() -> pa.RecordBatch:
            row = (*now, ids[0], ",".join(map(str, ids)))
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], [*NODE, "first", "piece"])

        for batch in batches:
            *node, convs = (batch.column(c).to_pylist() for c in (*NODE, "conv_id"))
            for key, conv in zip(zip(*node, strict=True), convs, strict=True):
                if ids and (key != now or len(ids) == PIECE_IDS):
                    yield taken()
                    ids = []
                now = key
                ids.append(conv)
        if ids:
            yield taken()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, state.hexdigest())], [*NODE, "ends_sha256"])

        for batch in batches:
            *node, texts = (batch.column(c).to_pylist() for c in (*NODE, "piece"))
            for key, piece in zip(zip(*node, strict=True), texts, strict=True):
                if key == now:
                    state.update(b"," + piece.encode())
                else:
                    if now:
                        yield done()
                    now, state = key, hashlib.sha256(piece.encode())
        if now:
            yield done()

    key = "depth bigint, p1 bigint, p2 bigint"
    cut = ends.select(*NODE, "conv_id").repartitionByRange(partitions, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    cut = cut.mapInArrow(pieces, f"{key}, first bigint, piece string")
    return cut.repartition(partitions, *NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digested, f"{key}, ends_sha256 string")


def trie(turns: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """One row per distinct sequence of turns with which a rebuilt conversation starts, the empty one included.

    turns: conv_id, turn, role, text; other columns are not read. Null role or text is empty, a null turn comes first, rows
    that repeat conv_id and turn are turns of their own in the order of the md5 of role and text, and rows without conv_id
    are left out. Texts of any length are digested where they are read. An empty table gives no rows.
    """
    spark = turns.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    prefixes, convs = rebuilt(turns, partitions, family, shared)
    bits = min(LARGEST_BITS, max(BLOCK_BITS, int(2 * prefixes.count()).bit_length()))
    seen = staged(screened(prefixes, sketch(prefixes, bits), bits), "screened")
    return _nodes(seen, convs, partitions)


def _nodes(seen: DataFrame, convs: DataFrame, partitions: int) -> DataFrame:
    whole = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.count_if(F.col("length") == 0).alias("turnless")).first()
    if not whole["n"]:
        return convs.sparkSession.createDataFrame([], ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'bigint'}" for c in MADE))
    alone = seen.filter("NOT shared")
    some = seen.filter("shared")

    # Exact groups of the prefixes that may be shared; the first of a group stands for it.
    groups = some.groupBy(*NODE).agg(
        F.min("conv_id").alias("rep"), F.count("*").alias("n"), F.max("chars").alias("chars"), F.count_if(F.col("length") == F.col("depth")).alias("ended"),
        F.min("q1").alias("q1"), F.min("q2").alias("q2"),
    )
    groups = staged(groups, "groups")

    # A node's figures at its first member: what it saves, and whether it is a leaf. Ends of conversations that are alone are
    # leaves too, and lie behind all that those conversations share.
    figures = groups.select(F.col("rep").alias("conv_id"), "depth", ((F.col("n") - 1) * F.col("chars")).alias("saves"), (F.col("ended") == F.col("n")).cast("bigint").alias("leaf"))
    mine = some.join(figures.hint("merge"), ["conv_id", "depth"], "left").select("conv_id", "part", *NODE, F.coalesce("saves", F.lit(0)).alias("saves"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    lone = alone.filter("depth = length").select("conv_id", "part", *NODE, F.lit(0).alias("saves"), F.lit(1).alias("leaf"))
    mine = mine.unionByName(lone)
    after = W.partitionBy("conv_id", "part").orderBy(F.desc("depth")).rowsBetween(W.unboundedPreceding, 0)
    sums = staged(mine.select("conv_id", "part", *NODE, "saves", "leaf", F.sum("saves").over(after).alias("saved"), F.sum("leaf").over(after).alias("leaves")), "sums")
    totals = sums.groupBy("conv_id", "part").agg(F.sum("saves").alias("more_saved"), F.sum("leaf").alias("more_leaves"))
    later = W.partitionBy("conv_id").orderBy(F.desc("part")).rowsBetween(W.unboundedPreceding, -1)
    carried = _crossing(totals, partitions, *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(c) for c in ("more_saved", "more_leaves")])
    passed = sums.join(carried, ["conv_id", "part"], "left").select(
        *NODE, (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves")
    )
    # Sums at the end of a lone conversation are no node's: no group has its digest, and the join below leaves them out.
    subtree = passed.groupBy(*NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    # Children: groups by the prefix before their last turn, and lone prefixes that leave a node.
    leaving = alone.filter("after_shared")
    below = groups.select((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).unionByName(
        leaving.select((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    )
    children = staged(below.groupBy(*NODE).agg(F.count("*").alias("n_children")), "children")

    reps = groups.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("rep").alias("parent"))
    parent = ["depth", "q1", "q2"]
    on_top = F.when(F.col("depth") == 1, F.lit(whole["least"]))
    ends = ends_digests(some.filter("depth = length"), partitions)
    inner = (
        groups.join(subtree.hint("merge"), NODE, "left").join(children.hint("merge"), NODE, "left").join(ends.hint("merge"), NODE, "left").join(reps.hint("merge"), parent, "left")
        # The parent of a node with one member may have been alone for the sketch; its only member is this one.
        .select(
            F.col("rep").alias("conv_id"), "depth", F.coalesce(on_top, "parent", "rep").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
        )
    )

    def tail(rows: DataFrame, above: Column) -> DataFrame:
        over = F.col("depth") == F.col("length")
        own = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
        return rows.select(
            "conv_id", "depth", above.alias("parent_conv_id"), F.lit(1).alias("n_convs"), F.when(over, 0).otherwise(1).alias("n_children"), F.lit(1).alias("n_leaves"),
            F.lit(0).alias("saved_tokens"), F.when(over, own).otherwise(EMPTY_SHA).alias("ends_sha256"),
        )

    tails = tail(alone.filter("NOT after_shared"), F.col("conv_id"))
    tops = tail(leaving.filter("depth = 1"), F.lit(whole["least"]))
    joins = tail(leaving.filter("depth > 1").join(reps.hint("merge"), parent, "left"), F.coalesce("parent", "conv_id"))

    # The root has every conversation, so it is no key of any join.
    top = _root(groups, alone, children, convs, whole, partitions)
    made = inner
    for more in (tails, tops, joins, top):
        made = made.unionByName(more)
    return made.select(*[F.col(c).cast("string" if c == "ends_sha256" else "bigint").alias(c) for c in MADE])


def _root(groups: DataFrame, alone: DataFrame, children: DataFrame, convs: DataFrame, whole: dict, partitions: int) -> DataFrame:
    totals = groups.agg(F.sum((F.col("n") - 1) * F.col("chars")).alias("saved"), F.count_if(F.col("ended") == F.col("n")).alias("leaves")).first()
    lone = alone.filter("depth = length").count()
    found = children.filter("depth = 0").agg(F.sum("n_children").alias("n")).first()["n"] or 0
    turnless = convs.filter("length = 0").select(F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("p1"), F.lit(0).cast("bigint").alias("p2"), "conv_id")
    ends = ends_digests(turnless, partitions).select("ends_sha256")
    spark = convs.sparkSession
    row = (whole["least"], 0, None, whole["n"], found, (totals["leaves"] + lone) or 1, totals["saved"] or 0)
    one = spark.createDataFrame([row], ", ".join(f"{c} bigint" for c in MADE[:-1]))
    if not whole["turnless"]:
        return one.withColumn("ends_sha256", F.lit(EMPTY_SHA))
    return one.withColumn("ends_sha256", F.lit(ends.first()["ends_sha256"]))


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


#: DuckDB has no crc32, so its bits are folded here; a prefix is the digests of its turns, 32 characters each.
ORACLE = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place,
         md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name, len(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, xor(4294967295, list_reduce(
    [4294967295::BIGINT] || [ascii(d)::BIGINT FOR d IN string_split(conv_id::VARCHAR, '')],
    LAMBDA crc, b: list_reduce([xor(crc, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], LAMBDA x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), n AS (SELECT conv_id AS head, count(*) AS given FROM t GROUP BY conv_id),
k AS (SELECT c.*, least(h, coalesce(given, 0)) AS taken FROM c LEFT JOIN n USING (head)),
r AS (
  SELECT k.conv_id, t.place, t.name, t.chars FROM k JOIN t ON t.conv_id = k.head AND t.place < k.taken
  UNION ALL SELECT k.conv_id, t.place - k.h + k.taken, t.name, t.chars FROM k JOIN t ON t.conv_id = k.conv_id AND t.place >= k.h
), p AS (
  SELECT conv_id, place + 1 AS depth, string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY place) AS path, chars,
         count(*) OVER (PARTITION BY conv_id) AS length
  FROM r
  UNION ALL SELECT conv_id, 0, '', 0, (SELECT count(*) FROM r WHERE r.conv_id = k.conv_id) FROM k
), g AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = length), '')) AS ends_sha256
  FROM p GROUP BY depth, path
), kids AS (SELECT depth - 1 AS depth, left(path, 32 * (depth - 1)) AS path, count(*) AS n FROM g WHERE depth > 0 GROUP BY 1, 2),
e AS (SELECT g.*, coalesce(kids.n, 0) AS n_children FROM g LEFT JOIN kids USING (depth, path)),
s AS (
  SELECT u AS depth, left(path, 32 * u) AS path, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS u FROM e) GROUP BY 1, 2
)
SELECT e.conv_id, e.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, e.n_convs::BIGINT AS n_convs, e.n_children::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, e.ends_sha256
FROM e JOIN s USING (depth, path) LEFT JOIN g AS up ON up.depth = e.depth - 1 AND up.path = left(e.path, 32 * (e.depth - 1))
"""
