"""Near-duplicate embeddings: exact threshold pairs by dual traversal of cover trees.

Vectors of one label are dealt to cells around pivots and to blocks of bounded size. Each block gets a cover tree: nested
levels whose radii halve, every point within its level's radius of a centre. Two trees are walked together, and a pair of
nodes is dropped when the distance of the centres less both covering radii exceeds the threshold; the triangle inequality
makes that exact. Pairs of blocks are first pruned the same way. A task returns, per vector, the number of links and one
vector of its group, so no pairs are emitted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paylake.llm.common import connected_components, staged, table

THRESHOLD = 0.93
#: Cells per label, and vectors per block on average; together they bound what one task holds.
PIVOTS = 32
BLOCK = 1024
LEAF = 8
#: Rows per Arrow batch of pairs of blocks, each of which carries two trees.
PAIRS_PER_BATCH = 4
#: Distances come from products of unit vectors, whose rounding weighs most where they are smallest.
_SLACK = 1e-6


def reach(threshold: float) -> float:
    """The distance of unit vectors at the cosine threshold, with room for rounding."""
    return float(np.sqrt(max(0.0, 2 - 2 * threshold))) + _SLACK


@dataclass
class CoverTree:
    """Points in tree order. Node i has centre point[i], covers start[i]:end[i] within radius[i], and children kids[i]."""

    points: np.ndarray
    order: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    start: np.ndarray
    end: np.ndarray
    kids: list[list[int]]

    @staticmethod
    def build(points: np.ndarray) -> CoverTree:
        distance = np.sqrt(np.maximum(0, 2 - 2 * points @ points.T))
        np.fill_diagonal(distance, 0)
        nodes: list[tuple[int, float, int, int, list[int]]] = []
        order: list[int] = []

        def grow(members: np.ndarray, centre: int, level: float) -> int:
            mine, first = len(nodes), len(order)
            radius = float(distance[centre, members].max())
            nodes.append((centre, radius, first, first, []))
            kids = []
            if len(members) <= LEAF or radius == 0:
                order.extend(members.tolist())
            else:
                while level / 2 >= radius:
                    level /= 2
                # The centre is kept on the next level; each further centre is farther than its radius from all before.
                rest, next_centre = members, centre
                while len(rest):
                    near = distance[next_centre, rest] <= level / 2
                    kids.append(grow(rest[near], next_centre, level / 2))
                    rest = rest[~near]
                    next_centre = int(rest[0]) if len(rest) else -1
            nodes[mine] = (centre, radius, first, len(order), kids)
            return mine

        grow(np.arange(len(points)), 0, 2.0)
        order_, place = np.array(order), np.empty(len(order), np.int64)
        place[order_] = np.arange(len(order_))
        c, r, s, e, k = zip(*nodes, strict=True)
        return CoverTree(points[order_], order_, place[list(c)], np.array(r), np.array(s), np.array(e), list(k))

    def pack(self) -> bytes:
        head = json.dumps([self.points.shape, len(self.centre), self.kids]).encode()
        parts = [self.points.astype("<f8"), self.order.astype("<i8"), self.centre.astype("<i8"), self.radius.astype("<f8"), self.start.astype("<i8"), self.end.astype("<i8")]
        return len(head).to_bytes(8, "little") + head + b"".join(p.tobytes() for p in parts)

    @staticmethod
    def unpack(data: bytes) -> CoverTree:
        at = 8 + int.from_bytes(data[:8], "little")
        shape, n, kids = json.loads(data[8:at])
        out = []
        for kind, size in (("<f8", shape[0] * shape[1]), ("<i8", shape[0]), ("<i8", n), ("<f8", n), ("<i8", n), ("<i8", n)):
            out.append(np.frombuffer(data, kind, size, at))
            at += 8 * size
        return CoverTree(out[0].reshape(shape), *out[1:], kids)


def pairs_within(a: CoverTree, b: CoverTree, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in a and b of all points with cosine at or above the threshold."""
    far, waiting = reach(threshold), [(0, 0)]
    while waiting:
        i, j = waiting.pop()
        left, right = a.kids[i], b.kids[j]
        if not left and not right:
            rows, columns = np.nonzero(a.points[a.start[i] : a.end[i]] @ b.points[b.start[j] : b.end[j]].T >= threshold)
            if len(rows):
                yield rows + a.start[i], columns + b.start[j]
            continue
        # A leaf waits while the other side is opened; children of both meet in one product of their centres.
        left, right = np.array(left or [i]), np.array(right or [j])
        distance = np.sqrt(np.maximum(0, 2 - 2 * a.points[a.centre[left]] @ b.points[b.centre[right]].T))
        near = distance <= far + a.radius[left][:, None] + b.radius[right][None, :]
        waiting.extend(zip(*(x.tolist() for x in (left[np.nonzero(near)[0]], right[np.nonzero(near)[1]])), strict=True))


def links(a: CoverTree, a_ids: np.ndarray, a_n: np.ndarray, b: CoverTree, b_ids: np.ndarray, b_n: np.ndarray, same: bool, threshold: float) -> pd.DataFrame:
    """Per vector with a link: how many vectors it links to on the other side, and the smallest id of its group."""
    found = [np.concatenate(x) for x in zip(*pairs_within(a, b, threshold), strict=True)] or [np.zeros(0, np.int64)] * 2
    u, v = a.order[found[0]], b.order[found[1]]
    ids, n = (a_ids, a_n) if same else (np.concatenate((a_ids, b_ids)), np.concatenate((a_n, b_n)))
    if same:
        u, v = u[u != v], v[u != v]
        count = np.bincount(u, weights=a_n[v], minlength=len(ids))
    else:
        v = v + len(a_ids)
        count = np.bincount(u, weights=n[v], minlength=len(ids)) + np.bincount(v, weights=n[u], minlength=len(ids))
    low = ids.copy()
    while True:
        before = low.copy()
        np.minimum.at(low, u, low[v])
        np.minimum.at(low, v, low[u])
        if (before == low).all():
            break
    linked = count > 0
    return pd.DataFrame({"id": ids[linked], "links": count[linked].astype(np.int64), "low": low[linked]})


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """One row per row of vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Only vectors of one label and one length are compared. A null id, label, vector or component, a component that is not
    finite, and a zero vector make a row that links with nothing. Equal vectors are one class, compared once; rows of one
    id are one node, with one component and one count. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    fit = F.expr("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND abs(x) < double('infinity')) AND exists(v, x -> x <> 0)")
    rows = rows.withColumn("fit", F.coalesce(fit, F.lit(False)))
    classes = rows.filter("fit").groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
    classes = staged(classes.withColumn("space", F.concat_ws(":", F.col("label").cast("string"), F.size("v").cast("string"))), "cover-classes")

    # Pivots: the first vectors of each label by hash; the limit is applied before rows are shuffled.
    nth = F.row_number().over(W.partitionBy("space").orderBy(F.xxhash64("id"), "id", "v"))
    chosen = classes.withColumn("nth", nth).filter(F.col("nth") <= pivots).groupBy("space").agg(F.collect_list("v").alias("pivots"))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = []
            for row in batch.itertuples():
                v = np.array(row.v, np.float64)
                v = v / np.abs(v).max()
                v /= np.sqrt(v @ v)
                centres = np.stack([np.array(p, np.float64) / np.abs(p).max() for p in row.pivots])
                centres /= np.sqrt((centres**2).sum(1))[:, None]
                made.append((row.space, int(np.argmax(centres @ v)), row.id, row.n, v.astype("<f8").tobytes()))
            yield pd.DataFrame(made, columns=["space", "cell", "id", "n", "unit"])

    cells = classes.select("space", "id", "n", "v").join(chosen, "space").mapInPandas(assign, "space string, cell int, id bigint, n bigint, unit binary")
    cells = staged(cells, "cover-cells")
    sizes = cells.groupBy("space", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    dealt = cells.join(sizes, ["space", "cell"]).withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts").cast("bigint")).cast("int"))

    def tree(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "unit"])
        points = np.stack([np.frombuffer(u, "<f8") for u in group["unit"]])
        made = CoverTree.build(points)
        first = group.iloc[0]
        ids, n = group["id"].to_numpy("<i8").tobytes(), group["n"].to_numpy("<i8").tobytes()
        return pd.DataFrame([(first["space"], first["cell"], first["part"], points[0].tolist(), float(made.radius[0]), made.pack(), ids, n)], columns=["space", "cell", "part", "centre", "radius", "tree", "ids", "n"])

    # Dealt by part as well: the join before has a cell's rows in one place.
    trees = dealt.repartition("space", "cell", "part").groupBy("space", "cell", "part").applyInPandas(
        tree, "space string, cell int, part int, centre array<double>, radius double, tree binary, ids binary, n binary"
    )
    trees = staged(trees.withColumn("key", F.concat_ws(":", "space", "cell", "part")), "cover-trees")
    heads = trees.select("space", "key", "centre", "radius")
    other = heads.select("space", F.col("key").alias("key2"), F.col("centre").alias("centre2"), F.col("radius").alias("radius2"))
    apart = F.sqrt(F.expr("aggregate(zip_with(centre, centre2, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x)"))
    pairs = heads.join(other, "space").filter("key <= key2").filter(apart <= F.col("radius") + F.col("radius2") + reach(threshold)).select("key", "key2")
    load = trees.select("key", F.struct("tree", "ids", "n").alias("a"))
    pairs = pairs.join(load, "key").join(load.select(F.col("key").alias("key2"), F.col("a").alias("b")), "key2")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                sides = []
                for side in (row.a, row.b):
                    sides += [CoverTree.unpack(side["tree"]), np.frombuffer(side["ids"], "<i8"), np.frombuffer(side["n"], "<i8")]
                yield links(*sides, row.key == row.key2, threshold)

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(PAIRS_PER_BATCH))
    try:
        found = staged(pairs.mapInPandas(walk, "id bigint, links bigint, low bigint"), "cover-links")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(found.select("id", "low"), "id", "low")
    members = classes.select("label", "v", "id", "n").join(counts, "id", "left").join(components.withColumnRenamed("node", "id"), "id", "left")
    members = members.select("label", "v", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    linked = rows.filter("fit").join(members, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT fit").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = f"""WITH RECURSIVE v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
    r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
    c AS (SELECT a, MIN(b) AS component_id FROM r GROUP BY a),
    n AS (SELECT a, COUNT(*) AS n_links FROM l GROUP BY a)
    SELECT vec_id, COALESCE(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id"""
