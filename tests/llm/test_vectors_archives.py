import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from paylake.llm import cover, warc
from paylake.llm.common import small_batches
from tests.llm.helpers import components, prose


def _brute(rows, threshold):
    units = {}
    for i, (key, v, label) in enumerate(rows):
        if key is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v):
            units[i] = np.array(v, float) / np.linalg.norm(v)
    links = [
        (i, j) for i in units for j in units
        if i < j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and units[i] @ units[j] >= threshold
    ]
    low = components(range(len(rows)), links)
    ids = {}
    for i, (key, *_) in enumerate(rows):
        ids.setdefault(low[i], []).append(key)
    return [(r[0], sum(i in e for e in links), r[0] if r[0] is None else min(k for k in ids[low[i]] if k is not None)) for i, r in enumerate(rows)]


def test_links_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    rows = []
    for label in (0, 1):
        centres = rng.normal(size=(12, 16))
        for c in centres:
            rows += [((c + rng.normal(size=16) * s).astype("f4").tolist(), label) for s in rng.choice([0.02, 0.2, 0.3], 12)]
    rows += [(rows[0][0], 0)] * 5 + [(rows[0][0], 1), ([x * 2 for x in rows[3][0]], 0), (rows[5][0][:8], 0), (rows[5][0][:8], 0)]
    rows += [(None, 0), ([0.0] * 16, 0), ([float("nan")] * 16, 0), ([None, *rows[0][0][1:]], 0), ([float("inf"), *rows[0][0][1:]], 0), (rows[0][0], None), ([], 0)]
    rows = [(i, *r) for i, r in enumerate(rows)] + [(None, rows[0][0], 0)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, n int, space string").repartition(4)
    want = sorted(map(str, _brute(rows, 0.93)))
    for pivots, block in ((32, 1024), (3, 16)):
        got = cover.near_duplicates(df, pivots=pivots, block=block).collect()
        assert sorted(str((r["vec_id"], r["n_links"], r["component_id"])) for r in got) == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert cover.near_duplicates(df.limit(0)).count() == 0


def test_levels_nest_and_halve():
    points = np.random.default_rng(2).normal(size=(300, 5))
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = cover.CoverTree.unpack(cover.CoverTree.build(points).pack())
    assert sorted(tree.order.tolist()) == list(range(300)) and (tree.points == points[tree.order]).all()
    for i, kids in enumerate(tree.kids):
        inside = np.linalg.norm(tree.points[tree.start[i] : tree.end[i]] - tree.points[tree.centre[i]], axis=1)
        assert inside.max() <= tree.radius[i] + 1e-6
        if kids:
            assert tree.centre[kids[0]] == tree.centre[i]
            assert [tree.start[k] for k in kids[1:]] == [tree.end[k] for k in kids[:-1]]
            assert max(tree.radius[kids]) <= max(tree.radius[i], 1e-9)


MAGIC = "WARC/1.0\r\n"


def test_magic_inside_payloads_is_rejected(spark, folder):
    small_batches(spark)
    rng = random.Random(1)
    fake = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    pages = [
        (1, "http://a/\r\nContent-Length: 3\r\n\r\n", fake), (2, None, fake * 3 + MAGIC), (3, "u", MAGIC * 40), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"),
        (8, "u", MAGIC + "Content-Length: 99999999999999999999\r\n\r\n" + "x" * 200), (9, "u", MAGIC + "Content-Length: 120\r\n\r\n" + "y" * 300), (None, "u", "n" * 150),
    ]
    pages += [(10 + i, "u", f"<p>{prose(rng, rng.randint(1, 200))}é😀</p>" + rng.choice(["", "\r\n\r\n", "\n", fake])) for i in range(60)]
    pages += [(200 + i, "u", pages[20][2]) for i in range(9)] + [(300, "u", pages[1][2]), (301, "u", "n" * 150), (0, "u", pages[30][2]), (0, "u", pages[30][2])]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, html string, _digest string").repartition(3)
    first = {}
    for key, _, html in pages:
        if key is not None:
            first[html or ""] = min(key, first.get(html or "", key))
    want = []
    for key, _, html in pages:
        data = (html or "").encode()
        original = first.get(html or "")
        again = key is not None and len(data) >= 100 and key > original
        want.append(str((key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", original if again else None)))
    warc.write_warc(df, f"{folder}/warc")
    for size in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = warc.read_warc(spark, f"{folder}/warc").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in got) == sorted(want)
    assert {r["url"] for r in got if r["page_id"] == 1} == {"http://a/%0D%0AContent-Length: 3%0D%0A%0D%0A"}


def test_no_pages_no_records(spark, folder):
    df = spark.createDataFrame([], "page_id bigint, url string, html string")
    warc.write_warc(df, f"{folder}/none")
    assert warc.read_warc(spark, f"{folder}/none").count() == 0


def test_texts_travel_without_what_pages_share(spark):
    rng = random.Random(8)
    frame = "".join(rng.choices("abcdefghij <>/", k=1500))
    pages = spark.createDataFrame([(i, frame + str(rng.random())) for i in range(30)] + [(30, None), (31, ""), (32, "\u00e9\U0001f600")], "page_id bigint, html string")
    html, shared = F.coalesce("html", F.lit("")), warc._shared(pages)
    sent = pages.select(html.alias("html"), warc._squeezed(html, shared).alias("sent"), warc._squeezed(html, b"").alias("alone"))
    sizes = sent.agg(F.sum(F.octet_length("sent")), F.sum(F.octet_length("alone"))).first()
    assert sizes[0] * 4 < sizes[1]
    back = sent.select("html", warc._restored(F.col("sent"), shared).alias("a"), warc._restored(F.col("alone"), b"").alias("b")).collect()
    assert len(back) == 33 and all(r.html == r.a == r.b for r in back)


def test_only_files_with_doubtful_candidates_take_the_chain(spark, monkeypatch):
    chained, real = [], warc.kept
    monkeypatch.setattr(warc, "kept", lambda c: chained.append({r.file for r in c.collect()}) or real(c))
    rows = [("f", 0, 10), ("f", 10, 30), ("f", 30, None), ("g", 0, 20), ("g", 5, 9), ("g", 20, 40), ("h", 3, 8), ("i", 0, None), ("i", 7, 9)]
    df = spark.createDataFrame(rows, "file string, at bigint, next bigint")
    marked = df.withColumn("_follows", warc._follows())
    got = sorted((r.file, r.at) for r in warc._records(marked).collect())
    assert got == sorted((r.file, r.at) for r in real(df).collect()) == [("f", 0), ("f", 10), ("f", 30), ("g", 0), ("g", 20), ("i", 0)]
    assert chained == [{"g", "h", "i"}]


def test_chain_stops_where_it_breaks(spark):
    rows = [("f", 0, 10), ("f", 10, 30), ("f", 15, 30), ("f", 30, 41), ("f", 40, 50), ("g", 5, 9), ("h", 0, None)]
    df = spark.createDataFrame(rows, "file string, at bigint, next bigint")
    assert sorted(map(tuple, warc.chain(df).collect())) == [("f", 0), ("f", 10), ("f", 30), ("h", 0)]
