"""The pipeline's stages, each against plain Python on what its predecessor kept."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paylake.llm import decontaminate, queries
from tests.llm.helpers import documents, edits, jaccard_groups, prose
from tests.llm.test_quality_packing import _rebuilt


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(1)
    root = str(tmp_path_factory.mktemp("tables"))
    bench = [(i, prose(rng, 25)) for i in range(4)]
    rows, labels = [], []
    for i in range(160):
        text = prose(rng, rng.randint(10, 80))
        kind = i % 8
        if kind == 1:
            text = text.upper().replace(" ", "!! ")
        elif kind == 2:
            text = " ".join([text.split()[0]] * 40)
        elif kind == 3 and i > 8:
            text = rows[i - 3][1] + " end"
        elif kind == 4:
            text = text + " " + rng.choice(bench)[1] + " " + prose(rng, 5)
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice(["src1", "src2", "src5"])))
        labels.append((i, int(kind not in (1, 2)), 0))
    rows += [(500, None, "en", "src1"), (501, "", None, None), (502, prose(rng, 6000), "en", "src2")]
    documents(spark, rows).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame(bench, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, dict(bench), {i: kind for i, kind, _ in labels}


def test_stages(spark, tables):
    root, bench, quality = tables
    docs = spark.read.parquet(f"{root}/documents.parquet").withColumn("_score", F.lit("mine"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, root)
        assert out.columns == docs.columns
        docs = corpus_pipeline.staged(out, name)
        rows = docs.collect()
        assert {r["_score"] for r in rows} <= {"mine"}
        kept[name] = before, Counter(r["doc_id"] for r in rows)

    before, after = kept["quality"]
    wrong = [i for i in quality if (i in after) != bool(quality[i])]
    assert len(wrong) <= 2
    before, after = kept["near_duplicates"]
    groups = jaccard_groups(before)[1]
    assert dict(after) == {i: 1 for i in before if groups[i] == i}
    before, after = kept["decontamination"]
    items = [decontaminate.normalise(t) for t in bench.values()]
    clean = [i for i, t in before.items() if not any(edits(b, decontaminate.normalise(t)) <= len(b) * 0.05 for b in items if i != 502)]
    assert sorted(after) == sorted(clean) and len(clean) < len(before)
    before, after = kept["mixing"]
    words = lambda i: len((before[i] or "").split())
    assert set(after.values()) <= {1, 2} and sum(words(i) * n for i, n in after.items()) <= 0.8 * sum(map(words, before))

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, root).collect()
    assert set(_rebuilt(packed)) == set(after)


def test_near_copies_share_four_fifths_of_their_five_word_shingles(spark):
    words = prose(random.Random(3), 50).split()
    words = [f"{w}{i}" for i, w in enumerate(words)]
    near, far = words[:], words[:]
    near[25] = far[15] = far[35] = "other"
    texts = {1: " ".join(words), 2: " ".join(near), 3: " ".join(far)}
    assert [jaccard_groups(texts, *level)[1][2] for level in ((85, 4), (80, 5))] == [2, 1]
    kept = corpus_pipeline.keep_one_of_each(spark, documents(spark, list(texts.items())), "").collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3]


def test_run_and_registration(spark, tables):
    assert corpus_pipeline.run(spark, tables[0]).count() > 0
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 11)}
    assert set(queries.oracles()) <= names


def test_no_rows_at_all(spark, tables, folder):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{tables[0]}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
