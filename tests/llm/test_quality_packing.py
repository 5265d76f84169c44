import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylake.llm import packing, quality
from paylake.llm.common import held_out, small_batches
from tests.llm.helpers import documents, prose


def _labelled(rng, n):
    rows = []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(rng, rng.randint(8, 60))
        bad = rng.choice([text.upper().replace(" ", "!! "), " | ".join(text.split()), " ".join([text.split()[0]] * 30)])
        rows.append((i, text if good else bad, int(good)))
    return rows


def test_held_out_documents_are_told_apart(spark):
    rows = _labelled(random.Random(1), 400)
    docs = documents(small_batches(spark), [r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id bigint, quality int, toxic int")
    scored = quality.with_score(docs, quality.fit_tables(docs, labels)).withColumn("out", held_out(F.col("doc_id"))).collect()
    truth = {r[0]: r[2] for r in rows}
    seen = [(r["score"] >= 0.7) == truth[r["doc_id"]] for r in scored if r["out"]]
    assert len(seen) > 50 and sum(seen) >= 0.95 * len(seen)


def test_training_does_not_see_held_out_labels(spark):
    rows = _labelled(random.Random(2), 120)
    docs = documents(small_batches(spark), [r[:2] for r in rows])
    schema = "doc_id bigint, quality int, toxic int"
    one = spark.createDataFrame([(r[0], r[2], 0) for r in rows], schema)
    flipped = one.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit_tables(docs, one), quality.fit_tables(docs, flipped)
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_scores_of_odd_inputs(spark):
    small_batches(spark)
    docs = documents(spark, [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "a b"), (5, "word " * 200_000)]).withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame([(1, None, None), (None, 1, 0), (9, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit_tables(docs, labels)
    scores = [r["q"] for r in quality.with_score(docs, model, score="q").collect()]
    assert len(scores) == 6 and all(0 <= s <= 1 for s in scores)
    assert quality.with_score(docs.limit(0), model, score="q").count() == 0


def _features(text):
    return np.sort(np.concatenate([np.zeros(0, np.int32), *quality.features(text)])).tolist()


@pytest.mark.parametrize("piece", [1, 2, 3, 5, 7, 64, 400])
def test_pieces_change_no_feature(monkeypatch, piece):
    rng = random.Random(3)
    texts = [prose(rng, 120), "", "a", "ab cd", "x" * 900, " " * 50, "  a  a\n\ta a b a b  ", "word " * 90, prose(rng, 3) + "y" * 300 + " z z", "\U0001f600é " * 40]
    whole = [_features(t) for t in texts]
    assert len(whole[0]) > 1000
    monkeypatch.setattr(quality, "PIECE", piece)
    assert [_features(t) for t in texts] == whole


def test_features_are_the_ngrams_words_and_repeats_of_the_text():
    """Counts by the plain definition; equal strings share a bucket, so distinct buckets are at most the distinct strings."""
    text = prose(random.Random(5), 80) + " again again and again"
    words = text.split()
    found = list(quality.features(text))
    assert [len(f) for f in found] == [len(text) - 2, len(text) - 4, len(words), len(words)]
    for ids, items in zip(found, ([text[i : i + 3] for i in range(len(text) - 2)], [text[i : i + 5] for i in range(len(text) - 4)], words), strict=False):
        by_item = {}
        assert all(by_item.setdefault(item, i) == i for item, i in zip(items, ids.tolist(), strict=True))
        assert len(set(by_item.values())) > 0.99 * len(by_item)


def test_scores_equal_a_plain_mean_and_softmax(spark):
    rows = _labelled(random.Random(6), 60)
    docs = documents(small_batches(spark), [r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id bigint, quality int, toxic int")
    model = quality.fit_tables(docs, labels)
    for r in quality.with_score(docs, model).collect():
        values = [float(model.weights[i]) for ids in quality.features(r["text"]) for i in ids.tolist()]
        logit = model.bias + sum(values) / len(values)
        assert abs(r["score"] - np.exp(logit) / (np.exp(logit) + 1)) < 1e-9


def test_one_label_alone_gives_its_share(spark):
    model = quality.train([(np.array([1], np.int32), np.array([1.0], np.float32), 1)], (0.0, 1.0))
    assert model.score("anything") > 0.99


def _rebuilt(rows, context=packing.CONTEXT):
    texts = {}
    for r in rows:
        ids = np.frombuffer(bytes(r["input_ids"]), packing.ID_TYPE)
        ends = r["cu_seqlens"]
        assert len(ids) == context and ends[0] == 0 and ends[-1] == r["n_tokens"] and r["position_resets"] == ends[:-1]
        assert (ids[r["n_tokens"] :] == packing.PAD).all()
        for k, (doc, at) in enumerate(zip(r["doc_ids"], r["doc_offsets"], strict=True)):
            texts.setdefault(doc, []).append((at, ids[ends[k] : ends[k + 1]].tolist()))
    return {d: [t for _, part in sorted(p) for t in part] for d, p in texts.items()}


def test_packing_is_lossless(spark):
    rng = random.Random(4)
    texts = {i: prose(rng, rng.choice([0, 1, 5, 80, 700])) for i in range(60)} | {90: "a  b\n\n c 　 é😀" * 50, 91: None, 92: "<|endoftext|>"}
    rows = packing.pack(documents(small_batches(spark), list(texts.items())).repartition(3), context=128).collect()
    ids_of = packing.tokenizer()
    want = {k: np.frombuffer(ids_of(t or ""), packing.ID_TYPE).tolist() + [packing.END_OF_TEXT] for k, t in texts.items()}
    assert _rebuilt(rows, 128) == want
    assert len({r["pack_id"] for r in rows}) == len(rows)


def test_packing_of_nothing_and_repeated_rows(spark):
    docs = documents(small_batches(spark), [(1, "a b"), (1, "a b"), (None, "c")])
    assert packing.pack(docs.limit(0)).count() == 0
    (row,) = packing.pack(docs.coalesce(1)).collect()
    assert sorted(row["doc_ids"], key=str) == [1, 1, None]


def test_written_rows_read_back(spark, folder):
    rows = packing.pack(documents(small_batches(spark), [(1, "a b c")]))
    packing.write_packed(rows, f"{folder}/packed")
    assert spark.read.parquet(f"{folder}/packed").collect() == rows.collect()


def test_best_fit_decreasing_against_a_plain_search():
    rng = random.Random(5)
    for _ in range(50):
        capacity = rng.randint(1, 40)
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        rows = packing.best_fit_decreasing(sizes, capacity)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        rooms, plain = [], []
        for size in sorted(sizes, reverse=True):
            fits = [r for r in rooms if r >= size]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - size)
            else:
                rooms.append(capacity - size)
                plain.append(size)
        assert len(rows) == len(plain) and sorted(capacity - sum(sizes[i] for i in r) for r in rows) == sorted(rooms)


def test_ids_too_wide_are_refused():
    with pytest.raises(ValueError, match="cannot hold"):
        packing.tokenizer(id_type="<u1")


@pytest.mark.parametrize("run", [" ", "\n", "\t ", "\u2003"])
@pytest.mark.parametrize("after", ["", "x", "\nx", "  "])
def test_cut_runs_of_white_space_give_the_same_ids(monkeypatch, run, after):
    ids_of = packing.tokenizer()
    texts = [before + run * n + after + tail for before in ("", "a b", "a ") for n in (1, 4, 5, 9, 30) for tail in ("", run * 7, " end" + run * 12 + "1")]
    whole = [ids_of(t) for t in texts]
    monkeypatch.setattr(packing, "LONG_RUN", 5)
    cut = packing.tokenizer()
    assert [cut(t) for t in texts] == whole


def test_very_long_runs_are_packed(spark):
    n = 1_500_000
    docs = documents(small_batches(spark), [(1, " " * n), (2, "\n" * n + "x"), (3, "a" * n), (4, "x" + " \n" * n + "y")])
    rows = packing.pack(docs).collect()
    ids_of = packing.tokenizer()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sum(r["n_tokens"] for r in rows) == sum(len(ids_of(t)) // 2 + 1 for t in texts.values())
