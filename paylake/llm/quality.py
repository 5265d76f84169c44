"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its hashed words and character n-grams; a softmax layer turns the mean into
class probabilities. Training is stochastic gradient descent in numpy on a bounded sample of labelled documents. Scoring
uses that the logit of a mean is the mean of logits: each bucket keeps one number, its vector times the output weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm.common import held_out, small_batches, table

BITS = 17
BUCKETS = 1 << BITS
NGRAMS = (3, 5)
DIM = 16
#: Labelled documents used for training, half of each class if there are as many.
MAX_TRAINING_ROWS = 3000
EPOCHS = 6
RATE = 0.5
THRESHOLD = 0.7
#: Characters of a text that are hashed at a time; bounds memory, never changes features.
PIECE = 1 << 19

_BASE = np.uint32(0x01000193)
_INVERSE = np.uint32(pow(0x01000193, -1, 1 << 32))


def _powers(base: np.uint32, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint32)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint32)


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint32(salt * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(15)
    return ((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)).astype(np.int32)


def features(text: str) -> Iterator[np.ndarray]:
    """Arrays of bucket numbers, one per occurrence: n-grams of code points, words, and how each word repeats.

    A piece is handed the last characters, the open word and the last two words before it, so the features are those of the
    whole text wherever it is cut.
    """
    tail, before = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    open_hash, open_length = np.uint32(0), 0
    for at in range(0, len(text), PIECE):
        points = np.frombuffer(text[at : at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        joined = np.concatenate((tail, points))
        h, n = joined, 1
        for size in NGRAMS:
            while n < size and len(h) > 1:
                h = h[:-1] * _BASE + joined[n:]
                n += 1
            if n == size:
                yield _bucket(h[max(0, len(tail) - size + 1) :], size)
        tail = joined[-(max(NGRAMS) - 1) :]

        space, last = points <= 32, at + PIECE >= len(text)
        starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
        ends = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
        sums = np.concatenate((np.zeros(1, np.uint32), np.cumsum(points * _powers(_BASE, len(points)), dtype=np.uint32)))
        words = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(points))[starts]
        if open_length:
            if space[0]:
                words = np.concatenate(([open_hash], words)).astype(np.uint32)
            else:
                words[:1] = open_hash + words[:1] * np.uint32(pow(int(_BASE), open_length, 1 << 32))
        carried = open_length if open_length and not space[0] else 0
        open_length = 0
        if not space[-1] and not last:
            open_hash, open_length = words[-1], int(ends[-1] - starts[-1]) + (carried if len(starts) == 1 else 0)
            words = words[:-1]
        if not len(words):
            continue
        yield _bucket(words, 1)
        run = np.concatenate((before, words)).astype(np.uint32)
        repeats = np.zeros(len(run), np.uint32)
        repeats[2:][run[2:] == run[:-2]] = 2
        repeats[1:][run[1:] == run[:-1]] = 1
        yield _bucket(repeats[len(before) :], 2)
        before = run[-2:]


@dataclass
class QualityModel:
    """One weight per bucket and a bias; score is the probability of label 1."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        total, count = 0.0, 0
        for ids in features(text or ""):
            total += float(self.weights[ids].sum(dtype=np.float64))
            count += len(ids)
        return float(1 / (1 + np.exp(-np.clip(self.bias + (total / count if count else 0.0), -700, 700))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], shares: tuple[float, float], seed: int = 7) -> QualityModel:
    """rows: distinct buckets, their shares of the document, label. shares: of both labels among all labelled rows.

    Samples are balanced, so each loss is weighted back to the shares found in the whole table. With one label only,
    the score is the constant share.
    """
    counts = np.bincount([y for *_, y in rows], minlength=2)
    if not rows or min(counts) == 0:
        p = np.clip(shares[1] if sum(shares) else 0.5, 1e-3, 1 - 1e-3)
        return QualityModel(np.zeros(BUCKETS, np.float32), float(np.log(p / (1 - p))))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.log(np.maximum(shares, 1e-6)).astype(np.float32)
    weight = np.array(shares) / (counts / counts.sum())
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            ids, share, label = rows[i]
            rate = RATE * (1 - step / steps)
            step += 1
            if not len(ids):
                continue
            found = vectors[ids]
            hidden = share @ found
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            p *= weight[label]
            back = out @ p
            out -= rate * np.outer(hidden, p)
            bias -= rate * 0.1 * p
            # A mean spreads its gradient over thousands of vectors; dividing by |share|^2 keeps the step of the mean.
            vectors[ids] = found - (rate / float(share @ share)) * np.outer(share, back)
    return QualityModel((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> QualityModel:
    """Train on docs (id, text) that labels (id, label) mark. The hash of the id orders the sample, the same in every run.

    Rows without a label of 0 or 1 or without an id are not used; of an id labelled twice the smaller label counts, and of
    one with several texts the first in order. Only ids meet to draw the sample, which then goes to the documents: at most
    `max_rows` ids. One task trains on the sample's bucket counts, no more than `BUCKETS` per document, and the driver gets
    one weight per bucket.
    """
    known = labels.filter("label IN (0, 1) AND id IS NOT NULL").groupBy("id").agg(F.min("label").cast("int").alias("label"))
    ids = known.join(docs.select("id"), "id", "left_semi")
    order = [F.xxhash64("id"), F.col("id")]
    shares = {r["label"]: r["n"] for r in ids.groupBy("label").agg(F.count("*").alias("n")).collect()}
    picked = [ids.filter(F.col("label") == y).orderBy(*order).limit(max_rows // 2) for y in (0, 1)]
    sample = picked[0].union(picked[1])

    @F.pandas_udf("struct<ids: binary, share: binary>")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            made = []
            for text in batch:
                parts = [np.zeros(0, np.int32), *features(text or "")]
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                made.append((found.astype("<i4").tobytes(), (n / max(1, n.sum())).astype("<f4").tobytes()))
            yield pd.DataFrame(made, columns=["ids", "share"])

    texts = docs.join(F.broadcast(sample), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    total = max(1, sum(shares.values()))
    parts = (shares.get(0, 0) / total, shares.get(1, 0) / total)

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        model = train([(np.frombuffer(a, "<i4"), np.frombuffer(b, "<f4"), y) for _, y, a, b in rows], parts)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.astype("<f4").tobytes()]), pa.array([model.bias])], ["weights", "bias"])

    sample = texts.select("id", "label", counted("text").alias("f")).select("id", "label", "f.ids", "f.share")
    made = sample.repartition(1).mapInArrow(trained, "weights binary, bias double").first()
    return QualityModel(np.frombuffer(bytes(made["weights"]), "<f4"), made["bias"])


def with_score(docs: DataFrame, model: QualityModel, text: str = "text", score: str = "score") -> DataFrame:
    """Add the score of each whole text. Null and empty texts get the score of no evidence, the bias alone."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = QualityModel(*sent.value)
        for batch in batches:
            yield pd.Series([model.score(t) for t in batch], dtype="float64")

    return docs.withColumn(score, scored(F.col(text)))


def fit_tables(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Train on the labelled documents that are not held out."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")).filter(~held_out(F.col("id")))
    return fit(docs.select(F.col("doc_id").alias("id"), "text"), known)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_tables(docs, table(spark, sf_dir, "labels"))
    return with_score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
