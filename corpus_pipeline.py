"""The corpus pipeline: each stage is written as Parquet and read again as the next one's documents.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from paylake.llm import decontaminate, jaccard, mixing, packing, quality
from paylake.llm.common import small_batches, staged, table, unused

#: Near duplicates share this percentage of their word shingles; `op8_jaccard` keeps the values of its own contract.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects. It is trained on the labelled documents of this stage's input."""
    model = quality.fit_tables(docs, table(small_batches(spark), sf_dir, "labels"))
    score = unused(docs, "_score")
    return quality.with_score(docs, model, score=score).filter(F.col(score) >= quality.THRESHOLD).drop(score)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, keep the document with the smallest doc_id.

    Rows that repeat both doc_id and text are one document. Rows without doc_id have no group and stay.
    """
    small_batches(spark)
    groups = jaccard.jaccard_components(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)
    first = groups.filter("doc_id = component_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).union(docs.filter("doc_id IS NULL"))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    leaks = unused(docs, "_leaks")
    found = decontaminate.with_leaks(docs, table(small_batches(spark), sf_dir, "benchmark"), leaks=leaks)
    return found.filter(F.size(leaks) == 0).drop(leaks)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take domains, languages and sources by weight; a document taken in two epochs comes twice."""
    epoch = unused(docs, "_epoch")
    return mixing.mix(docs, mixing.document_levels(), mixing.word_count(F.col("text")), epoch=epoch).drop(epoch)


def packed_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in rows of fixed length."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_clean),
    ("mixing", mix_sources),
    ("token_ids", packed_ids),
]
#: The classifier, edit distances and token ids have no SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a table folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
