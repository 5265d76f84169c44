"""Shared helpers: tables, written intermediates, and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.session import scratch_folder

# Rows per Arrow batch. Texts may be long, and a worker holds a batch whole.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, and a lost executor costs no recomputation."""
    path = scratch_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def merge_joins(spark: SparkSession) -> Iterator[None]:
    """No broadcasts: small Parquet files may hold many rows, and a plan should be the same at every size."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "-1")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores added until no column of df starts with it."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name += "_"
    return name


def held_out(doc_id) -> F.col:
    """Rows that no training sees: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Alternates large-star and small-star steps. Each step is a grouped minimum, which combines map-side, and a join,
    which the adaptive planner splits when one hub has most edges. Only two numbers reach the driver per round.
    """
    pairs = edges.select(F.least(left, right).alias("u"), F.greatest(left, right).alias("v")).filter("u < v").distinct()
    pairs, mark = _marked(pairs)
    while mark[0]:
        both = pairs.union(pairs.select("v", "u"))
        lows = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(lows, "u").filter("v > u").select(F.col("low").alias("u"), "v").filter("u < v").distinct()
        mins = large.groupBy("v").agg(F.min("u").alias("low"))
        small = (
            large.join(mins, "v")
            .select(F.explode(F.array(F.struct(F.col("low").alias("u"), F.col("u").alias("v")), F.struct(F.col("low").alias("u"), "v"))).alias("e"))
            .select("e.u", "e.v")
            .filter("u < v")
            .distinct()
        )
        pairs, now = _marked(small)
        if now == mark:
            break
        mark = now
    members = pairs.groupBy("v").agg(F.min("u").alias("component")).select(F.col("v").alias("node"), "component")
    return members.union(pairs.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())


def _marked(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    pairs = staged(pairs, "components")
    row = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return pairs, (row["n"], row["h"])
