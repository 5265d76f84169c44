"""Files of a layer that cannot be read as Parquet: found, told with a reason, and set aside.

A scan that reads no columns opens every file's footer and counts its rows; files it gives nothing for are looked at
themselves. Only those are read, and only their ends reach Python. What is set aside is moved, so a scan of the rest needs
no option that hides damage: a file that breaks later still fails the job that reads it.
"""

from __future__ import annotations

from io import BytesIO

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from paylake.sources.layers import Days, path_exists

#: Files looked at in one job.
SUSPECTS = 1000
#: Fixed values of the format: the mark at both ends, and the bytes of the footer's length and the mark at the end.
MARK, MARK_BYTES, TAIL_BYTES = "PAR1", 4, 8


def _place(root: str, window: Days | None, below: str) -> str:
    return f"{root}/{below}/{window.folders()}" if window else root


def _listing(spark: SparkSession, root: str, window: Days | None, below: str) -> DataFrame:
    """`file, bytes, name`; the name is how scans spell the file. Contents are not read."""
    if not path_exists(spark, root):
        raise ValueError(f"no such layer: {root}")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    found = reader.load(_place(root, window, below))
    held = found.select(F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("_metadata.file_path").alias("name"))
    # Scans pass over files without bytes; the index that the driver holds for a scan has them.
    every = spark.createDataFrame([(name.replace(":///", ":/"),) for name in found.inputFiles()], "name string")
    plain = F.url_decode(F.replace(F.col("name"), F.lit("+"), F.lit("%2B")))
    unheld = every.join(held.select("name"), "name", "left_anti").select(plain.alias("file"), F.lit(0).cast("bigint").alias("bytes"), "name")
    return held.unionByName(unheld)


def listed_files(spark: SparkSession, root: str, window: Days | None = None, below: str = "source=*") -> DataFrame:
    """`file, bytes` of all files of a layer, or of a window of it."""
    return _listing(spark, root, window, below).drop("name")


def _with_rows(spark: SparkSession, root: str, window: Days | None, below: str) -> DataFrame:
    """Files that give rows. No column is asked for, so footers are all that is read."""
    reader = spark.read.schema("_ string").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    rows = reader.option("ignoreCorruptFiles", True).parquet(_place(root, window, below))
    return rows.groupBy(F.col("_metadata.file_path").alias("name")).agg(F.count(F.lit(1)).alias("rows"))


def _is_footer(end: Column) -> Column:
    """Whether the end of a file, from the footer on, is one that Parquet can read."""

    @F.pandas_udf(BooleanType())
    def readable(ends: pd.Series) -> pd.Series:
        def one(end: bytes | None) -> bool:
            try:
                return end is not None and pq.read_metadata(BytesIO(MARK.encode() + bytes(end))) is not None
            except Exception:  # whatever is wrong with it, it is no footer
                return False

        return pd.Series([one(e) for e in ends], dtype=bool)

    return readable(end)


def _looked_at(spark: SparkSession, files: list[str]) -> DataFrame:
    """`file, bytes, reason`; no reason for a file that is sound and has no rows."""
    raw = spark.read.format("binaryFile").load(files).select(F.col("path").alias("file"), F.col("length").alias("bytes"), "content")
    size = F.expr(f"CAST(conv(hex(reverse(substring(content, bytes - {TAIL_BYTES} + 1, 4))), 16, 10) AS BIGINT)")
    ends = raw.select(
        "file", "bytes", F.expr(f"substring(content, 1, {MARK_BYTES})").cast("string").alias("head"), F.expr(f"substring(content, bytes - {MARK_BYTES} + 1)").cast("string").alias("tail"),
        size.alias("footer"), "content",
    )
    fits = F.col("footer") <= F.col("bytes") - TAIL_BYTES - MARK_BYTES
    kept = ends.withColumn("end", F.when(fits, F.expr(f"substring(content, bytes - footer - {TAIL_BYTES} + 1)"))).drop("content")
    reason = (
        F.when(F.col("bytes") < TAIL_BYTES + MARK_BYTES, "too_short").when(F.col("head") != MARK, "not_parquet")
        .when(F.col("tail") != MARK, "cut").when(~fits, "bad_footer").when(~_is_footer(F.col("end")), "bad_footer")
    )
    return kept.select("file", "bytes", reason.alias("reason"))


def unreadable_files(spark: SparkSession, root: str, window: Days | None = None, below: str = "source=*") -> DataFrame:
    """`file, bytes, reason` of files that are no readable Parquet: empty, too_short, not_parquet, cut or bad_footer.

    Every other file is read or has no rows. Damage inside a file whose footer is sound is found by the scan that reads it.
    """
    silent = _listing(spark, root, window, below).join(_with_rows(spark, root, window, below), "name", "left_anti")
    suspects = silent.filter("bytes > 0").select("file")
    found = silent.filter("bytes = 0").select("file", "bytes", F.lit("empty").alias("reason"))
    block: list[str] = []
    # File names only, a block at a time; sound files with rows are not among them.
    for row in suspects.toLocalIterator():
        block.append(row["file"])
        if len(block) == SUSPECTS:
            found, block = found.unionByName(_looked_at(spark, block)), []
    return (found.unionByName(_looked_at(spark, block)) if block else found).filter("reason IS NOT NULL")


def set_aside(spark: SparkSession, root: str, aside: str, window: Days | None = None, below: str = "source=*") -> dict:
    """Move unreadable files below `aside`, under their path in the layer, and tell `{reason: files}` with `listed` and `read`.

    A run that fails half-way is finished by the next one. Moved files are told by `aside_log`.
    """
    listed = listed_files(spark, root, window, below).count()
    found = unreadable_files(spark, root, window, below).collect()
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsparkSession.sessionState().newHadoopConf()
    base = hadoop.Path(root)
    files = base.getFileSystem(conf)
    home = files.makeQualified(base).toUri().getPath().rstrip("/") + "/"
    counts = {"listed": listed, "read": listed - len(found)}
    for row in found:
        source = hadoop.Path(row["file"])
        target = hadoop.Path(f"{aside}/reason={row['reason']}/{source.toUri().getPath().removeprefix(home)}")
        files.mkdirs(target.getParent())
        if not files.rename(source, target):
            raise OSError(f"could not move {row['file']}")
        counts[row["reason"]] = counts.get(row["reason"], 0) + 1
    return counts


def aside_log(spark: SparkSession, aside: str) -> DataFrame:
    """`file, bytes, reason` of what was set aside."""
    stored = _listing(spark, aside, None, "")
    return stored.select("file", "bytes", F.regexp_extract("file", "/reason=([^/]+)/", 1).alias("reason"))
