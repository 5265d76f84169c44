"""Reading and writing the three stored layers.

raw        source=S/year=/month=/day=/hr=/batch=    envelopes, payload as JSON text
processed  source=S/year=/month=/day=/hr=    typed rows of one source
analytics  tb-S/year=/month=/day=            the same rows in files of bounded size

Dates, hours and sources are predicates on partition columns, so a window of any size is one pruned scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.schemas import DAY_PARTS, HOUR_PARTS, RAW, processed_schema, with_parts
from paylake.session import settings
from paylake.sources.swaps import BATCH, is_visible, read_swaps


# --- windows of days and hours -------------------------------------------------------------------

def as_day(value: date | str) -> date:
    """A day, given as such or as `yyyy-mm-dd`; a time counts as its day."""
    if isinstance(value, str):
        return datetime.strptime(value, "%Y-%m-%d").date()
    if not isinstance(value, date):
        raise TypeError(f"a day is a date or text, not {type(value).__name__}")
    return date(value.year, value.month, value.day)


def days_between(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day of the window, as `date` and as partition values."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
    return days.select(
        "date",
        F.date_format("date", "yyyy").alias("year"),
        F.date_format("date", "MM").alias("month"),
        F.date_format("date", "dd").alias("day"),
    )


@dataclass(frozen=True)
class Days:
    """A window of days, both ends included, and optionally one hour of them."""

    first: date
    last: date
    hour: int | None = None

    def __post_init__(self) -> None:
        if self.first > self.last:
            raise ValueError(f"the window starts on {self.first}, after its end on {self.last}")

    @classmethod
    def on(cls, day: date | str, hour: int | None = None) -> Days:
        return cls(as_day(day), as_day(day), hour)

    @classmethod
    def through(cls, first: date | str, last: date | str) -> Days:
        return cls(as_day(first), as_day(last))

    def predicate(self) -> Column:
        """On partition columns: zero-padded parts compare like the dates they spell."""
        stamp = F.concat("year", "month", "day")
        inside = F.col("year").between(f"{self.first:%Y}", f"{self.last:%Y}") & stamp.between(
            f"{self.first:%Y%m%d}", f"{self.last:%Y%m%d}"
        )
        return inside if self.hour is None else inside & (F.col("hr") == f"{self.hour:02d}")

    def halves(self) -> list[Days]:
        """The window in two parts; none for a single day."""
        if self.first == self.last:
            return []
        middle = self.first + (self.last - self.first) // 2
        return [Days(self.first, middle, self.hour), Days(middle + timedelta(days=1), self.last, self.hour)]

    def day_folders(self) -> str:
        """The days of the window as a path pattern, whatever its hour."""
        return Days(self.first, self.last).folders()

    def folders(self) -> str:
        """The same window as a path pattern; a month that lies inside as a whole is one entry."""
        entries, day = [], self.first
        while day <= self.last:
            following = (day.replace(day=1) + timedelta(days=32)).replace(day=1)
            if day.day == 1 and following - timedelta(days=1) <= self.last:
                entries.append(f"{day:year=%Y/month=%m/day=*}")
                day = following
            else:
                entries.append(f"{day:year=%Y/month=%m/day=%d}")
                day += timedelta(days=1)
        days = entries[0] if len(entries) == 1 else "{" + ",".join(entries) + "}"
        return days if self.hour is None else f"{days}/hr={self.hour:02d}"


def in_previous_hour(now: datetime) -> Days:
    """The whole hour before the one `now` is in; at midnight that is 23 h of the day before."""
    hour = now.replace(minute=0, second=0, microsecond=0) - timedelta(hours=1)
    return Days.on(hour, hour.hour)


def in_previous_day(now: datetime) -> Days:
    return Days.on(now - timedelta(days=1))


# --- scans ---------------------------------------------------------------------------------------
#
# A window names the folders to list, so a daily run does not list years of data.


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(target)


def _scan(
    spark: SparkSession,
    schema: T.StructType,
    base: str,
    below: str,
    window: Days | None,
    ignore_corrupt: bool,
    seen: Column | None = None,
) -> DataFrame:
    """Read `base`, or its part `below`, cut to the window and to the batches seen."""
    reader = (
        spark.read.schema(schema)
        .option("basePath", base)
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", ignore_corrupt)
    )
    if not path_exists(spark, base):
        raise ValueError(f"no such layer: {base}")
    else:
        path = "/".join(part for part in (base, below, window.folders() if window else "") if part)
        try:
            df = reader.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            df = spark.read.schema(schema).parquet()  # no folder of the window exists: a scan of no files
    if seen is not None and BATCH in df.columns:
        df = df.filter(seen)
    # Levels below the partitions of the schema are no columns.
    df = df.select(*schema.names)
    return df if window is None else df.filter(window.predicate())


def scan_raw(
    spark: SparkSession,
    root: str,
    window: Days | None = None,
    sources: Sequence[str] | None = None,
    ignore_corrupt: bool = False,
) -> DataFrame:
    """Raw rows; unreadable files fail the job unless `ignore_corrupt`. Merged batches stand for those they replace."""
    # Before the folders are listed: a swap published in between is not seen, and neither are its folders.
    seen = is_visible(read_swaps(spark, root, *([window.day_folders()] if window else [])))
    if sources is None:
        return _scan(spark, RAW, root, "source=*" if window else "", window, ignore_corrupt, seen)
    names = list(sources)
    below = "source=" + (names[0] if len(names) == 1 else "{" + ",".join(names) + "}")
    return _scan(spark, RAW, root, below, window, ignore_corrupt, seen).filter(F.col("source").isin(names))


def scan_raw_batches(spark: SparkSession, root: str, window: Days) -> DataFrame:
    """Raw rows of all batch folders, replaced ones included, with their batch and `_metadata`."""
    schema = with_parts(RAW, [BATCH])
    reader = spark.read.schema(schema).option("basePath", root).option("pathGlobFilter", "*.parquet")
    try:
        df = reader.parquet(f"{root}/source=*/{window.folders()}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.read.schema(schema).parquet()
    return df.filter(window.predicate())


def scan_processed(
    spark: SparkSession, root: str, source: str, window: Days | None = None, ignore_corrupt: bool = False
) -> DataFrame:
    schema = with_parts(processed_schema(source), HOUR_PARTS)
    return _scan(spark, schema, root, f"source={source}", window, ignore_corrupt)


def scan_analytics(spark: SparkSession, root: str, source: str, window: Days | None = None) -> DataFrame:
    return _scan(spark, with_parts(processed_schema(source), DAY_PARTS), f"{root}/tb-{source}", "", window, False)


# --- sinks ---------------------------------------------------------------------------------------

#: Folders a task writes to side by side; rows of further ones are sorted first.
OPEN_HOURS = 64
#: A row group of each of these is in memory.
ROW_GROUP_BYTES = 4 * 1024 * 1024
#: For the time of a write; its option `parquet.block.size` is ROW_GROUP_BYTES then.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_HOURS)}


def gathered(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together before a write, without making one task own a large one.

    A rebalance, unlike a plain repartition, lets the runtime cut a partition that grew too large and join
    small ones, so a source that holds a third of all rows is written by many tasks.
    """
    return df.hint("rebalance", *[F.col(part) for part in parts])


def _stored_parts(spark: SparkSession, path: str, window: Days, parts: Sequence[str]) -> list[str]:
    """The partitions of a window that exist below `path`, as folder names joined by slashes."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    hours = "/hr=*" if "hr" in parts and window.hour is None else ""
    pattern = hadoop.Path(f"{path}/{window.folders()}{hours}")
    found = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern)
    return ["/".join(status.getPath().toString().split("/")[-len(parts):]) for status in found or []]


def remove_parts(spark: SparkSession, path: str, window: Days, parts: Sequence[str], keep: Collection[str]) -> None:
    """Remove the partitions of a window that are not in `keep`."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for part in _stored_parts(spark, path, window, parts):
        if part not in keep:
            target = hadoop.Path(f"{path}/{part}")
            target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def replace_parts(df: DataFrame, path: str, parts: Sequence[str], **options) -> None:
    """Replace the partitions present in `df` below `path`; others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options).partitionBy(*parts).parquet(path)


def replace_window(df: DataFrame, path: str, window: Days, parts: Sequence[str]) -> int:
    """Make the window below `path` hold the rows of `df` and nothing else; returns how many those are.

    Partitions with rows are replaced by the write; those without any are removed once it has succeeded, so a job that
    fails in between leaves rows that the next run removes, and never loses any. Which have rows comes from the write
    itself; the calendar bounds the list, one entry per hour or day of the window.
    """
    named = F.concat_ws("/", *[F.concat(F.lit(f"{part}="), F.col(part)) for part in parts])
    seen = Observation()
    replace_parts(df.observe(seen, F.collect_set(named).alias("parts"), F.count(F.lit(1)).alias("rows")), path, parts)
    remove_parts(df.sparkSession, path, window, parts, set(seen.get["parts"]))
    return seen.get["rows"]


def append_raw(rows: DataFrame, root: str) -> None:
    """Add rows to a raw layer, as a batch with a name of its own.

    Texts of messages are the bulk of a lake, so they are written where they were read: nothing is shuffled, and a task of up
    to `OPEN_HOURS` hours sorts nothing.
    """
    batch = rows.withColumn(BATCH, F.lit(f"job-{uuid.uuid4().hex}")).write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES)
    with settings(rows.sparkSession, UNSORTED):
        batch.partitionBy("source", *HOUR_PARTS, BATCH).parquet(root)
