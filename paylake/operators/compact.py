"""Rewrite the files of a day into files of a target size.

The plan needs no row data: rows per file come from one scan without columns, kept as a small table and used for the plan
and the offsets; file sizes come from the listing. A day of `rows` rows and `bytes` bytes gets files of
`rows_per_file = max(1, target * rows / bytes)` rows. Each row then knows its target file: the rows of all files before it
in the day, plus its own index in its file, divided by `rows_per_file`. That is exact, the same on every attempt, and does
not look at row values, so copies of one row spread like any other rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from paylake.schemas import DAY_PARTS
from paylake.session import for_each, scratch_folder
from paylake.sources.layers import Days, path_exists, remove_parts, replace_parts, scan_processed

# Fixed value: default size of a compacted file.
TARGET_BYTES = 134_217_728
#: Days of one source whose jobs run at the same time.
DAYS_AT_ONCE = 8


def plan_sizes(totals: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Add `rows_per_file` and `files` to a table with `rows` and `bytes`."""
    per_row = F.col("bytes") / F.col("rows")
    capped = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(target_bytes) / per_row))
    return totals.withColumn("rows_per_file", capped).withColumn(
        "files", F.ceil(F.col("rows") / F.col("rows_per_file")).cast("bigint")
    )


def stored_files(table: DataFrame) -> DataFrame:
    """One row per stored file: `year, month, day, file, rows, bytes`."""
    return (
        table.select(*DAY_PARTS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        .groupBy(*DAY_PARTS, "file")
        .agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("bytes"))
    )


def compaction_plan(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Of stored files, one row per day: `year, month, day, rows, bytes, rows_per_file, files`."""
    totals = files.groupBy(*DAY_PARTS).agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    return plan_sizes(totals, target_bytes)


def file_offsets(files: DataFrame) -> DataFrame:
    """Of the stored files of one day, the position of each file's first row within the day."""
    before = Window.partitionBy(*DAY_PARTS).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))


def _write_day(spark: SparkSession, table: DataFrame, files: DataFrame, day, path: str) -> None:
    """Compact one day. Each task writes consecutive files, in order, and cuts them by their number of rows.

    There are as many tasks as the session shuffles into, or as many as files if those are fewer, so the blocks of the
    shuffle do not grow with the square of a day.
    """
    of_day = (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
    tasks = min(day.files, int(spark.conf.get("spark.sql.shuffle.partitions")))
    per_task = -(-day.files // tasks)
    located = table.filter(of_day).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index")
    )
    slice_id = (F.col("first") + F.col("row_index")).cast("bigint")
    sliced = located.join(file_offsets(files.filter(of_day)), "file").withColumn("slice", F.floor(slice_id / F.lit(day.rows_per_file)).cast("int"))
    dealt = sliced.repartitionById(tasks, F.floor(F.col("slice") / per_task).cast("int")).sortWithinPartitions("slice")
    rows = dealt.drop("file", "row_index", "first", "slice", "hr")
    replace_parts(rows, path, DAY_PARTS, maxRecordsPerFile=day.rows_per_file)


def _first_line(error: Exception) -> str:
    return str(error).partition("\n")[0]


def compact(
    spark: SparkSession,
    processed_root: str,
    analytics_root: str,
    sources: Sequence[str],
    window: Days | None = None,
    target_bytes: int = TARGET_BYTES,
    ignore_corrupt: bool = False,
) -> None:
    """Compact the days of a window, the sources side by side, and several days of a source at a time.

    Afterwards the window holds the compacted days and nothing else. What fails does not stop the rest: it is tried again
    in smaller pieces, down to single days, and the days that still fail are raised together at the end; what they held
    before stays.
    """

    def compact_window(source: str, days: Days | None) -> list[str]:
        path = f"{analytics_root}/tb-{source}"
        try:
            table = scan_processed(spark, processed_root, source, days, ignore_corrupt)
            place = scratch_folder(spark, "stored-files")
            stored_files(table).write.parquet(place)
            files = spark.read.parquet(place)
            # One row per calendar day of one source, whatever the size of the data.
            planned = compaction_plan(files, target_bytes).orderBy(*DAY_PARTS).collect()
        except Exception as error:  # noqa: BLE001 - told to the caller at the end
            halves = days.halves() if days else []
            if not halves:
                return [f"{source} {days.first if days else ''}: {_first_line(error)}"]
            return [failure for half in halves for failure in compact_window(source, half)]

        def write(day: Row) -> list[str]:
            try:
                _write_day(spark, table, files, day, path)
            except Exception as error:  # noqa: BLE001
                return [f"{source} {day.year}-{day.month}-{day.day}: {_first_line(error)}"]
            return []

        failures = [failure for found in for_each(planned, write, DAYS_AT_ONCE) for failure in found]
        if days and path_exists(spark, path):
            remove_parts(spark, path, days, DAY_PARTS, {f"year={d.year}/month={d.month}/day={d.day}" for d in planned})
        return failures

    failures = [
        failure for found in for_each(sources, lambda source: compact_window(source, window)) for failure in found
    ]
    if failures:
        raise RuntimeError("compaction failed for " + "; ".join(failures))
