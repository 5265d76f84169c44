import glob
import math
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest

from paylake.operators import compact as compaction
from paylake.plans.jobs import compact_days, compact_previous_day
from paylake.schemas import HOUR_PARTS
from paylake.sources.layers import replace_parts, scan_analytics, scan_processed

FIRST, LAST = date(2026, 2, 27), date(2026, 2, 28)


def put_day(spark, root, day, rows, files, value="concat('t', id)", source="faker"):
    df = spark.range(0, rows, 1, files).selectExpr(
        f"'{source}' AS source", "TIMESTAMP_NTZ'2026-02-27 00:00:00' AS received_at", f"{value} AS transaction_id", "'u' AS user_id",
        "CAST(id AS DOUBLE) AS amount", "'eur' AS currency", "'debit' AS transaction_type",
        f"'{day:%Y}' AS year", f"'{day:%m}' AS month", f"'{day:%d}' AS day", "IF(id % 3 = 0, '04', '17') AS hr",
    )
    replace_parts(df, f"{root}/source={source}", HOUR_PARTS)


def files_of(root, day, source="faker"):
    return sorted(glob.glob(f"{root}/tb-{source}/year={day:%Y}/month={day:%m}/day={day:%d}/*.parquet"))


def multiset(df):
    return sorted(map(tuple, df.select("transaction_id", "amount", "year", "month", "day").collect()))


def plan_by_hand(paths, target):
    rows = sum(pq.ParquetFile(path).metadata.num_rows for path in paths)
    size = sum(len(open(path, "rb").read()) for path in paths)
    per_file = max(1, int(target / (size / rows)))
    return rows, per_file, math.ceil(rows / per_file)


@pytest.mark.parametrize("target", [3_000, 20_000, 10**9])
def test_files_are_exact_slices(spark, folder, target):
    put_day(spark, folder, FIRST, 5_000, 7)
    put_day(spark, folder, LAST, 300, 3)
    out = f"{folder}-out"
    compact_days(spark, folder, out, FIRST, LAST, ["faker"], target)
    for day in (FIRST, LAST):
        rows, per_file, files = plan_by_hand(glob.glob(f"{folder}/source=faker/*/*/day={day:%d}/*/*.parquet"), target)
        sizes = sorted(pq.ParquetFile(path).metadata.num_rows for path in files_of(out, day))
        assert len(sizes) == files
        assert sum(sizes) == rows
        assert sizes[1:] == [per_file] * (files - 1)
    assert multiset(scan_analytics(spark, out, "faker")) == multiset(scan_processed(spark, folder, "faker"))


def test_copies_of_one_row_spread_over_files(spark, folder):
    put_day(spark, folder, FIRST, 4_000, 5, value="'same'")
    out = f"{folder}-out"
    compact_days(spark, folder, out, FIRST, FIRST, ["faker"], 4_000)
    sizes = sorted(pq.ParquetFile(path).metadata.num_rows for path in files_of(out, FIRST))
    assert len(sizes) > 3 and len(set(sizes[1:])) == 1 and sum(sizes) == 4_000


def test_rerun_leaves_no_stale_files(spark, folder):
    out = f"{folder}-out"
    put_day(spark, folder, FIRST, 4_000, 4)
    compact_days(spark, folder, out, FIRST, FIRST, ["faker"], 3_000)
    many = len(files_of(out, FIRST))
    compact_days(spark, folder, out, FIRST, FIRST, ["faker"])
    assert many > 1 and len(files_of(out, FIRST)) == 1
    assert multiset(scan_analytics(spark, out, "faker")) == multiset(scan_processed(spark, folder, "faker"))


def test_other_days_and_days_without_data(spark, folder):
    out = f"{folder}-out"
    put_day(spark, folder, FIRST, 100, 2)
    put_day(spark, folder, LAST, 100, 2)
    compact_previous_day(spark, folder, out, datetime(2026, 2, 28, 1, 45), ["faker"])
    assert files_of(out, FIRST) and not files_of(out, LAST)
    compact_days(spark, folder, out, date(2030, 1, 1), date(2030, 1, 2), ["faker"])
    assert len(glob.glob(f"{out}/tb-faker/year=*")) == 1


def test_only_the_days_that_fail_are_left_out(spark, folder):
    out = f"{folder}-out"
    days = [date(2026, 2, number) for number in (1, 2, 5, 9)]
    for day in days:
        put_day(spark, folder, day, 100, 2)
    put_day(spark, folder, FIRST, 100, 2, source="revolut")
    broken = glob.glob(f"{folder}/source=faker/*/*/day=05/*/*.parquet")[0]
    with open(broken, "wb") as file:
        file.write(b"PAR1 broken PAR1")
    with pytest.raises(RuntimeError, match="faker 2026-02-05") as raised:
        compact_days(spark, folder, out, date(2026, 2, 1), LAST, ["faker", "stripe", "revolut"])
    assert "revolut" not in str(raised.value) and "2026-02-02" not in str(raised.value)
    assert scan_analytics(spark, out, "revolut").count() == 100
    assert {row.day for row in scan_analytics(spark, out, "faker").select("day").distinct().collect()} == {"01", "02", "09"}


def test_a_failed_write_is_tried_day_by_day(spark, folder, monkeypatch):
    out, write = f"{folder}-out", compaction._write_day

    def fails_for_the_second(session, table, files, day, path):
        if day.day == "02":
            raise OSError("disk gone")
        write(session, table, files, day, path)

    monkeypatch.setattr(compaction, "_write_day", fails_for_the_second)
    for number in (1, 2, 3):
        put_day(spark, folder, date(2026, 2, number), 50, 1)
    with pytest.raises(RuntimeError, match="faker 2026-02-02: disk gone"):
        compact_days(spark, folder, out, date(2026, 2, 1), date(2026, 2, 3), ["faker"])
    assert {row.day for row in scan_analytics(spark, out, "faker").select("day").distinct().collect()} == {"01", "03"}


def test_a_task_may_write_several_files(spark, folder):
    out = f"{folder}-out"
    put_day(spark, folder, FIRST, 3_000, 4)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        compact_days(spark, folder, out, FIRST, FIRST, ["faker"], 4_000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    rows, per_file, files = plan_by_hand(glob.glob(f"{folder}/source=faker/*/*/*/*/*.parquet"), 4_000)
    sizes = sorted(pq.ParquetFile(path).metadata.num_rows for path in files_of(out, FIRST))
    assert files > 4 and len(sizes) == files and sum(sizes) == rows and sizes[1:] == [per_file] * (files - 1)


def test_the_source_is_stored(spark, folder):
    out = f"{folder}-out"
    put_day(spark, folder, FIRST, 10, 1)
    compact_days(spark, folder, out, FIRST, FIRST, ["faker"])
    assert {r.source for r in scan_analytics(spark, out, "faker").collect()} == {"faker"}


def test_plan(spark, folder):
    put_day(spark, folder, FIRST, 1_000, 4)
    plan = compaction.compaction_plan(compaction.stored_files(scan_processed(spark, folder, "faker")), 5_000).first()
    paths = glob.glob(f"{folder}/source=faker/*/*/*/*/*.parquet")
    assert (plan.rows, plan.rows_per_file, plan.files) == plan_by_hand(paths, 5_000)


def test_plan_reads_no_columns(spark, folder):
    from tests.conftest import plan_of

    put_day(spark, folder, FIRST, 10, 1)
    assert "ReadSchema: struct<>" in plan_of(compaction.stored_files(scan_processed(spark, folder, "faker")))


def test_a_row_larger_than_the_target(spark):
    row = compaction.plan_sizes(spark.sql("SELECT 3L AS rows, 3000L AS bytes"), 10).first()
    assert (row.rows_per_file, row.files) == (1, 3)
    assert compaction.TARGET_BYTES == 128 * 1024 * 1024
