import glob
import json
import os
from datetime import date, datetime

import pytest

from paylake.operators.envelope import read_envelopes, valid_rows
from paylake.plans.jobs import compact_days, ingest_batch, payload_rejects, process_days, process_previous_hour
from paylake.sources.layers import (
    Days,
    append_raw,
    days_between,
    in_previous_day,
    in_previous_hour,
    scan_analytics,
    scan_processed,
    scan_raw,
)
from tests.conftest import plan_of


def message(at, source="faker", number=1, status="COMPLETED"):
    payload = {
        "transaction_id": f"t{number}", "user_id": "u", "amount": number, "currency": "EUR", "transaction_type": "DEBIT",
        "status": status,
    }
    return json.dumps({"source": source, "received_at": at, "payload": payload})


def messages(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


@pytest.fixture
def raw(spark, folder):
    texts = [
        message(f"2026-02-{day:02d}T{hour:02d}:30:00.000", source, day * 100 + hour)
        for day in (27, 28) for hour in (0, 5, 23) for source in ("faker", "revolut")
    ]
    texts.append(message("2026-03-01T00:10:00.000", "faker", 1))
    ingest_batch(messages(spark, texts), folder)
    return folder


def test_partition_values_keep_their_zeros(spark, raw):
    row = scan_raw(spark, raw, Days(date(2026, 2, 27), date(2026, 2, 27))).filter("hr = '05'").first()
    assert (row.year, row.month, row.day, row.hr) == ("2026", "02", "27", "05")
    assert os.path.isdir(f"{raw}/source=faker/year=2026/month=02/day=27/hr=05")


def test_window_is_a_partition_filter(spark, raw):
    df = scan_raw(spark, raw, Days(date(2026, 2, 28), date(2026, 3, 1)), ["faker"])
    assert "Filter " not in plan_of(df).replace("PartitionFilters", "").replace("DataFilters", "")
    assert len(df.inputFiles()) == 4
    assert df.count() == 4
    assert scan_raw(spark, raw, Days(date(2026, 2, 28), date(2026, 2, 28)), ["faker"]).count() == 3


def test_only_the_folders_of_the_window_are_listed(spark, raw):
    windows = {
        Days(date(2026, 2, 28), date(2026, 2, 28), 5): "year=2026/month=02/day=28/hr=05",
        Days(date(2026, 2, 28), date(2026, 3, 1)): "{year=2026/month=02/day=28,year=2026/month=03/day=01}",
        Days(date(2026, 1, 31), date(2026, 3, 1)): "{year=2026/month=01/day=31,year=2026/month=02/day=*,year=2026/month=03/day=01}",
        Days(date(2025, 12, 1), date(2025, 12, 31)): "year=2025/month=12/day=*",
    }
    for window, pattern in windows.items():
        assert window.folders() == pattern
    assert scan_raw(spark, raw, Days(date(2026, 2, 1), date(2026, 2, 28))).count() == 12
    assert scan_raw(spark, raw, Days(date(2020, 1, 1), date(2020, 1, 2))).count() == 0
    assert scan_raw(spark, raw, Days(date(2026, 2, 28), date(2026, 2, 28)), ["stripe"]).count() == 0


def test_a_missing_layer_is_an_error(spark, folder):
    with pytest.raises(ValueError, match="no such layer"):
        scan_raw(spark, f"{folder}/nowhere", Days(date(2026, 2, 28), date(2026, 2, 28)))


def test_previous_hour_crosses_midnight_and_months(spark, raw):
    assert scan_raw(spark, raw, in_previous_hour(datetime(2026, 3, 1, 0, 10))).count() == 2
    assert scan_raw(spark, raw, in_previous_hour(datetime(2026, 3, 1, 1, 10))).count() == 1
    assert scan_raw(spark, raw, in_previous_day(datetime(2026, 3, 1, 1, 45))).count() == 6


def test_windows_from_days():
    day = Days(date(2026, 2, 11), date(2026, 2, 11))
    assert Days.on("2026-02-11") == Days.on(datetime(2026, 2, 11, 9)) == Days.on(date(2026, 2, 11)) == day
    assert Days.through(date(2026, 2, 11), "2026-02-12") == Days(date(2026, 2, 11), date(2026, 2, 12))


@pytest.mark.parametrize("make, error", [
    (lambda: Days.through("2026-01-02", "2026-01-01"), ValueError), (lambda: Days.on("11.02.2026"), ValueError),
    (lambda: Days.on(20260211), TypeError), (lambda: Days.on(None), TypeError), (lambda: Days.through("2026-01-01", None), TypeError),
])
def test_no_window(make, error):
    with pytest.raises(error):
        make()


def test_days_between(spark):
    rows = days_between(spark, date(2024, 2, 28), date(2024, 3, 1)).collect()
    assert [row.date for row in rows] == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    assert rows[1].month == "02" and rows[2].day == "01"


def test_other_files_and_empty_tables_add_no_rows(spark, raw):
    before = scan_raw(spark, raw).count()
    place = glob.glob(f"{raw}/source=faker/year=2026/month=02/day=27/hr=05/batch=*")[0]
    with open(f"{place}/notes.txt", "w") as file:
        file.write("not a table")
    empty = valid_rows(read_envelopes(messages(spark, [])))
    empty.drop("source", "year", "month", "day", "hr").write.mode("append").parquet(place)
    assert scan_raw(spark, raw).count() == before


def test_unreadable_files_fail_unless_ignored(spark, raw):
    before = scan_raw(spark, raw).count()
    place = glob.glob(f"{raw}/source=faker/year=2026/month=02/day=27/hr=05/batch=*")[0]
    with open(f"{place}/part-broken.parquet", "wb") as file:
        file.write(b"PAR1 this is no table PAR1")
    with pytest.raises(Exception):
        scan_raw(spark, raw).select("payload").collect()
    assert len(scan_raw(spark, raw, ignore_corrupt=True).select("payload").collect()) == before


def test_rerun_replaces_days_and_leaves_others(spark, raw, folder):
    target = f"{folder}-processed"
    window = (date(2026, 2, 27), date(2026, 3, 1))
    process_days(spark, raw, target, *window, ["faker"])
    first = sorted(map(tuple, scan_processed(spark, target, "faker").collect()))
    assert len(first) == 7
    process_days(spark, raw, target, date(2026, 2, 28), date(2026, 2, 28), ["faker"])
    process_days(spark, raw, target, *window, ["faker"])
    assert sorted(map(tuple, scan_processed(spark, target, "faker").collect())) == first


def test_scheduled_run_rebuilds_the_previous_hour_only(spark, raw, folder):
    target = f"{folder}-processed"
    process_previous_hour(spark, raw, target, datetime(2026, 3, 1, 0, 10), ["faker"])
    assert [(row.day, row.hr) for row in scan_processed(spark, target, "faker").collect()] == [("28", "23")]
    late = [message("2026-02-28T23:59:00.000", number=9), message("2026-02-28T05:59:00.000", number=10)]
    append_raw(valid_rows(read_envelopes(messages(spark, late))), raw)
    process_previous_hour(spark, raw, target, datetime(2026, 3, 1, 0, 30), ["faker"])
    assert [(row.day, row.hr) for row in scan_processed(spark, target, "faker").collect()] == [("28", "23")] * 2
    process_days(spark, raw, target, date(2026, 2, 28), date(2026, 2, 28), ["faker"])
    assert scan_processed(spark, target, "faker").count() == 5


def test_a_window_holds_what_was_last_read(spark, raw, folder):
    """Hours and days without rows are removed; what lies outside the window stays."""
    target, less = f"{folder}-processed", f"{folder}-less"
    window = (date(2026, 2, 27), date(2026, 2, 28))
    process_days(spark, raw, target, date(2026, 2, 27), date(2026, 3, 1), ["faker"])
    ingest_batch(messages(spark, [message("2026-02-27T05:00:00.000")]), less)
    process_days(spark, less, target, *window, ["faker"])
    assert {(r.day, r.hr) for r in scan_processed(spark, target, "faker").collect()} == {("27", "05"), ("01", "00")}
    process_previous_hour(spark, less, target, datetime(2026, 2, 27, 6, 0), ["revolut"])
    out = f"{folder}-analytics"
    compact_days(spark, target, out, *window, ["faker"])
    ingest_batch(messages(spark, [message("2026-02-28T05:00:00.000")]), f"{folder}-other")
    process_days(spark, f"{folder}-other", target, *window, ["faker"])
    compact_days(spark, target, out, *window, ["faker"])
    assert [(r.source, r.day) for r in scan_analytics(spark, out, "faker").collect()] == [("faker", "28")]


def test_the_job_accounts_for_every_row(spark, folder):
    texts = [message("2026-02-27T00:00:00.000", number=1), message("2026-02-27T01:00:00.000", status=None), message("2026-02-27T02:00:00.000", status="FAILED")]
    ingest_batch(messages(spark, texts), f"{folder}/raw")
    run = lambda: process_days(spark, f"{folder}/raw", f"{folder}/p", date(2026, 2, 27), date(2026, 2, 27), ["faker"], rejects_root=f"{folder}/r")
    assert run() == run() == {"faker": {"read": 3, "kept": 1, "rejected": 1, "dropped": 1}}
    (row,) = spark.read.parquet(f"{folder}/r").collect()
    assert (row.reason, row.source, row.hr) == ("not_text", "faker", "01")
    for place in glob.glob(f"{folder}/raw/source=faker/*/*/*/hr=01"):
        os.rename(place, f"{folder}/moved")
    assert run()["faker"]["rejected"] == 0
    assert not glob.glob(f"{folder}/r/source=faker/*/*/*/hr=01")


def test_rejected_payloads_of_a_window(spark, folder):
    texts = [message("2026-02-27T00:00:00.000", number=1), message("2026-02-27T00:00:00.000", status=None)]
    assert ingest_batch(messages(spark, texts + ["junk"]), folder).count() == 1
    rejects = payload_rejects(spark, folder, date(2026, 2, 27), date(2026, 2, 27), "faker").collect()
    assert [row.reason for row in rejects] == ["not_text"]


def test_one_hour_is_processed_without_a_shuffle(spark, raw):
    from paylake.operators.normalize import normalize

    hour = scan_raw(spark, raw, in_previous_hour(datetime(2026, 2, 28, 0, 10)), ["faker"])
    assert "Exchange" not in plan_of(normalize(hour, "faker"))


def test_a_large_partition_is_written_by_several_tasks(spark, folder):
    """One hour of one source holds almost all rows: the rebalance cuts it."""
    texts = spark.range(0, 40_000, 1, 8).selectExpr(
        """concat('{"source":"faker","received_at":"2026-02-27T00:00:00.000","payload":{"id":"', uuid(), '"}}') AS value"""
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        ingest_batch(texts, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [name for _, _, names in os.walk(folder) for name in names if name.endswith(".parquet")]
    assert len(files) > 3
    assert scan_raw(spark, folder).count() == 40_000


def test_a_raw_batch_is_written_where_it_is_read(spark, folder):
    """Nothing is shuffled or sorted for the write, and the setting for it does not stay."""
    texts = spark.range(0, 4_000, 1, 4).selectExpr(
        """concat('{"source":"faker","received_at":"2026-02-27T0', id % 7, ':00:00.000","payload":{"id":', id, '}}') AS value"""
    )
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("raw-write", "raw-write")
    try:
        ingest_batch(texts, folder)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [len(status.getJobInfo(job).stageIds) for job in status.getJobIdsForGroup("raw-write")]
    assert stages == [1]
    assert spark.conf.get(name) == before
    assert scan_raw(spark, folder).count() == 4_000
