"""Merging the batch folders of a raw layer, seen from its readers."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paylake.operators import merge_batches as merging
from paylake.operators.merge_batches import clean_merged, merge_batches, stored_batches
from paylake.schemas import HOUR_PARTS
from paylake.sources.layers import Days, replace_parts, scan_raw, scan_raw_batches
from paylake.sources.swaps import BATCH, read_swaps

WINDOW = Days(date(2024, 1, 1), date(2024, 1, 2))
# Everything written by a test is at rest by then, and replaced long ago.
LATER = datetime(2100, 1, 1)


def _store(spark, root, batch, rows) -> None:
    """rows: source, day, hour, payload; as the stream stores a batch, replacing its own folders."""
    full = [(s, f"2024-01-{d:02d}T{h:02d}:00:00.000", p, "2024", "01", f"{d:02d}", f"{h:02d}", batch) for s, d, h, p in rows]
    table = spark.createDataFrame(full, "source string, received_at string, payload string, year string, month string, day string, hr string, batch string")
    replace_parts(table, root, ["source", *HOUR_PARTS, BATCH])


def _layer(spark, root, batches=5) -> None:
    for n in range(batches):
        _store(spark, root, f"abc-{n}", [(s, d, h, f"{s}{d}{h}-{n % 3}") for s in ("faker", "a b/ü") for d in (1, 2) for h in (0, 5)])


def _seen(spark, root, window=WINDOW) -> list:
    return sorted(tuple(r) for r in scan_raw(spark, root, window).collect())


def _folders(spark, root) -> dict:
    rows = stored_batches(scan_raw_batches(spark, root, WINDOW)).groupBy("source", *HOUR_PARTS).agg(F.sort_array(F.collect_list(BATCH)).alias("b"))
    return {tuple(r)[:-1]: r.b for r in rows.collect()}


def test_rows_stay_and_folders_become_one_an_hour(spark, folder):
    root = f"{folder}/raw"
    _layer(spark, root)
    _store(spark, root, "abc-9", [("faker", 1, 7, "alone")])
    before = _seen(spark, root)
    told = merge_batches(spark, root, WINDOW, LATER)
    assert told == {"hours": 8, "folders": 40, "rows": 40}
    assert _seen(spark, root) == before == sorted(tuple(r) for r in scan_raw(spark, root).collect())
    assert merge_batches(spark, root, WINDOW, LATER) == {"hours": 0, "folders": 0, "rows": 0}
    assert clean_merged(spark, root, WINDOW, LATER) == 40
    assert clean_merged(spark, root, WINDOW, LATER) == 0
    assert _seen(spark, root) == before
    folders = _folders(spark, root)
    assert len(folders) == 9 and all(len(b) == 1 for b in folders.values())
    stored = stored_batches(scan_raw_batches(spark, root, WINDOW)).agg(F.max("files")).first()[0]
    assert stored == 1
    hour = Days(date(2024, 1, 1), date(2024, 1, 1), 5)
    assert len(_seen(spark, root, hour)) == 10


def test_readers_see_the_state_before_or_after(spark, folder, monkeypatch):
    root = f"{folder}/raw"
    _layer(spark, root)
    before, publish, during = _seen(spark, root), merging.publish, []
    early = scan_raw(spark, root, WINDOW)

    def watched(*args):
        during.append(_seen(spark, root))  # merged rows are written, the first or second day is not swapped yet
        publish(*args)
        during.append(_seen(spark, root))

    monkeypatch.setattr(merging, "publish", watched)
    merge_batches(spark, root, WINDOW, LATER)
    assert len(during) == 4 and all(state == before for state in during)
    assert sorted(tuple(r) for r in early.collect()) == before


def test_late_batches_survive_and_repeated_ones_stay_hidden(spark, folder):
    root = f"{folder}/raw"
    _layer(spark, root)
    before = _seen(spark, root)
    merge_batches(spark, root, WINDOW, LATER)
    again = [(s, d, h, f"{s}{d}{h}-{4 % 3}") for s in ("faker", "a b/ü") for d in (1, 2) for h in (0, 5)]
    _store(spark, root, "abc-4", again)  # the stream's newest batch once more
    assert _seen(spark, root) == before
    _store(spark, root, "abc-5", [("faker", 1, 5, "late")])
    with_late = _seen(spark, root)
    assert len(with_late) == len(before) + 1
    assert clean_merged(spark, root, WINDOW, LATER) == 40
    _store(spark, root, "abc-4", again)
    assert _seen(spark, root) == with_late
    assert merge_batches(spark, root, WINDOW, LATER)["folders"] == 2
    assert _seen(spark, root) == with_late
    clean_merged(spark, root, WINDOW, LATER)
    assert _seen(spark, root) == with_late


def test_a_failed_merge_is_not_seen_and_is_cleaned(spark, folder, monkeypatch):
    root = f"{folder}/raw"
    _layer(spark, root)
    before = _seen(spark, root)

    def fails(*_):
        raise OSError("lost")

    monkeypatch.setattr(merging, "publish", fails)
    with pytest.raises(OSError):
        merge_batches(spark, root, WINDOW, LATER)
    assert _seen(spark, root) == before and read_swaps(spark, root) == []
    assert clean_merged(spark, root, WINDOW, LATER, timedelta(days=1)) == 8
    assert _seen(spark, root) == before
    monkeypatch.undo()
    merge_batches(spark, root, WINDOW, LATER)
    assert _seen(spark, root) == before


def test_of_two_merges_at_a_time_one_fails(spark, folder, monkeypatch):
    root = f"{folder}/raw"
    _layer(spark, root)
    before, publish = _seen(spark, root), merging.publish

    def overtaken(*args):
        monkeypatch.setattr(merging, "publish", publish)
        merge_batches(spark, root, WINDOW, LATER)
        publish(*args)

    monkeypatch.setattr(merging, "publish", overtaken)
    with pytest.raises(Exception, match="[Ee]xist"):
        merge_batches(spark, root, WINDOW, LATER)
    assert _seen(spark, root) == before
    clean_merged(spark, root, WINDOW, LATER)
    assert _seen(spark, root) == before and all(len(b) == 1 for b in _folders(spark, root).values())


def test_only_hours_that_are_over_and_at_rest(spark, folder):
    root = f"{folder}/raw"
    _layer(spark, root, 2)
    assert merge_batches(spark, root, WINDOW, datetime(2024, 1, 1, 3))["hours"] == 0  # written after that
    assert merge_batches(spark, root, WINDOW, settle=timedelta(hours=5))["hours"] == 0
    future = [("faker", 2, h, "x") for h in (0,)]
    _store(spark, root, "abc-2", future)
    assert merge_batches(spark, root, Days.on("2024-01-02", 0), LATER)["hours"] == 2
    assert merge_batches(spark, root, Days.on("2030-01-01"), LATER)["hours"] == 0
