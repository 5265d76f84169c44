import os

import pytest
from pyspark.sql import functions as F

from paylake.sources import quarantine
from paylake.sources.layers import Days, scan_raw
from tests.conftest import plan_of

HOUR = "source=faker/year=2026/month=02/day={:02d}/hr=03/batch=b+ 1"


def layer(spark, folder, days=(1, 2)):
    root = f"{folder}/raw"
    for day in days:
        rows = spark.range(20).selectExpr("'{}' AS payload", "'2026-02-01T03:00:00' AS received_at")
        rows.coalesce(2).write.mode("append").parquet(f"{root}/{HOUR.format(day)}")
    return root


def damage(root, day, **files):
    for name, data in files.items():
        with open(f"{root}/{HOUR.format(day)}/{name}.parquet", "wb") as file:
            file.write(data)


def sound(root, day=1):
    here = f"{root}/{HOUR.format(day)}"
    name = next(n for n in sorted(os.listdir(here)) if n.startswith("part-"))
    with open(f"{here}/{name}", "rb") as file:
        return file.read()


def reasons(df):
    return {os.path.basename(r["file"]).removesuffix(".parquet"): r["reason"] for r in df.collect()}


def test_each_kind_of_damage_has_its_reason(spark, folder):
    root = layer(spark, folder)
    good = sound(root)
    damage(
        root, 2, empty=b"", short=b"PAR1", words=b"neither rows nor columns", cut=good[:-20], tailless=good[: len(good) // 2],
        far=good[:-8] + b"\xff\xff\xff\x7fPAR1", garbled=good[:4] + b"\xff" * (len(good) - 12) + good[-8:],
    )
    found = quarantine.unreadable_files(spark, root)
    known = reasons(found)
    assert known == {"empty": "empty", "short": "too_short", "words": "not_parquet", "cut": "cut", "tailless": "cut", "far": "bad_footer", "garbled": "bad_footer"}
    assert {r["bytes"] for r in found.collect() if r["reason"] == "empty"} == {0}
    listed = quarantine.listed_files(spark, root).count()
    assert quarantine.set_aside(spark, root, f"{folder}/aside") == {"listed": listed, "read": listed - 7, "empty": 1, "too_short": 1, "not_parquet": 1, "cut": 2, "bad_footer": 2}
    assert scan_raw(spark, root).count() == 40 and quarantine.listed_files(spark, root).count() == listed - 7
    assert reasons(quarantine.aside_log(spark, f"{folder}/aside")) == known
    assert quarantine.set_aside(spark, root, f"{folder}/aside") == {"listed": listed - 7, "read": listed - 7}


def test_files_without_rows_are_sound(spark, folder):
    root = layer(spark, folder, (1,))
    spark.range(0).selectExpr("'' AS payload").write.parquet(f"{root}/{HOUR.format(3)}")
    assert quarantine.unreadable_files(spark, root).count() == 0


def test_only_the_window_is_looked_at(spark, folder):
    from datetime import date

    root = layer(spark, folder)
    damage(root, 1, one=b"x" * 50)
    damage(root, 2, two=b"x" * 50)
    assert reasons(quarantine.unreadable_files(spark, root, Days.on(date(2026, 2, 2)))) == {"two": "not_parquet"}
    with pytest.raises(ValueError, match="no such layer"):
        quarantine.listed_files(spark, f"{folder}/nowhere")


def test_damage_behind_a_sound_footer_still_fails_the_scan(spark, folder):
    root = layer(spark, folder, (1,))
    good = sound(root)
    footer = int.from_bytes(good[-8:-4], "little")
    damage(root, 1, inside=good[:4] + b"\xff" * (len(good) - footer - 12) + good[-footer - 8 :])
    assert quarantine.set_aside(spark, root, f"{folder}/aside")["listed"] == 3
    with pytest.raises(Exception):
        scan_raw(spark, root).select(F.max("payload")).collect()


def test_contents_of_sound_files_are_not_read(spark, folder):
    root = layer(spark, folder, (1,))
    assert "content" not in plan_of(quarantine.listed_files(spark, root))
    assert "ReadSchema: struct<>" in plan_of(quarantine._with_rows(spark, root, None, "source=*"))


def test_suspects_are_looked_at_in_blocks(spark, folder, monkeypatch):
    monkeypatch.setattr(quarantine, "SUSPECTS", 2)
    root = layer(spark, folder, (1,))
    damage(root, 1, **{f"bad{i}": b"y" * 40 for i in range(5)})
    assert len(reasons(quarantine.unreadable_files(spark, root))) == 5
