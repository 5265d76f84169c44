"""Counters that restart, against plain Python."""

import random
from datetime import datetime, timedelta

import pytest

from paylake.operators.counters import FAR, counter_totals, windowed_increase

SCHEMA = "consumer string, ts timestamp_ntz, value bigint"
START = datetime(2024, 1, 1, 23, 58)


def _samples(seed: int) -> list:
    """Two minutes to midnight and beyond, so that windows and restarts cross a day."""
    dice, rows = random.Random(seed), []
    for name in ("a", "b", None):
        at, value = START, dice.randrange(5)
        for _ in range(60):
            at += timedelta(seconds=dice.choice([1, 5, 5, 5, 9, 40]), microseconds=dice.choice([0, 0, 1]))
            value = dice.randrange(3) if dice.random() < 0.15 else value + dice.randrange(4)
            rows.append((name, at, value))
            if dice.random() < 0.1:
                rows.append((name, at, max(value - 1, 0)))  # a tie in time: the larger value stays
            if dice.random() < 0.1:
                rows.append((name, at, value))
    return rows + [("a", None, 900), ("b", START, None)]


def _series(rows) -> dict:
    best: dict = {}
    for name, at, value in rows:
        if at is not None and value is not None:
            best.setdefault(name, {})
            best[name][at] = max(value, best[name].get(at, value))
    return {name: sorted(found.items()) for name, found in best.items()}


def _grown(values) -> int:
    return sum(b - a if b >= a else b for a, b in zip(values, values[1:]))


def _plain(rows, step: int, width: int) -> dict:
    out, epoch = {}, datetime(1970, 1, 1)
    for name, found in _series(rows).items():
        first = -(-(found[0][0] - epoch) // timedelta(seconds=step))
        last = (found[-1][0] - epoch) // timedelta(seconds=step) + width // step + 1
        for number in range(first, last + 1):
            end = epoch + timedelta(seconds=number * step)
            inside = [(at, v) for at, v in found if end - timedelta(seconds=width) < at <= end]
            if len(inside) < 2:
                continue
            grown = _grown([v for _, v in inside])
            spread = (inside[-1][0] - inside[0][0]).total_seconds()
            mean = spread / (len(inside) - 1)
            before = width - (end - inside[0][0]).total_seconds()
            after = (end - inside[-1][0]).total_seconds()
            before = mean / 2 if before >= FAR * mean else before
            after = mean / 2 if after >= FAR * mean else after
            if grown > 0:
                before = min(before, spread * inside[0][1] / grown)
            out[name, end] = (len(inside), grown, grown * (spread + before + after) / spread)
    return out


@pytest.mark.parametrize("step, width", [(30, 60), (15, 15), (60, 300)])
def test_increase_equals_plain(spark, step, width):
    rows = _samples(step)
    got = windowed_increase(spark.createDataFrame(rows, SCHEMA), ["consumer"], step, width).collect()
    expected = _plain(rows, step, width)
    assert {(r.consumer, r.window_end): (r.n, r.increase) for r in got} == {k: v[:2] for k, v in expected.items()}
    for r in got:
        assert r.extrapolated == pytest.approx(expected[r.consumer, r.window_end][2])
        assert r.rate == pytest.approx(r.extrapolated / width)


def test_totals_count_through_restarts(spark):
    rows = _samples(3)
    got = counter_totals(spark.createDataFrame(rows, SCHEMA), ["consumer"], 30).collect()
    for r in got:
        values = [v for _, v in _series(rows)[r.consumer]]
        falls = sum(b < a for a, b in zip(values, values[1:]))
        assert (r.samples, r.restarts, r.total) == (len(values), falls, values[0] + _grown(values))
    assert len(got) == 3


def test_a_sample_on_the_edge_belongs_to_the_window_it_ends(spark):
    rows = [("a", datetime(2024, 1, 1, 0, 0, s), v) for s, v in [(0, 5), (30, 7)]]
    got = windowed_increase(spark.createDataFrame(rows, SCHEMA), ["consumer"], 30, 60).collect()
    assert [(r.window_end, r.increase) for r in got] == [(datetime(2024, 1, 1, 0, 0, 30), 2)]


def test_empty_tables_and_no_labels(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert windowed_increase(empty, ["consumer"]).count() == 0
    assert counter_totals(empty, ["consumer"]).count() == counter_totals(empty).count() == 0
    one = spark.createDataFrame([(None, START, 3)], SCHEMA)
    assert windowed_increase(one).count() == 0
    assert [tuple(r) for r in counter_totals(one).collect()] == [(1, 0, 3)]
    with pytest.raises(ValueError):
        windowed_increase(one, [], 30, 45)


def test_samples_are_ordered_within_slices_only(spark):
    plan = windowed_increase(spark.createDataFrame(_samples(1), SCHEMA), ["consumer"])._jdf.queryExecution().optimizedPlan().toString()
    of_samples = [line for line in plan.splitlines() if "lag(value" in line]
    assert of_samples and all("[consumer#" in line and "slice#" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in of_samples)
