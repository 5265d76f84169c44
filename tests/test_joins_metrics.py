import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paylake.functions.signing import signing_key
from paylake.operators import metrics
from paylake.operators.asof import asof_join
from paylake.operators.delivery import check_stripe_events, signature_is_valid, verified_deliveries, with_message_key, wrap_events
from paylake.operators.ranges import range_join
from tests.conftest import plan_of

START = datetime(2026, 2, 27, 23, 50)


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def random_side(seed, n, spread, keys):
    rng = random.Random(seed)
    rows = []
    for number in range(n):
        key = "hot" if rng.random() < 0.4 else rng.choice(keys)
        rows.append((key, START + timedelta(seconds=rng.randrange(spread)), number))
    return rows


def expected_asof(left, right):
    result = []
    for key, ts, number in left:
        best = None
        for rkey, rts, value in right:
            if None not in (key, ts, rkey, rts) and rkey == key and rts <= ts and (best is None or (rts, value) > best):
                best = (rts, value)
        result.append((key, ts, number, best[1] if best else None))
    return sorted(result, key=str)


@pytest.mark.parametrize("spread, bucket", [(20_000, "1 hour"), (30, "1 hour"), (20_000, "7 seconds"), (200_000, "1 minute")])
def test_asof_against_brute_force(spark, spread, bucket):
    left = random_side(1, 400, spread, ["a", "b", None]) + [("a", None, -1), ("nobody", START, -2)]
    right = random_side(2, 300, spread, ["a", "b", None]) + [("a", None, -1)]
    found = asof_join(
        table(spark, left, "k string, ts timestamp_ntz, n int"), table(spark, right, "k string, ts timestamp_ntz, v int"),
        ["k"], "ts", bucket,
    )
    assert found.columns == ["k", "ts", "n", "v"]
    assert sorted(map(tuple, found.collect()), key=str) == expected_asof(left, right)


def test_asof_with_copies_and_equal_names(spark):
    left = [("a", START, 1)] * 50
    right = [("a", START - timedelta(hours=9), 7)] * 50
    schema = "k string, ts timestamp_ntz, n int"
    found = asof_join(table(spark, left, schema), table(spark, right, schema), ["k"], "ts")
    assert found.columns == ["k", "ts", "n", "n_right"]
    assert [tuple(row) for row in found.collect()] == [("a", START, 1, 7)] * 50


def test_asof_pairs_nothing_up(spark):
    schema = "k string, ts timestamp_ntz, n int"
    plan = plan_of(asof_join(table(spark, [], schema), table(spark, [], schema), ["k"], "ts"))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def events(spark):
    rng = random.Random(3)
    rows = [(START + timedelta(seconds=rng.randrange(4 * 86400)), rng.choice("aab")) for _ in range(800)]
    return rows, table(spark, rows, "ts timestamp_ntz, label string")


def floor_to(ts, seconds):
    return ts - timedelta(seconds=(ts - datetime(1970, 1, 1)).total_seconds() % seconds)


def test_trailing_rate(spark):
    rows, df = events(spark)
    expected = Counter()
    for ts, label in rows:
        for i in (1, 2, 3, 4):
            expected[(floor_to(ts, 15) + timedelta(seconds=15 * i), label)] += 1
    found = {(row.window_end, row.label): row.rate for row in metrics.trailing_rate(df, ["label"], step=15).collect()}
    assert found == {key: n / 60.0 for key, n in expected.items()}
    with pytest.raises(ValueError):
        metrics.trailing_rate(df, step=25)


def test_per_minute_and_cumulative(spark):
    rows, df = events(spark)
    minutes = Counter((floor_to(ts, 60), label) for ts, label in rows)
    assert {(r.minute, r.label): r.n for r in metrics.per_minute(df, ["label"]).collect()} == minutes
    totals, seen = {}, Counter()
    for (minute, label), n in sorted(minutes.items()):
        seen[label] += n
        totals[(minute, label)] = seen[label]
    assert {(r.minute, r.label): r.total for r in metrics.cumulative(df, ["label"]).collect()} == totals


def test_counts_are_combined_before_the_shuffle(spark):
    _, df = events(spark)
    assert plan_of(metrics.trailing_rate(df)).count("partial_count") == 1


def test_message_keys(spark):
    bodies = [
        '{"source":"faker","payload":{"user_id":"u1"}}',
        '{"source":"stripe","payload":{"data":{"object":{"object":"charge","id":"ch","payment_intent":"pi"}}}}',
        '{"source":"stripe","payload":{"data":{"object":{"object":"payment_intent","id":"pi2"}}}}',
        '{"source":"revolut","payload":{"data":{"id":"r"}}}',
        '{"source":"other","payload":{}}',
    ]
    keyed = with_message_key(table(spark, [(b,) for b in bodies], "value string")).collect()
    assert [row.key for row in keyed] == ["u1", "stripe_payment_intent_pi", "stripe_payment_intent_pi2", "revolut_transaction_r", None]


def test_signatures(spark):
    import hashlib
    import hmac

    def sign(body, ts):
        return hmac.new(b"secret", f"v1.{ts}.{body}".encode(), hashlib.sha256).hexdigest()

    rows = [
        ("{}", "1", "v1=" + sign("{}", "1"), True), ("{}", "1", sign("{}", "1"), True), ("{}", "2", "v1=" + sign("{}", "1"), False),
        ("{ }", "1", "v1=" + sign("{}", "1"), False), ("{}", "1", None, False), ("{}", None, "v1=" + sign("{}", "1"), False),
        ("{}", "", "v1=" + sign("{}", ""), False), ("{}", "1", "", False), ("{}", "1", "v1=" + sign("{}", "1").upper(), False),
    ]
    df = table(spark, rows, "body string, ts string, signature string, expected boolean")
    valid = signature_is_valid(signing_key(spark, "secret"), F.col("body"), F.col("ts"), F.col("signature"))
    assert [row.v == row.expected for row in df.select(valid.alias("v"), "expected").collect()] == [True] * len(rows)
    assert verified_deliveries(df, "secret").count() == 2


def test_wrapped_events_are_valid_envelopes(spark):
    from paylake.operators.envelope import read_envelopes

    bodies = ['{"z": 1, "a":{"id":"r"}}', "no json", None, "null", "{} x", " [1] ", '"t"']
    wrapped = wrap_events(table(spark, [(START, b) for b in bodies], "at timestamp_ntz, body string"), 'a "b"', "at", "body")
    rows = wrapped.collect()
    assert [(row.reason, row.payload) for row in rows if row.reason] == [("not_json", "no json"), ("not_json", None), ("not_json", "{} x")]
    assert rows[0].value == '{"source":"a \\"b\\"","received_at":"2026-02-27T23:50:00.000","payload":{"z": 1, "a":{"id":"r"}}}'
    read = read_envelopes(wrapped.filter("reason IS NULL").select("value")).collect()
    assert [row.reason for row in read] == [None] * 4
    assert (read[0].source, read[0].received_at) == ('a "b"', "2026-02-27T23:50:00.000")


EVENTS = [
    ('{"id":"e","type":"t","data":{"a":1}}', None), ('{"id":"e","type":"t","data":{},"created":"12","livemode":"yes"}', None),
    ('{"id":"e","type":"t","data":{},"created":12.0,"livemode":0}', None), ('{"id":"e","type":"t","data":{},"created":null}', None),
    ('{"type":"t","data":{}}', "id"), ('{"id":null,"type":"t","data":{}}', "id"), ('{"id":5,"type":"t","data":{}}', "id"),
    ('{"id":"e","data":{}}', "type"), ('{"id":"e","type":"t"}', "data"), ('{"id":"e","type":"t","data":null}', "data"),
    ('{"id":"e","type":"t","data":[]}', "data"), ('{"id":"e","type":"t","data":{},"api_version":5}', "api_version"),
    ('{"id":"e","type":"t","data":{},"created":"soon"}', "created"), ('{"id":"e","type":"t","data":{},"created":1.5}', "created"),
    ('{"id":"e","type":"t","data":{},"livemode":2}', "livemode"), ('{"id":"e","type":"t","data":{},"livemode":"si"}', "livemode"),
    ("[]", "not_object"), ("x", "not_object"),
]


def test_event_structure(spark):
    df = table(spark, [(i, body) for i, (body, _) in enumerate(EVENTS)], "i int, body string")
    rows = {row.i: row for row in check_stripe_events(df).collect()}
    for i, (body, reason) in enumerate(EVENTS):
        assert rows[i].reason == reason, body
        assert (rows[i].payload is None) == (reason is not None), body
    assert rows[1].payload == '{"id":"e","type":"t","data":{},"api_version":null,"created":12,"livemode":true}'


def test_asof_computes_its_points_once(spark):
    schema = "k string, ts timestamp_ntz, n int"
    rows = [(f"k{i % 7}", START + timedelta(minutes=i), i) for i in range(500)]
    joined = asof_join(table(spark, rows, schema), table(spark, rows, schema), ["k"], "ts")
    joined.collect()
    assert "ReusedExchange" in plan_of(joined)


def test_asof_with_a_hot_moment(spark):
    """A third of all rows share one key and time, another third one key."""
    left = spark.range(30_000).selectExpr(
        "IF(id % 3 < 2, 'hot', concat('k', id % 50)) AS k",
        "IF(id % 3 = 0, TIMESTAMP_NTZ'2026-02-27 12:00:00', timestampadd(SECOND, id, TIMESTAMP_NTZ'2026-02-27 00:00:00')) AS ts",
        "id AS n",
    )
    right = left.select("k", "ts", F.col("n").alias("v"))
    found = asof_join(left, right, ["k"], "ts")
    assert found.count() == 30_000
    # Every left row is also a right row, so its match is at its own time or, among copies, the greatest.
    assert found.filter("v IS NULL OR v < n").count() == 0
    assert found.filter("k = 'hot' AND ts = TIMESTAMP_NTZ'2026-02-27 12:00:00'").select("v").distinct().count() == 1


@pytest.mark.parametrize("name", ["bucket", "side", "found", "start", "within", "last", "a.b", "_row", "n"])
def test_asof_with_any_names(spark, name):
    left, right = random_side(3, 200, 9_000, ["a", "b"]), random_side(4, 200, 9_000, ["a", "b"])
    one = table(spark, left, "k string, ts timestamp_ntz, left_n int").toDF(name, "last" if name != "last" else "when", "left_n")
    two = table(spark, right, "k string, ts timestamp_ntz, v int").toDF(name, one.columns[1], "v").withColumn("m", F.create_map(F.lit("x"), F.col("v")))
    found = asof_join(one, two, [name], one.columns[1], points_per_part=3)
    assert sorted(map(tuple, found.drop("m").collect()), key=str) == expected_asof(left, right)
    assert found.filter("v IS NOT NULL AND m['x'] <> v").count() == 0


def test_asof_with_an_integer_key_and_taken_suffixes(spark):
    left = table(spark, [(1, START, 5, 6)], "side int, ts timestamp_ntz, v int, v_right int")
    right = table(spark, [(1, START - timedelta(hours=3), 7)], "side int, ts timestamp_ntz, v int")
    found = asof_join(left, right, ["side"], "ts")
    assert found.columns == ["side", "ts", "v", "v_right", "v_right_right"]
    assert tuple(found.first())[2:] == (5, 6, 7)


def test_a_busy_hour_is_cut(spark):
    left = spark.range(3_000).selectExpr("'k' AS k", "timestampadd(SECOND, id, TIMESTAMP_NTZ'2026-02-27 00:00:00') AS ts", "id AS n")
    right = left.filter("n % 700 = 0").select("k", "ts", F.col("n").alias("v"))
    found = asof_join(left, right, ["k"], "ts", points_per_part=100)
    assert found.filter("v <> n - n % 700 OR v IS NULL").count() == 0


@pytest.mark.parametrize("width", [None, 0.5, 1000.0])
def test_intervals_against_all_pairs(spark, width):
    rng = random.Random(5)
    spans = [(i, a, a + rng.choice([0, -1, 1, 3, 90]) * rng.random()) for i in range(200) for a in [rng.uniform(-50, 50)]] + [(900, None, 1.0), (901, 0.0, None)]
    dots = [(i, rng.choice([rng.uniform(-60, 60), float(rng.randint(-5, 5))])) for i in range(200)] + [(999, None)]
    found = range_join(table(spark, spans, "i int, low double, high double"), table(spark, dots, "p int, at double"), "low", "high", "at", width)
    want = [(i, p) for i, a, b in spans for p, x in dots if None not in (a, b, x) and a <= x < b]
    assert sorted((r.i, r.p) for r in found.collect()) == sorted(want)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


def test_intervals_of_times(spark):
    spans = table(spark, [(1, START, START + timedelta(hours=1))], "i int, low timestamp_ntz, high timestamp_ntz")
    dots = table(spark, [(n, START + timedelta(minutes=30 * n)) for n in range(-1, 4)], "p int, at timestamp_ntz")
    assert sorted(r.p for r in range_join(spans, dots, "low", "high", "at").collect()) == [0, 1]
    with pytest.raises(ValueError, match="both sides"):
        range_join(spans, dots.withColumn("i", F.lit(1)), "low", "high", "at")
    assert range_join(spans.limit(0), dots, "low", "high", "at").count() == 0
