import json

import pytest
from pyspark.sql import Observation

from paylake.operators.envelope import count_outcomes, read_envelopes, rejected_rows, valid_rows

AT = "2026-02-15T10:30:45.123"


def envelope(**changes):
    fields = {"source": "faker", "received_at": AT, "payload": {"a": 1}} | changes
    return json.dumps({name: value for name, value in fields.items() if value is not ...})


CASES = [
    (envelope(), None),
    (envelope(payload=None), None),
    (envelope(payload="text"), None),
    (envelope(payload=[1, 2]), None),
    (envelope(extra=1), None),
    (envelope(received_at="2026-02-15"), None),
    (envelope(source="123"), None),
    (envelope(source="true"), None),
    ("  " + envelope() + "\n", None),
    ('{"source":"a","source":"faker","received_at":"' + AT + '","payload":1}', None),
    (envelope(source=...), "missing_key"),
    (envelope(received_at=...), "missing_key"),
    (envelope(payload=...), "missing_key"),
    (envelope(source=None), "missing_key"),
    ("{}", "missing_key"),
    (envelope(source=123), "bad_source"),
    (envelope(source=True), "bad_source"),
    (envelope(source={"a": 1}), "bad_source"),
    (envelope(received_at=None), "bad_received_at"),
    (envelope(received_at=20260215), "bad_received_at"),
    (envelope(received_at="yesterday"), "bad_received_at"),
    (envelope(received_at=[AT]), "bad_received_at"),
    ("not json", "not_object"),
    ("", "not_object"),
    ("5", "not_object"),
    ("null", "not_object"),
    ('"text"', "not_object"),
    ("[" + envelope() + "]", "not_object"),
    (envelope() + " trailing", "not_object"),
    (envelope() + "," + envelope(), "not_object"),
    (envelope()[:-1], "not_object"),
    (envelope(payload={"a": float("nan")}), "not_object"),
    (envelope(payload=float("inf")), "not_object"),
    ("{'source':'faker','received_at':'" + AT + "','payload':1}", "not_object"),
]


def test_reasons(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "i int, value string")
    found = {row.i: row.reason for row in read_envelopes(df, keep=["i"]).collect()}
    for i, (text, reason) in enumerate(CASES):
        assert found[i] == reason, text


def test_rows_are_either_stored_or_rejected(spark):
    df = spark.createDataFrame([(text,) for text, _ in CASES], "value string")
    envelopes = read_envelopes(df)
    assert valid_rows(envelopes).count() + rejected_rows(envelopes).count() == len(CASES)
    assert {row.value for row in rejected_rows(envelopes).collect()} == {text for text, reason in CASES if reason}


PAYLOADS = [
    {"b": 1, "a": {"z": [1, 2.5, None], "y": "ü\n\"quoted\""}}, [], {}, [1, "x"], "text", "{looks like an object", "[1, 2]",
    '{"a": 1}', "", " ", "null", 5, 1.5, -3e10, True, False, None, {"s": "{"}, {"s": "[", "t": "\\"}, "é", ["\\{"],
]


def test_payload_text_is_equal_json(spark):
    values = [json.dumps({"source": "s", "received_at": AT, "payload": payload}) for payload in PAYLOADS]
    df = spark.createDataFrame([(i, value) for i, value in enumerate(values)], "i int, value string")
    for value, payload in zip(values, PAYLOADS):
        text = valid_rows(read_envelopes(df.filter(df.value == value))).first().payload
        assert json.loads(text) == payload, value


def test_bytes_are_decoded(spark):
    df = spark.createDataFrame([(bytearray(envelope().encode()),)], "value binary")
    row = valid_rows(read_envelopes(df)).first()
    assert (row.source, row.year, row.month, row.day, row.hr) == ("faker", "2026", "02", "15", "10")


def test_broken_bytes_are_refused_and_kept(spark):
    broken = envelope(payload="x").encode().replace(b"x", b"\xff\xfe")
    row = read_envelopes(spark.createDataFrame([(bytearray(broken),)], "value binary")).first()
    assert row.reason == "not_object" and row.value is not None


def test_wall_clock_names_the_partition(spark):
    df = spark.createDataFrame([(envelope(received_at="2026-02-15T00:30:00+02:00"),)], "value string")
    row = valid_rows(read_envelopes(df)).first()
    assert (row.day, row.hr, row.received_at) == ("15", "00", "2026-02-15T00:30:00+02:00")


def test_outcomes_are_counted_while_running(spark):
    df = spark.createDataFrame([(text,) for text, _ in CASES], "value string")
    counts = Observation()
    count_outcomes(read_envelopes(df), counts).write.format("noop").mode("overwrite").save()
    refused = sum(1 for _, reason in CASES if reason)
    assert counts.get == {"accepted": len(CASES) - refused, "refused": refused}


@pytest.mark.parametrize("python_node", ["BatchEvalPython", "ArrowEvalPython", "MapInPandas"])
def test_no_python_in_the_plan(spark, python_node):
    from tests.conftest import plan_of

    df = spark.createDataFrame([("{}",)], "value string")
    assert python_node not in plan_of(valid_rows(read_envelopes(df)))


def test_numbers_beyond_the_parser_have_a_reason_of_their_own(spark):
    from paylake.operators.normalize import rejected_payloads

    body = '{"status":"completed","amount":%s}' % ("9" * 1001)
    value = '{"source":"faker","received_at":"2026-02-15T10:30:45.123","payload":%s}' % body
    df = spark.createDataFrame([(value,), ("9" * 50,)], "value string")
    assert [row.reason for row in read_envelopes(df).collect()] == ["too_large", "not_object"]
    raw = spark.createDataFrame([("2026-02-15T10:30:45.123", body)], "received_at string, payload string")
    (row,) = rejected_payloads(raw, "faker").collect()
    assert (row.reason, row.payload) == ("too_large", body)
