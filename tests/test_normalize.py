import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from paylake.operators.normalize import normalize, normalize_each, rejected_payloads, union_sources
from paylake.schemas import PROCESSED

AT = "2026-02-15T10:30:45.123"
FAKER = {
    "transaction_id": "t1", "user_id": "u1", "card_number": "4", "amount": 12.5, "currency": "EUR", "timestamp": AT,
    "transaction_type": "DEBIT", "status": "COMPLETED",
}
INTENT = {
    "id": "pi_1", "object": "payment_intent", "status": "succeeded", "amount": 1250, "currency": "EUR", "customer": "c1",
    "payment_method": "pm",
}
TRANSFER = {
    "id": "r1", "type": "Transfer", "state": "completed",
    "legs": [{"account_id": "a0", "amount": -1, "currency": "GBP"}, {"account_id": "a1", "amount": 7.25, "currency": "EUR"}],
}


def changed(base, **changes):
    return {name: value for name, value in (base | changes).items() if value is not ...}


def faker(**changes):
    return json.dumps(changed(FAKER, **changes))


def stripe(**changes):
    return json.dumps({"id": "evt", "type": "t", "data": {"object": changed(INTENT, **changes)}})


def revolut(**changes):
    return json.dumps({"event": "TransactionCreated", "data": changed(TRANSFER, **changes)})


KEPT, DROPPED = "kept", "dropped"
LEG0, LEG1 = TRANSFER["legs"]

CASES = {
    "faker": [
        (faker(), KEPT), (faker(status="completed"), KEPT), (faker(status="CompleteD"), KEPT), (faker(status="FAILED"), DROPPED),
        (faker(amount=5), KEPT), (faker(amount=None), KEPT), (faker(user_id=None), KEPT), (faker(card_number=...), KEPT),
        (faker(status=...), "missing_field"), (faker(status=None), "not_text"), (faker(status=7), "not_text"),
        (faker(amount=...), "missing_field"), (faker(currency=...), "missing_field"), (faker(transaction_id=...), "missing_field"),
        (faker(status="FAILED", currency=...), DROPPED), (faker(currency=None), "not_text"), (faker(currency=5), "not_text"),
        (faker(user_id=5), "not_text"), (faker(amount="12.5"), "bad_amount"), (faker(amount=[1]), "bad_amount"),
        ("[1]", "not_object"), ("5", "not_object"), ("null", "not_object"), ("broken", "not_json"), (None, "not_json"),
        (faker() + " x", "not_json"), (faker(status="FAILED") + ",{}", "not_json"),
    ],
    "stripe": [
        (stripe(), KEPT), (stripe(amount="1250"), KEPT), (stripe(amount=" 1_250 "), KEPT), (stripe(amount=12.5), KEPT),
        (stripe(customer=None), KEPT), (stripe(object="charge"), DROPPED), (stripe(object="charge", status=...), DROPPED),
        (stripe(status="processing"), DROPPED), (stripe(status="SUCCEEDED"), DROPPED), (stripe(status=None), DROPPED),
        (stripe(status=...), "missing_field"), (stripe(object=...), "missing_field"), (stripe(customer=...), "missing_field"),
        (stripe(amount=...), "missing_field"), (stripe(amount=None), "bad_amount"), (stripe(amount="12 euro"), "bad_amount"),
        (stripe(currency=5), "not_text"), ('{"data":{}}', "missing_field"), ("{}", "missing_field"), ("[]", "not_object"),
        ("nope", "not_json"),
    ],
    "revolut": [
        (revolut(), KEPT), (revolut(state="pending"), DROPPED), (revolut(state=...), DROPPED), (revolut(state="Completed"), DROPPED),
        (revolut(state=5), DROPPED), (revolut(legs=[LEG0, {"amount": "7.25"}]), KEPT), (revolut(legs=[LEG0, LEG1, LEG0]), KEPT),
        (revolut(legs=[LEG0]), "missing_field"), (revolut(legs=[]), "missing_field"), (revolut(legs=...), "missing_field"),
        (revolut(id=...), "missing_field"), (revolut(type=...), "missing_field"), (revolut(legs=[{"currency": "x"}, LEG1]), "missing_field"),
        (revolut(legs=[LEG0, {"amount": None}]), "bad_amount"), (revolut(legs=[LEG0, {"amount": "x"}]), "bad_amount"),
        (revolut(id=5), "not_text"), ('{"event":"x"}', "missing_field"), ('{"data":5}', "not_object"), ("7", "not_object"), ("", "not_json"),
    ],
}


def raw_of(spark, source, payloads, at=AT):
    rows = [(source, at, payload) for payload in payloads]
    return spark.createDataFrame(rows, "source string, received_at string, payload string")


@pytest.mark.parametrize("source", CASES)
def test_each_row_is_kept_dropped_or_rejected(spark, source):
    numbered = [(i, AT, payload) for i, (payload, _) in enumerate(CASES[source])]
    raw = spark.createDataFrame(numbered, "i int, received_at string, payload string")
    kept = {row.i for row in normalize(raw, source, keep=["i"]).collect()}
    rejected = {}
    for row in rejected_payloads(raw, source).collect():
        rejected.setdefault(row.payload, row.reason)
    for i, (payload, expected) in enumerate(CASES[source]):
        outcome = KEPT if i in kept else rejected.get(payload, DROPPED)
        assert outcome == expected, payload
        assert not (i in kept and payload in rejected), payload


def test_values(spark):
    at = datetime(2026, 2, 15, 10, 30, 45, 123000)
    assert tuple(normalize(raw_of(spark, "faker", [faker()]), "faker").first()) == ("faker", at, "t1", "u1", 12.5, "eur", "debit")
    assert tuple(normalize(raw_of(spark, "stripe", [stripe()]), "stripe").first()) == ("stripe", at, "pi_1", "c1", 12.5, "EUR", "pm")
    row = normalize(raw_of(spark, "revolut", [revolut()]), "revolut").first()
    assert tuple(row) == ("revolut", at, "r1", "a0", 7.25, "GBP", "Transfer")


def test_offset_becomes_utc(spark):
    raw = raw_of(spark, "faker", [faker()], at="2026-02-15T00:30:00.123456+02:00")
    assert normalize(raw, "faker").first().received_at == datetime(2026, 2, 14, 22, 30, 0, 123000)


def test_unreadable_time_is_rejected(spark):
    raw = raw_of(spark, "faker", [faker(), faker(status="FAILED")], at="never")
    assert normalize(raw, "faker").count() == 0
    assert [row.reason for row in rejected_payloads(raw, "faker").collect()] == ["bad_received_at"]


@pytest.mark.parametrize("source", CASES)
def test_empty_result_keeps_its_types(spark, source):
    empty = normalize(raw_of(spark, source, []), source)
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in PROCESSED[source]]
    assert empty.count() == 0


def test_strict_mode_fails_on_the_first_malformed_row(spark):
    good = raw_of(spark, "faker", [faker(), faker(status="FAILED")])
    assert normalize(good, "faker", strict=True).count() == 1
    with pytest.raises(PySparkException, match="malformed payload: not_text"):
        normalize(raw_of(spark, "faker", [faker(), faker(status=None)]), "faker", strict=True).collect()


def test_unknown_source_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown source"):
        normalize(raw_of(spark, "other", []), "other")


def test_dispatch_and_duplicates(spark):
    raw = raw_of(spark, "faker", [faker()] * 3).union(raw_of(spark, "revolut", [revolut()]))
    tables = normalize_each(raw, ["faker", "revolut"])
    assert tables["faker"].count() == 3
    assert union_sources(list(tables.values())).count() == 4


def test_union_refuses_other_columns(spark):
    with pytest.raises(PySparkException):
        union_sources([normalize(raw_of(spark, s, []), s) for s in ("faker", "stripe")])


@pytest.mark.parametrize("source, good, word", [
    ("faker", faker(), "COMPLETED"), ("stripe", stripe(), "succeeded"), ("stripe", stripe(), "payment_intent"), ("revolut", revolut(), "completed"),
])
def test_only_payloads_that_may_be_wanted_are_parsed(spark, source, good, word):
    escaped = good.replace(f'"{word}"', f'"\\u00{ord(word[0]):02x}{word[1:]}"')
    elsewhere = good.replace(f'"{word}"', '"other"')[:-1] + f', "note": "{word}"}}'
    raw = spark.createDataFrame([(source, AT, payload) for payload in (good, escaped, elsewhere)], "source string, received_at string, payload string")
    made = normalize(raw, source)
    assert escaped != good and made.count() == 2
    plan = made._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.rindex("contains(lower(payload") > plan.rindex("parsejson")


def test_texts_that_spell_other_types_are_told_apart(spark):
    texts = ["1", "-x", "true", "{}", "[1]", "null", "Infinity", ""]
    rows = [faker(user_id=value) for value in [*texts, 1, True, {}, [1], float("1e308")]] + [faker().replace('"u1"', "1e999")]
    raw = spark.createDataFrame([("faker", AT, row) for row in rows], "source string, received_at string, payload string")
    assert sorted(r.user_id for r in normalize(raw, "faker").collect()) == sorted(texts)
    assert {r.reason for r in rejected_payloads(raw, "faker").collect()} == {"not_text"} and rejected_payloads(raw, "faker").count() == 6
