"""Random documents, good and damaged, against what a plain reading of the rules gives."""

import json
import random
from datetime import datetime

import pytest

from paylake.operators.envelope import read_envelopes, valid_rows
from paylake.operators.normalize import normalize, rejected_payloads

AT = "2026-02-15T10:30:45.123"
ODD = [None, "", "x", "12", "1e2", " 7 ", "1_0", 0, -3, 2.5, True, [], {}, [1], {"a": 1}, "COMPLETED", "completed", "{", "é\"\\"]


def damaged(rng, value, depth=0):
    """The value with, here and there, a part removed or replaced."""
    roll = rng.random()
    if depth and roll < 0.04:
        return ...
    if depth and roll < 0.12:
        return rng.choice(ODD)
    if isinstance(value, dict):
        parts = [(key, damaged(rng, part, depth + 1)) for key, part in value.items()]
        rng.shuffle(parts)
        return {key: part for key, part in parts if part is not ...}
    if isinstance(value, list):
        return [part for part in (damaged(rng, part, depth + 1) for part in value) if part is not ...]
    return value


def mangled(rng, text):
    roll = rng.random()
    if roll < 0.03:
        return text[: rng.randrange(len(text) + 1)]
    if roll < 0.05:
        return text + rng.choice([" ", "\n", " x", ",{}", "]", "[]", ",null", "}"])
    if roll < 0.07:
        return rng.choice(["", "null", "1", "[]", '"s"', "{}", " {} "])
    return text


def number(value):
    if isinstance(value, (bool, int, float)):
        return float(value)
    if isinstance(value, str):
        try:
            return float(value)
        except ValueError:
            return None
    return None


def loaded(text):
    try:
        return json.loads(text)
    except ValueError:
        return ...


ABSENT = object()

KINDS = {
    "text": lambda v: v if isinstance(v, str) else ABSENT,
    "word": lambda v: v.lower() if isinstance(v, str) else ABSENT,
    "text?": lambda v: v if v is None or isinstance(v, str) else ABSENT,
    "amount?": lambda v: None if v is None else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else ABSENT,
    "number": lambda v: ABSENT if number(v) is None else number(v),
    "cents": lambda v: ABSENT if number(v) is None else number(v) / 100.0,
    "object": lambda v: v if isinstance(v, dict) else ABSENT,
    "any": lambda v: v,
}

# A payload is tested path by path: of the kind given, or rejected; present, or what is said for absent ones; of the value
# wanted, or dropped. What is left must have every field in its kind.
MODEL = {
    "faker": {
        "tests": [("", "object", None, "rejected"), ("status", "word", "completed", "rejected")],
        "fields": [("transaction_id", "text?"), ("user_id", "text?"), ("amount", "amount?"), ("currency", "word"), ("transaction_type", "word")],
    },
    "stripe": {
        "tests": [("data.object.object", "any", "payment_intent", "rejected"), ("data.object.status", "any", "succeeded", "rejected")],
        "fields": [
            ("data.object.id", "text?"), ("data.object.customer", "text?"), ("data.object.amount", "cents"), ("data.object.currency", "text?"),
            ("data.object.payment_method", "text?"),
        ],
    },
    "revolut": {
        "tests": [("data", "object", None, "rejected"), ("data.state", "any", "completed", "dropped")],
        "fields": [
            ("data.id", "text?"), ("data.legs.0.account_id", "text?"), ("data.legs.1.amount", "number"), ("data.legs.0.currency", "text?"),
            ("data.type", "text?"),
        ],
    },
}


def at(doc, path):
    for step in path.split(".") if path else []:
        if isinstance(doc, list) and step.isdigit() and int(step) < len(doc):
            doc = doc[int(step)]
        elif isinstance(doc, dict) and step in doc:
            doc = doc[step]
        else:
            return ABSENT
    return doc


def outcome_of(doc, model):
    for path, kind, wanted, if_absent in model["tests"]:
        value = at(doc, path)
        if value is ABSENT:
            return if_absent
        value = KINDS[kind](value)
        if value is ABSENT:
            return "rejected"
        if wanted is not None and value != wanted:
            return "dropped"
    row = tuple(ABSENT if at(doc, path) is ABSENT else KINDS[kind](at(doc, path)) for path, kind in model["fields"])
    return "rejected" if ABSENT in row else row


GOOD = {
    "faker": {
        "transaction_id": "t", "user_id": "u", "amount": 12.5, "currency": "EUR", "transaction_type": "DEBIT", "status": "COMPLETED",
    },
    "stripe": {"id": "e", "data": {"object": {
        "id": "pi", "object": "payment_intent", "status": "succeeded", "amount": 1250, "currency": "eur", "customer": "c",
        "payment_method": "pm",
    }}},
    "revolut": {"event": "x", "data": {"id": "r", "type": "t", "state": "completed", "legs": [
        {"account_id": "a", "amount": -5, "currency": "GBP"}, {"account_id": "b", "amount": 5.25, "currency": "EUR"},
    ]}},
}


@pytest.mark.parametrize("source", GOOD)
def test_payloads(spark, source):
    rng = random.Random(source)
    texts = [mangled(rng, json.dumps(damaged(rng, GOOD[source]), ensure_ascii=rng.random() < 0.5)) for _ in range(1500)]
    raw = spark.createDataFrame([(i, AT, text) for i, text in enumerate(texts)], "i int, received_at string, payload string")
    kept = {row.i: tuple(row)[2:7] for row in normalize(raw, source, keep=["i"]).collect()}
    rejected = {row.payload for row in rejected_payloads(raw, source).collect()}
    for i, text in enumerate(texts):
        doc = loaded(text)
        outcome = outcome_of(doc, MODEL[source]) if doc is not ... else "rejected"
        found = kept.get(i, "rejected" if text in rejected else "dropped")
        assert found == outcome, text


def test_envelopes(spark):
    rng = random.Random(5)
    good = {"source": "faker", "received_at": AT, "payload": {"a": [1, 2.5, "x"], "b": {"c": None}}}
    texts = [mangled(rng, json.dumps(damaged(rng, good), ensure_ascii=rng.random() < 0.5)) for _ in range(2500)]
    df = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, value string")
    reasons = {row.i: row.reason for row in read_envelopes(df, keep=["i"]).collect()}
    stored = {}
    for row in valid_rows(read_envelopes(df)).collect():
        stored.setdefault((row.source, row.received_at), []).append(json.dumps(json.loads(row.payload), sort_keys=True))
    expected = {}
    for i, text in enumerate(texts):
        doc = loaded(text)
        if not isinstance(doc, dict):
            assert reasons[i] == "not_object", text
        elif not {"source", "received_at", "payload"} <= set(doc) or doc["source"] is None:
            assert reasons[i] == "missing_key", text
        elif not isinstance(doc["source"], str):
            assert reasons[i] == "bad_source", text
        elif not (isinstance(doc["received_at"], str) and is_time(doc["received_at"])):
            assert reasons[i] == "bad_received_at", text
        else:
            assert reasons[i] is None, text
            expected.setdefault((doc["source"], doc["received_at"]), []).append(json.dumps(doc["payload"], sort_keys=True))
    for key, payloads in expected.items():
        assert sorted(stored[key]) == sorted(payloads)


def is_time(text):
    try:
        datetime.fromisoformat(text)
    except ValueError:
        return False
    return len(text) >= 10
