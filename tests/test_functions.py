import hashlib
import hmac
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from paylake.functions.iso_time import day_parts, utc_clock, wall_clock
from paylake.functions.json_values import Document, as_array
from paylake.functions.signing import hmac_sha256, signing_key

ACCEPTED = [
    "2026-02-15", "2026-02-15T10", "2026-02-15T10:30", "2026-02-15T10:30:45", "2026-02-15T10:30:45.123",
    "2026-02-15 10:30:45.123456", "2026-02-15_10:30", "2026-02-15T10:30:45+02:00", "2026-02-15T10:30:45.123-05:30",
    "2026-02-15T10+01:00", "2026-02-15T10:30+01:00", "2026-02-15T23:30:00-02:00", "2024-02-29T00:00:00+00:00",
    "2026-01-01T00:30:00.000+01:00", "2026-02-15T10:30:45+20:00", "2026-02-15T10:30:45+02:00:30",
]
REFUSED = [
    "", "bad", "2026", "2026-2-5", "10:30", "2026-13-01", "2026-02-30", "2026-02-15T24:00", "2026-02-15T10:60",
    "2026-02-15T10:30:45.1", "20260215", "2026-02-15T", "2026-02-15T10:30:45+24:00", "0000-01-01", "2026-02-15T10:30:45\n",
    "2026-02-15T1", "2026-02-15T10:30:45 +02:00", "2026-W07-1",
]


def clocks(spark, texts):
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    parts = day_parts(F.col("text"))
    rows = df.select(
        "text", wall_clock(F.col("text")).alias("wall"), utc_clock(F.col("text")).alias("utc"),
        *(parts[name].alias(name) for name in parts),
    ).collect()
    return {row.text: row for row in rows}


def test_accepted_times_match_python(spark):
    found = clocks(spark, ACCEPTED)
    for text in ACCEPTED:
        expected = datetime.fromisoformat(text)
        cut = expected.replace(microsecond=expected.microsecond // 1000 * 1000)
        assert found[text].wall == cut.replace(tzinfo=None), text
        utc = cut.astimezone(timezone.utc).replace(tzinfo=None) if cut.tzinfo else cut
        assert found[text].utc == utc, text
        row = found[text]
        assert (row.year, row.month, row.day, row.hr) == tuple(expected.strftime("%Y %m %d %H").split()), text


def test_zulu_is_accepted(spark):
    row = clocks(spark, ["2026-02-15T10:30:45.5Z", "2026-02-15T10:30:45.500Z"])
    assert row["2026-02-15T10:30:45.5Z"].wall is None
    assert row["2026-02-15T10:30:45.500Z"].utc == datetime(2026, 2, 15, 10, 30, 45, 500000)


def test_refused_times(spark):
    found = clocks(spark, REFUSED)
    for text in REFUSED:
        assert found[text].wall is None and found[text].utc is None, text


@pytest.mark.parametrize("secret", ["k", "wsk_example", "x" * 64, "longer than a block " * 10, "schlüssel"])
def test_hmac_matches_python(spark, secret):
    texts = ["", "v1.1.{}", "é" * 100, "v1.1700000000000." + "body " * 50]
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    for row in df.select("text", hmac_sha256(signing_key(spark, secret), F.col("text")).alias("digest")).collect():
        assert row.digest == hmac.new(secret.encode(), row.text.encode(), hashlib.sha256).hexdigest()


def test_no_plan_shows_the_key(spark):
    secret = "a very secret key"
    df = spark.range(3).select(hmac_sha256(signing_key(spark, secret), F.col("id").cast("string")).alias("d"))
    pads = [bytes(b ^ pad for b in secret.encode().ljust(64, b"\0")) for pad in (0, 0x36, 0x5C)]
    df.collect()
    execution = df._jdf.queryExecution()
    shown = execution.toString() + execution.logical().toString() + execution.executedPlan().toString()
    for pad in pads:
        assert not any(form in shown.lower() for form in (pad.hex()[:24], pad[:12].hex(" "), pad[:12].decode("latin1").lower()))


def test_numbers_convert_like_python_floats(spark):
    values = ["12", "12.5", "-3", "1e3", '"12"', '" 12 "', '"1_000"', '"1e5"', '".5"', '"5."', "true", '"+7"']
    refused = ['"12d"', '"0x1p3"', '"1__0"', '"abc"', '""', "null", "[1]", "{}", '"1_"']
    df = spark.createDataFrame([(f'{{"a":{value}}}',) for value in values + refused], "text string")
    doc = Document(F.col("doc"))
    rows = df.select("text", F.try_parse_json(as_array(F.col("text"))).alias("doc")).select("text", doc.number(".a").alias("n"))
    found = {row.text: row.n for row in rows.collect()}
    import json

    for value in values:
        assert found[f'{{"a":{value}}}'] == float(json.loads(value)), value
    for value in refused:
        assert found[f'{{"a":{value}}}'] is None, value
