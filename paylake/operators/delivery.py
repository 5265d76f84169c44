"""From provider deliveries to keyed envelopes: signature check, structure check, wrapping, message key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions.iso_time import iso_millis
from paylake.functions.json_values import Document, as_array, computed_once
from paylake.functions.signing import Key, hmac_sha256, signing_key

# Texts that read as a boolean, ignoring case.
TRUE_TEXTS = ["1", "true", "t", "yes", "y", "on"]
FALSE_TEXTS = ["0", "false", "f", "no", "n", "off"]

_KEY_FIELDS = (
    "source STRING, payload STRUCT<user_id: STRING, data: STRUCT<id: STRING, "
    "object: STRUCT<object: STRING, id: STRING, payment_intent: STRING>>>"
)


def signature_is_valid(key: Key, body: Column, timestamp: Column, signature: Column) -> Column:
    """True when the signature, without its `v1=` mark, signs `v1.<timestamp>.<body>`."""
    claimed = F.replace(signature, F.lit("v1="), F.lit(""))
    expected = hmac_sha256(key, F.concat(F.lit("v1."), timestamp, F.lit("."), body))
    return F.coalesce((claimed == expected) & (timestamp != ""), F.lit(False))


def verified_deliveries(deliveries: DataFrame, secret: str) -> DataFrame:
    key = signing_key(deliveries.sparkSession, secret)
    return deliveries.filter(signature_is_valid(key, F.col("body"), F.col("ts"), F.col("signature")))


def wrap_events(events: DataFrame, source: str, arrived_at: str, payload: str) -> DataFrame:
    """Envelope text in `value` from an arrival time and a payload given as JSON text, which is kept as it is written.

    A payload that is no single JSON document cannot be enveloped: `value` is NULL, `reason` is `not_json`, and `payload`
    holds the text. For the others both are NULL. A JSON null is a payload, a missing text is not.
    """
    body = F.col(payload).cast("string")
    parsed = computed_once(events.select(arrived_at, body.alias("body")), {"doc": F.try_parse_json(as_array(F.col("body")))}, arrived_at, "body")
    readable = F.coalesce(Document(F.col("doc")).is_alone(), F.lit(False))
    envelope = F.concat(
        F.lit('{"source":'), F.to_json(F.array(F.lit(source))).substr(F.lit(2), F.length(F.to_json(F.array(F.lit(source)))) - 2),
        F.lit(',"received_at":"'), iso_millis(F.col(arrived_at)), F.lit('","payload":'), F.col("body"), F.lit("}"),
    )
    return parsed.select(
        F.when(readable, envelope).alias("value"), F.when(~readable, F.lit("not_json")).alias("reason"), F.when(~readable, F.col("body")).alias("payload")
    )


def with_message_key(messages: DataFrame) -> DataFrame:
    """`key, value`, ready for a keyed stream sink. Equal keys keep the order of one transaction.

    faker: the user; stripe: the payment intent a charge belongs to, else the object itself; revolut: the
    transaction.
    """
    event = F.from_json("value", _KEY_FIELDS)
    obj = event["payload"]["data"]["object"]
    intent = F.when(obj["object"] == "charge", obj["payment_intent"]).otherwise(obj["id"])
    key = (
        F.when(event["source"] == "faker", event["payload"]["user_id"])
        .when(event["source"] == "stripe", F.concat(F.lit("stripe_payment_intent_"), intent))
        .when(event["source"] == "revolut", F.concat(F.lit("revolut_transaction_"), event["payload"]["data"]["id"]))
    )
    return messages.select(key.alias("key"), "value")


def _whole_number(doc: Document, path: str) -> Column:
    text = F.trim(doc.text(path))
    from_text = F.when(text.rlike(r"^[+-]?\d+(_\d+)*(\.0*)?\z"), F.regexp_replace(text, r"_|\..*", "").try_cast("bigint"))
    direct = F.try_variant_get(doc.column, f"$[0]{path}", "double")
    from_number = F.when(direct == F.floor(direct), F.try_variant_get(doc.column, f"$[0]{path}", "bigint"))
    return F.when(doc.is_text(path), from_text).otherwise(from_number)


def _truth(doc: Document, path: str) -> Column:
    text = F.lower(F.when(doc.is_text(path) | (doc.kind(path) == "BOOLEAN"), doc.text(path)))
    number = F.when(~doc.is_text(path), F.try_variant_get(doc.column, f"$[0]{path}", "double"))
    return (
        F.when(text.isin(TRUE_TEXTS) | (number == 1), True)
        .when(text.isin(FALSE_TEXTS) | (number == 0), False)
    )


def check_stripe_events(bodies: DataFrame) -> DataFrame:
    """Check the structure of provider events in `body` and keep the six known fields.

    Adds `payload` (JSON text) for well-formed events and `reason` for the others: `not_object`, or the
    name of the first field that is missing or of the wrong type.
    """
    columns = [name for name in bodies.columns if name != "body"]
    parsed = computed_once(bodies, {"doc": F.try_parse_json(as_array(F.col("body")))}, *columns, "body")
    doc = Document(F.col("doc"))

    def given(path: str) -> Column:
        return ~doc.missing(path) & ~F.is_variant_null(doc.value(path))

    created, livemode = _whole_number(doc, ".created"), _truth(doc, ".livemode")
    reason = (
        F.when(~F.coalesce(doc.is_alone(), F.lit(False)) | ~doc.is_object(), "not_object")
        .when(~doc.is_text(".id"), "id")
        .when(~doc.is_text(".type"), "type")
        .when(~doc.is_object(".data"), "data")
        .when(~doc.missing(".api_version") & ~doc.is_text_or_null(".api_version"), "api_version")
        .when(given(".created") & created.isNull(), "created")
        .when(given(".livemode") & livemode.isNull(), "livemode")
    )
    event = F.struct(
        doc.text(".id").alias("id"),
        doc.text(".type").alias("type"),
        doc.value(".data").alias("data"),
        doc.text(".api_version").alias("api_version"),
        created.alias("created"),
        livemode.alias("livemode"),
    )
    return parsed.select(*columns, "body", reason.alias("reason"), event.alias("event")).select(
        *columns,
        "body",
        "reason",
        F.when(F.col("reason").isNull(), F.to_json("event", {"ignoreNullFields": "false"})).alias("payload"),
    )
