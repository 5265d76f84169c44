"""Event envelopes: decode, check, and split into rows to store and rows to set aside.

A message is the JSON text `{source, received_at, payload}`. One parse extracts the three fields; a row
gets a `reason` when it is not a valid envelope:

    not_object       not JSON, or JSON that is no object
    too_large        unreadable, with a number of more than 1,000 characters, the parser's limit
    missing_key      a key is absent, or source is null (payload may be null)
    bad_source       source is not text
    bad_received_at  received_at is not an accepted timestamp text
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions.iso_time import day_parts, wall_clock
from paylake.functions.json_values import Document, as_array, beyond_limits, canonical_field, computed_once
from paylake.schemas import HOUR_PARTS

_FIELDS = "ARRAY<STRUCT<source: STRING, received_at: STRING, payload: STRING>>"

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _key_absent(field: Column, name: str) -> Column:
    """Extraction gives NULL for an absent key and for a JSON null; the keys are listed only then."""
    return field.isNull() & ~F.coalesce(F.array_contains(F.json_object_keys("value"), name), F.lit(False))


def _not_text(source: Column) -> Column:
    """Extraction turns other types into text; only text that could come from one is looked at again."""
    doubtful = F.left(source, F.lit(1)).isin(list("-0123456789{[")) | source.isin("true", "false")
    exact = Document(F.try_parse_json(as_array(F.col("value"))))
    return doubtful & ~exact.is_text(".source")


def read_envelopes(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """`value` (text or bytes) to `value, source, received_at, payload, reason`; every message is kept.

    `keep` carries other columns of the message along, such as the broker's own timestamp.
    """
    text = messages.select(F.col("value").cast("string").alias("value"), *keep)
    # Bytes that are no UTF-8 text leave nothing to parse.
    fields = F.from_json(as_array(F.try_validate_utf8("value")), _FIELDS, _STRICT)
    parsed = computed_once(text, {"docs": fields}, "value", *keep)

    doc = F.get("docs", F.lit(0))
    alone = (F.coalesce(F.size("docs"), F.lit(0)) == 2) & F.get("docs", F.lit(1)).isNull()
    source, received_at, payload = doc["source"], doc["received_at"], doc["payload"]
    reason = (
        F.when(~alone | doc.isNull(), F.when(beyond_limits(F.col("value")), "too_large").otherwise("not_object"))
        .when(
            source.isNull() | _key_absent(received_at, "received_at") | _key_absent(payload, "payload"),
            "missing_key",
        )
        .when(_not_text(source), "bad_source")
        # Other types never spell a timestamp, so their text fails here too.
        .when(wall_clock(received_at).isNull(), "bad_received_at")
    )
    return parsed.select(
        "value",
        source.alias("source"),
        received_at.alias("received_at"),
        payload.alias("payload"),
        reason.alias("reason"),
        *keep,
    )


def valid_rows(envelopes: DataFrame) -> DataFrame:
    """Rows of the raw layer, with payload as JSON text and the partition columns."""
    parts = day_parts(F.col("received_at"))
    return envelopes.filter(F.col("reason").isNull()).select(
        "source",
        "received_at",
        canonical_field(F.col("value"), "payload", F.col("payload")).alias("payload"),
        *(parts[name].alias(name) for name in HOUR_PARTS),
    )


def rejected_rows(envelopes: DataFrame) -> DataFrame:
    return envelopes.filter(F.col("reason").isNotNull()).select("value", "reason")


def count_outcomes(envelopes: DataFrame, observation) -> DataFrame:
    """Attach live counters of accepted and refused messages to a batch or stream."""
    accepted = F.count_if(F.col("reason").isNull()).alias("accepted")
    refused = F.count_if(F.col("reason").isNotNull()).alias("refused")
    return envelopes.observe(observation, accepted, refused)
