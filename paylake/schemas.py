"""Schemas of the stored layers. Partition columns stay text, so `02` does not become 2."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()

DAY_PARTS = ["year", "month", "day"]
HOUR_PARTS = [*DAY_PARTS, "hr"]


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


MESSAGE = _schema(("value", TEXT))

RAW = _schema(
    ("source", TEXT), ("received_at", TEXT), ("payload", TEXT),
    *((part, TEXT) for part in HOUR_PARTS),
)

TRANSFER = _schema(
    ("source", TEXT), ("received_at", T.TimestampNTZType()), ("transaction_id", TEXT),
    ("user_id", TEXT), ("amount", T.DoubleType()), ("currency", TEXT), ("transaction_type", TEXT),
)

INTENT = _schema(
    ("source", TEXT), ("received_at", T.TimestampNTZType()), ("payment_intent_id", TEXT),
    ("customer_id", TEXT), ("amount", T.DoubleType()), ("currency", TEXT), ("payment_method", TEXT),
)

PROCESSED = {"faker": TRANSFER, "stripe": INTENT, "revolut": TRANSFER}


def processed_schema(source: str) -> T.StructType:
    if source not in PROCESSED:
        raise ValueError(f"unknown source: {source}")
    return PROCESSED[source]


def with_parts(schema: T.StructType, parts: list[str]) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(part, TEXT) for part in parts)])
