"""Keyed digests as native expressions. The key is data, never part of a plan."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_BLOCK = 64


@dataclass(frozen=True)
class Key:
    """A key in its two paddings, as columns read at run time."""

    inner: Column
    outer: Column


def signing_key(spark: SparkSession, secret: str) -> Key:
    """The key as a table of one row, which expressions refer to: no plan, page or event log shows it."""
    key = secret.encode()
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    pads = tuple(bytearray(byte ^ pad for byte in key.ljust(_BLOCK, b"\0")) for pad in (0x36, 0x5C))
    table = spark.createDataFrame([pads], "inner_pad binary, outer_pad binary")
    return Key(table.select("inner_pad").scalar(), table.select("outer_pad").scalar())


def hmac_sha256(key: Key, message: Column) -> Column:
    """Lower-case hexadecimal HMAC-SHA256 (RFC 2104): two nested digests over padded keys."""
    first = F.unhex(F.sha2(F.concat(key.inner, message.cast("binary")), 256))
    return F.sha2(F.concat(key.outer, first), 256)
