"""Batch jobs over the layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from paylake.operators.compact import TARGET_BYTES, compact
from paylake.operators.envelope import read_envelopes, rejected_rows, valid_rows
from paylake.operators.normalize import normalize, rejected_payloads
from paylake.schemas import HOUR_PARTS
from paylake.session import for_each
from paylake.sources.layers import (
    Days,
    append_raw,
    gathered,
    in_previous_day,
    in_previous_hour,
    path_exists,
    remove_parts,
    replace_window,
    scan_raw,
)


def ingest_batch(messages: DataFrame, raw_root: str) -> DataFrame:
    """Store the valid messages of a batch; returns the refused ones."""
    envelopes = read_envelopes(messages)
    append_raw(valid_rows(envelopes), raw_root)
    return rejected_rows(envelopes)


def _process(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    window: Days,
    sources: Sequence[str],
    strict: bool,
    ignore_corrupt: bool,
    rejects_root: str | None,
) -> dict[str, dict[str, int]]:
    def process(source: str) -> dict[str, int]:
        raw, counts = scan_raw(spark, raw_root, window, [source], ignore_corrupt), Observation()
        rows = normalize(raw, source, strict, keep=HOUR_PARTS, counts=counts)
        # The rows of a single hour need no shuffle: every task writes to the one folder.
        rows = gathered(rows, HOUR_PARTS) if window.hour is None else rows
        kept = replace_window(rows, f"{processed_root}/source={source}", window, HOUR_PARTS)
        read, rejected = counts.get["read"], counts.get["rejected"]
        if rejects_root:
            set_aside(raw, source, rejected, f"{rejects_root}/source={source}")
        return {"read": read, "kept": kept, "rejected": rejected, "dropped": read - kept - rejected}

    def set_aside(raw: DataFrame, source: str, rejected: int, path: str) -> None:
        # The pass above has counted them; clean windows, the usual ones, are not read again.
        if rejected:
            replace_window(rejected_payloads(raw, source, HOUR_PARTS), path, window, HOUR_PARTS)
        elif path_exists(spark, path):
            remove_parts(spark, path, window, HOUR_PARTS, set())

    return dict(zip(sources, for_each(sources, process), strict=True))


def process_days(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    first: date,
    last: date,
    sources: Sequence[str],
    strict: bool = False,
    ignore_corrupt: bool = False,
    rejects_root: str | None = None,
) -> dict[str, dict[str, int]]:
    """Rebuild the typed rows of whole days. A rerun replaces them, so it adds no duplicates and leaves none behind.

    Returns, per source, rows read, kept, rejected as malformed, and dropped as not wanted. With `rejects_root` the
    rejected ones are stored there with a reason, in the same folders.
    """
    return _process(spark, raw_root, processed_root, Days(first, last), sources, strict, ignore_corrupt, rejects_root)


def process_previous_hour(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    now: datetime,
    sources: Sequence[str],
    strict: bool = False,
    ignore_corrupt: bool = False,
    rejects_root: str | None = None,
) -> dict[str, dict[str, int]]:
    """The hourly run: read and rebuild the hour before `now`, and nothing else of its day."""
    return _process(spark, raw_root, processed_root, in_previous_hour(now), sources, strict, ignore_corrupt, rejects_root)


def payload_rejects(
    spark: SparkSession, raw_root: str, first: date, last: date, source: str
) -> DataFrame:
    return rejected_payloads(scan_raw(spark, raw_root, Days(first, last), [source]), source)


def compact_days(
    spark: SparkSession,
    processed_root: str,
    analytics_root: str,
    first: date,
    last: date,
    sources: Sequence[str],
    target_bytes: int = TARGET_BYTES,
    ignore_corrupt: bool = False,
) -> None:
    compact(spark, processed_root, analytics_root, sources, Days(first, last), target_bytes, ignore_corrupt)


def compact_previous_day(
    spark: SparkSession,
    processed_root: str,
    analytics_root: str,
    now: datetime,
    sources: Sequence[str],
    target_bytes: int = TARGET_BYTES,
    ignore_corrupt: bool = False,
) -> None:
    """The daily run."""
    compact(spark, processed_root, analytics_root, sources, in_previous_day(now), target_bytes, ignore_corrupt)
