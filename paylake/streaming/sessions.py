"""State per key: messages once each, and sessions of activity.

Both hold state only for what the watermark has not passed: a key for as long as its repeats may still come, a session until
no event can join it. Sessions are merged map-side before the shuffle (see `paylake.session`), so a hot key arrives as
sessions and not as events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.streaming.rates import LATENESS


def once_each(messages: DataFrame, key: Sequence[str], at: str, lateness: str = LATENESS) -> DataFrame:
    """Messages without repeats of `key` that come within `lateness` of the first; `at` becomes an instant.

    Messages older than the watermark are dropped, as their keys are forgotten. A null key is a key like any other.
    """
    timed = messages.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness)
    return timed.dropDuplicatesWithinWatermark(list(key))


def live_sessions(events: DataFrame, labels: Sequence[str], gap: str, at: str = "ts", lateness: str | None = LATENESS) -> DataFrame:
    """Closed sessions: `began, ended, [labels], n`. A session ends `gap` after its last event, and is given once the
    watermark has passed its end; use with append mode. `lateness` None takes the watermark that the events have.
    """
    if lateness is not None:
        events = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, lateness)
    found = events.groupBy(F.session_window(at, gap).alias("w"), *labels).agg(F.count(F.lit(1)).alias("n"))
    bounds = [F.col(f"w.{a}").cast("timestamp_ntz").alias(b) for a, b in (("start", "began"), ("end", "ended"))]
    return found.select(*bounds, *labels, "n")
