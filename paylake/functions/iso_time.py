"""ISO text timestamps: what is accepted, the wall clock as written, and the UTC instant.

Accepted text is `YYYY-MM-DD`, optionally followed by any separator character, `HH[:MM[:SS[.fff[fff]]]]`
and an offset `+HH:MM[:SS]`, `-HH:MM[:SS]` or `Z`. Spark's own cast accepts more (`2026`, `2026-2-5`) and
less (other separators, offsets after `HH`), so a pattern decides and the cast only checks the ranges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"(?!0000)\d{4}-\d{2}-\d{2}"
_OFFSET = r"[+-]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d)?|Z"

# The usual form needs one match and one cast; everything else takes the repair path.
PLAIN = rf"^{_DATE}[T ]\d{{2}}:\d{{2}}:\d{{2}}(\.\d{{3}}(\d{{3}})?)?\z"
ACCEPTED = rf"(?s)^{_DATE}(.\d{{2}}(:\d{{2}}(:\d{{2}}(\.\d{{3}}(\d{{3}})?)?)?)?({_OFFSET})?)?\z"


def _offset_seconds(text: Column) -> Column:
    """Signed seconds: the offset read as a time of day on 1970-01-01, by its sign."""
    offset = F.regexp_extract(F.substr(text, F.lit(12)), r"([+-]\d{2}:\d{2}(:\d{2})?)\z", 1)
    clock = F.concat(F.lit("1970-01-01 "), F.substr(offset, F.lit(2))).try_cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), clock)
    return F.coalesce(seconds, F.lit(0)) * F.when(F.contains(offset, F.lit("-")), -1).otherwise(1)


def _plain(text: Column) -> Column:
    return F.left(text, F.lit(23)).try_cast("timestamp_ntz")


def _repaired(text: Column) -> Column:
    """Without the offset, with `T` as separator and the time filled up to seconds."""
    clock = F.regexp_replace(F.substr(text, F.lit(12)), rf"({_OFFSET})\z", "")
    padded = F.concat(F.left(clock, F.lit(12)), F.substr(F.lit("00:00:00"), F.length(clock) + 1))
    return F.concat(F.left(text, F.lit(10)), F.lit("T"), padded).try_cast("timestamp_ntz")


def wall_clock(text: Column) -> Column:
    """Date and time as written, cut to milliseconds; NULL when the text is not accepted."""
    return F.when(text.rlike(PLAIN), _plain(text)).when(text.rlike(ACCEPTED), _repaired(text))


def utc_clock(text: Column) -> Column:
    """The same instant with the offset, if any, taken off."""
    shifted = F.timestamp_add("SECOND", -_offset_seconds(text), _repaired(text))
    return F.when(text.rlike(PLAIN), _plain(text)).when(text.rlike(ACCEPTED), shifted)


def day_parts(text: Column) -> dict[str, Column]:
    """Partition values of an accepted text: slices of the date and the hour as written."""
    return {
        "year": F.substring(text, 1, 4),
        "month": F.substring(text, 6, 2),
        "day": F.substring(text, 9, 2),
        "hr": F.when(F.length(text) > 10, F.substring(text, 12, 2)).otherwise(F.lit("00")),
    }


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")
