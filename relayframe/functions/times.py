"""Time buckets, time texts and time decoding, all in UTC."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds from 0001-01-01 to 1970-01-01, and the bucket text format.
YEAR_ONE_SECONDS = 62_135_596_800
BUCKET_FORMAT = "yyyy-MM-dd HH:mm:ss"
BUCKET_STRPTIME = "%Y-%m-%d %H:%M:%S"

# The names of the accepted JSON time formats.
RFC3339 = "rfc3339"
SECONDS = "timestamp"
MILLIS = "timestamp-milli"
TIME_FORMATS = (RFC3339, SECONDS, MILLIS)

_UNIT_MICROS = {
    "us": 1,
    "ms": 1_000,
    "s": 1_000_000,
    "m": 60_000_000,
    "h": 3_600_000_000,
}


def duration_micros(value: str | int | float | timedelta) -> int:
    """``"1h30m"``, ``"500ms"``, a timedelta, or a number of seconds, in microseconds."""
    if isinstance(value, timedelta):
        return value // timedelta(microseconds=1)
    if isinstance(value, (int, float)):
        return round(value * 1_000_000)
    parts = re.findall(r"(\d+(?:\.\d+)?)(us|ms|s|m|h)", value)
    if not parts or "".join(n + u for n, u in parts) != value:
        raise ValueError(f"invalid duration: {value!r}")
    return round(sum(float(n) * _UNIT_MICROS[u] for n, u in parts))


def floor_time(ts: Column, interval: str | int | timedelta = "1h") -> Column:
    """Start of the tumbling interval holding ``ts``, with intervals counted from year 1.

    ``window()`` counts from 1970, which shifts every interval that does not divide that span
    (a week starts on Monday here and on Thursday there).
    """
    width = duration_micros(interval)
    if width <= 0:
        raise ValueError("interval must be positive")
    since_year_one = F.unix_micros(ts) + F.lit(YEAR_ONE_SECONDS * 1_000_000)
    return F.timestamp_micros(F.unix_micros(ts) - F.pmod(since_year_one, F.lit(width)))


def bucket(ts: Column, interval: str | int | timedelta = "1h") -> Column:
    """Bucket text in whole seconds, so intervals under a second share a bucket."""
    return F.date_format(floor_time(ts, interval), BUCKET_FORMAT)


def bucket_bound(value: str | datetime) -> str:
    """Check a date bound and give it in bucket text form, which sorts like time."""
    if isinstance(value, str):
        value = datetime.strptime(value, BUCKET_STRPTIME)
    return value.strftime(BUCKET_STRPTIME)


def decode_time(value: Column, time_format: str = MILLIS, strict: bool = True) -> Column:
    """JSON time to timestamp. ``value`` is text for RFC 3339 and a whole number otherwise."""
    if time_format == RFC3339:
        return F.to_timestamp(value) if strict else F.try_to_timestamp(value)
    if time_format == SECONDS:
        return F.timestamp_seconds(value)
    if time_format == MILLIS:
        return F.timestamp_millis(value)
    raise ValueError(f"invalid time_format: {time_format}")


def rfc3339_text(ts: Column) -> Column:
    """``2024-01-01T10:00:00.25Z``: fraction only as long as needed."""
    fraction = F.regexp_replace(F.date_format(ts, ".SSSSSS"), r"\.?0+$", "")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))
