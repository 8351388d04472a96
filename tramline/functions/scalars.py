"""Scalar functions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def window_start(ms: Column | str, width: int) -> Column:
    """The start of the tumbling window, aligned to the epoch; also right before it."""
    c = F.col(ms) if isinstance(ms, str) else ms
    return c - F.pmod(c, F.lit(width))


def text(c: Column) -> Column:
    """An empty string counts as missing."""
    return F.nullif(c, F.lit(""))


def direction(c: Column) -> Column:
    """-1 where the direction is missing or empty."""
    return F.coalesce(text(c.cast("string")).try_cast("int"), F.lit(-1))


def clock_seconds(c: Column) -> Column:
    """Seconds of a service clock `H:MM:SS`, hours of one to three digits and past 24; null if malformed."""
    pattern = r"^([0-9]{1,3}):([0-5][0-9]):([0-5][0-9])$"
    part = lambda k: F.regexp_extract(c, pattern, k).try_cast("int")
    return part(1) * 3600 + part(2) * 60 + part(3)


def service_instant(day: Column, seconds: Column, zone: Column | str) -> Column:
    """Epoch seconds of a service clock: local noon less twelve hours, then the seconds, whatever the clocks do."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    noon = F.to_timestamp(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 12:00:00")), "yyyy-MM-dd HH:mm:ss")
    return F.unix_seconds(F.to_utc_timestamp(noon, zone)) - 43200 + seconds


def weekday(day: Column) -> Column:
    return F.lower(F.date_format(day, "EEEE"))


def strict_date(c: Column) -> Column:
    """A `yyyyMMdd` date, or null."""
    return F.when(c.rlike("^[0-9]{8}$"), F.try_to_date(c, "yyyyMMdd"))


def instant(c: Column) -> Column:
    """Epoch milliseconds of an ISO instant; null without an offset."""
    return F.when(c.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$"), F.unix_millis(F.try_to_timestamp(c)))


def digest(ids: Column) -> Column:
    """SHA-256 of the distinct ids, sorted, one a line."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(ids)), "\n"), 256)


def snapshot_id(feed: Column, body: Column) -> Column:
    return F.sha2(F.concat(F.encode(feed, "UTF-8"), F.unhex(F.lit("00")), body), 256)


def redacted(url: Column) -> Column:
    """A URL without user information, query and fragment."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^([A-Za-z][A-Za-z0-9+.-]*://)[^/@]*@", "$1")


def beyond_retention(ms: Column, watermark: Column, retention: int) -> Column:
    """False before the first watermark (null)."""
    return F.coalesce(ms <= watermark - retention, F.lit(False))


def seconds(ms: Column) -> Column:
    return ms / F.lit(1000.0)


def canonical_order() -> Column:
    return F.struct("observed_at", "event_id")
