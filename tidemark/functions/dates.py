"""Date and time functions. `now` is always an argument, never the wall clock."""

from __future__ import annotations

import zoneinfo
from functools import lru_cache

from pyspark.sql import Column, functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


@lru_cache(maxsize=1)
def _zone_names() -> list[str]:
    # the last three stand for a machine's own setting, not for a place
    return sorted(zoneinfo.available_timezones() - {"Factory", "localtime", "posixrules"})


def iso_to_utc(c: Column) -> Column:
    """ISO text to an instant: an offset is honoured, a naive value is UTC, junk is NULL."""
    return F.try_to_timestamp(c)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_SECONDS)


def local_to_utc(ts: Column, zone: Column) -> Column:
    """Wall-clock time in a named zone to UTC, per-row DST; an unknown zone counts as UTC."""
    # the one name that Java's zone table lacks
    named = F.when(zone == "ROC", "Asia/Taipei").otherwise(zone)
    return F.when(zone.isin(_zone_names()), F.to_utc_timestamp(ts, named)).otherwise(ts)


def from_epoch(c: Column, unit: str = "s", fallback: Column | None = None) -> Column:
    """Epoch number in s, ms or us (fractional seconds allowed); NULL takes the fallback."""
    scale = {"s": 1_000_000, "ms": 1_000, "us": 1}[unit]
    ts = F.timestamp_micros((c * F.lit(scale)).cast("bigint"))
    return ts if fallback is None else F.coalesce(ts, fallback)


def to_epoch(ts: Column, unit: str = "s") -> Column:
    return {"s": F.unix_seconds, "ms": F.unix_millis, "us": F.unix_micros}[unit](ts)


def first_format(c: Column, formats: list[str]) -> Column:
    """The first format that parses wins; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def vendor_iso(c: Column) -> Column:
    """'05 Jan 2024 03:04:05 PM' to ISO text; blank is NULL, other text is kept as it is."""
    parsed = iso_text(F.try_to_timestamp(c, F.lit("d MMM yyyy h:mm:ss a")))
    return F.when(c != "", F.coalesce(parsed, c))


def iso_or_epoch(c: Column) -> Column:
    """Text that is either ISO or whole epoch seconds."""
    seconds = F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))
    return F.coalesce(F.timestamp_seconds(seconds), F.try_to_timestamp(c))


def yymmdd(c: Column) -> Column:
    """Six-digit date; two-digit years 69-99 are 19xx, 00-68 are 20xx."""
    century = F.when(F.substring(c, 1, 2) >= "69", "19").otherwise("20")
    whole = c.rlike("^[0-9]{6}$")
    return F.when(whole, F.to_date(F.try_to_timestamp(F.concat(century, c), F.lit("yyyyMMdd"))))


def floor_to(ts: Column, unit: str) -> Column:
    return F.date_trunc(unit, ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Exact duration in seconds with microsecond precision; NULL if either end is missing."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def older_than(ts: Column, now: Column, days: int) -> Column:
    return ts < now - F.expr(f"INTERVAL {days} DAYS")
