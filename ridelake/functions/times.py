"""Date and time expressions that do not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Market time zone and the formats of the inputs.
MARKET_ZONE = "Asia/Seoul"
COMPACT_DATE = "yyyyMMdd"
FORECAST_MINUTE = "yyyyMMddHHmm"
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ssX"

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_DAY_ONE = "TIMESTAMP_NTZ'0001-01-01 00:00:00'"


def _in_zone(utc_wall: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)


def wall_from_millis(millis: Column, zone: str = MARKET_ZONE) -> Column:
    """Epoch milliseconds -> zoneless wall clock in ``zone``."""
    return _in_zone(F.timestamp_add("MILLISECOND", millis, F.expr(_EPOCH)), zone)


def wall_from_micros(micros: Column, zone: str = MARKET_ZONE) -> Column:
    """Epoch microseconds -> zoneless wall clock in ``zone``."""
    return _in_zone(F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH)), zone)


def wall_from_utc(utc_wall: Column, zone: str = MARKET_ZONE) -> Column:
    """Zoneless UTC clock -> zoneless clock in ``zone`` (run time of a load)."""
    return _in_zone(utc_wall, zone)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Second boundaries crossed from ``earlier`` to ``later`` (not whole elapsed seconds)."""

    def ordinal(clock: Column) -> Column:
        since = clock - F.expr(_DAY_ONE)
        parts = {"DAY": 86_400, "HOUR": 3_600, "MINUTE": 60}
        whole = F.floor(F.extract(F.lit("SECOND"), since)).cast("bigint")
        for part, seconds in parts.items():
            whole = whole + F.extract(F.lit(part), since).cast("bigint") * seconds
        return whole

    return ordinal(later) - ordinal(earlier)


def instant_from_iso(text: Column, strict: bool = False) -> Column:
    """``2024-01-01T00:00:00Z`` -> TIMESTAMP.

    Blank and NULL give NULL.  Malformed text gives NULL, or fails if ``strict``.
    """
    parse = F.to_timestamp if strict else F.try_to_timestamp
    return parse(F.nullif(text, F.lit("")), F.lit(ISO_INSTANT) if not strict else ISO_INSTANT)


def wall_from_parts(date_text: Column, time_text: Column) -> Column:
    """``20220501`` + ``0130`` -> zoneless wall clock, taken as it is written."""
    return F.to_timestamp_ntz(F.concat(date_text, time_text), F.lit(FORECAST_MINUTE))


def date_from_compact(text: Column) -> Column:
    return F.to_date(text, COMPACT_DATE)


def trailing_window(day: Column, target: dt.date, days_back: int = 1) -> Column:
    """``day`` within ``[target - days_back, target]``; literal bounds, so partitions are pruned."""
    return day.between(F.lit(target - dt.timedelta(days=days_back)), F.lit(target))


def market_today(now: Column | None = None) -> Column:
    """Date in the market's zone of ``now`` (a zoneless UTC clock), or of the current moment."""
    if now is None:
        return F.to_date(F.convert_timezone(None, F.lit(MARKET_ZONE), F.localtimestamp()))
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(MARKET_ZONE), now))


def shift_day(day: dt.date, days: int = 0) -> dt.date:
    return day + dt.timedelta(days=days)


def day_suffix(day: dt.date) -> str:
    """Suffix of a date-sharded table or partition."""
    return day.strftime("%Y%m%d")
