"""Pickup-time expressions.

Pickup times are ``timestamp_ntz`` values that hold the UTC wall clock, so no
result depends on the session time zone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelane.schema import CITY_ZONE

_EPOCH = "1970-01-01 00:00:00"
HOUR = 3600
DAY = 24 * HOUR


def _epoch() -> Column:
    return F.lit(_EPOCH).cast("timestamp_ntz")


def parse_utc(text: Column, strict: bool = False) -> Column:
    """Text to UTC wall clock; null for text that is no time.

    A trailing ``UTC`` is optional, an explicit offset such as ``+02:00`` is
    converted. With ``strict`` only ``yyyy-MM-dd HH:mm:ss UTC`` is accepted.
    """
    bare = F.regexp_replace(F.trim(text), r"\s*(UTC|Z)$", "")
    has_offset = bare.rlike(r":\d\d(\.\d+)?\s*[+-]\d\d:?\d\d$")
    instant = F.when(has_offset, bare).otherwise(F.concat(bare, F.lit("Z"))).try_cast("timestamp")
    # date-only text takes no zone letter
    day = F.when(bare.rlike(r"^\d{4}-\d\d?-\d\d?$"), bare).try_cast("timestamp_ntz")
    moment = F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())
    parsed = F.coalesce(day, moment)
    if strict:
        return F.when(text.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d UTC$"), parsed)
    return parsed


def clock_seconds(ts: Column) -> Column:
    """A wall clock as whole seconds since 1970-01-01 00:00 on the same clock.

    Built from the fields, because a difference or a cast of ``timestamp_ntz`` values
    goes through the session time zone.
    """
    days = F.unix_date(ts.cast("date")).cast("long")
    return days * DAY + F.hour(ts) * HOUR + F.minute(ts) * 60 + F.second(ts)


def _shift_to_local(seconds: Column, tz: str) -> Column:
    # convert_timezone looks the zone up by name for every row and is several times slower
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(seconds), tz))


def _shift_to_utc(seconds: Column, tz: str) -> Column:
    return F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(seconds), tz))


def local_clock(utc: Column, tz: str = CITY_ZONE) -> Column:
    """:func:`to_local` as whole seconds, for :func:`clock_date` and :func:`clock_hour`."""
    return _shift_to_local(clock_seconds(utc), tz)


def clock_date(seconds: Column) -> Column:
    """Date of a clock given in seconds."""
    return F.date_from_unix_date(((seconds - F.pmod(seconds, F.lit(DAY))) / F.lit(DAY)).cast("int"))


def clock_hour(seconds: Column) -> Column:
    """Hour 0..23 of a clock given in seconds."""
    return (F.pmod(seconds, F.lit(DAY)) / F.lit(HOUR)).cast("int")


def to_local(utc: Column, tz: str = CITY_ZONE) -> Column:
    """UTC wall clock to local wall clock, following daylight saving time."""
    here = clock_seconds(utc)
    return F.timestamp_add("SECOND", _shift_to_local(here, tz) - here, utc)


def local_to_utc(local: Column, tz: str = CITY_ZONE) -> Column:
    """Local wall clock to UTC; see :func:`local_status` for which values are safe."""
    here = clock_seconds(local)
    return F.timestamp_add("SECOND", _shift_to_utc(here, tz) - here, local)


def local_status(local: Column, tz: str = CITY_ZONE) -> Column:
    """``ok``, ``ambiguous`` (the hour repeats), ``nonexistent`` (skipped) or ``missing``."""
    here = clock_seconds(local)
    utc = _shift_to_utc(here, tz)
    twice = (_shift_to_local(utc + HOUR, tz) == here) | (_shift_to_local(utc - HOUR, tz) == here)
    return (
        F.when(local.isNull(), "missing")
        .when(_shift_to_local(utc, tz) != here, "nonexistent")
        .when(twice, "ambiguous")
        .otherwise("ok")
    )


def format_utc(utc: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss UTC``."""
    return F.concat(F.date_format(utc, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))


def weekday(ts: Column) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(ts)


def cyclic_hour(hour: Column) -> tuple[Column, Column]:
    """Sine and cosine of the hour on a 24-hour circle."""
    angle = hour * F.lit(2 * math.pi / 24)
    return F.sin(angle), F.cos(angle)


def to_instant(utc: Column) -> Column:
    """UTC wall clock to ``timestamp``, the only type a watermark accepts."""
    seconds = clock_seconds(utc)
    fraction = utc - F.timestamp_add("SECOND", seconds, _epoch())
    return F.timestamp_seconds(seconds) + fraction
