"""ISO-8601 text stamps, instants, ages and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boardlake.functions.text import strip

# Text of an instant in UTC with milliseconds.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
UNIT_MS = {"ms": 1, "s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}


def instant(stamp: Column) -> Column:
    """Timestamp of an ISO text; NULL when it does not parse."""
    return F.try_to_timestamp(stamp)


def millis(stamp: Column) -> Column:
    return F.unix_millis(instant(stamp))


def iso_text(moment: Column) -> Column:
    """UTC text of an instant, whatever the time zone of the session."""
    return F.date_format(F.convert_timezone(None, F.lit("UTC"), moment.cast("timestamp_ntz")), ISO_MILLIS)


def iso_from_millis(value: Column) -> Column:
    return iso_text(F.timestamp_millis(value))


def _half_up(value: Column) -> Column:
    return F.floor(value + F.lit(0.5))


def relative_time(stamp: Column, now: Column) -> Column:
    """Age as ``12s ago`` … ``3d ago``; ``never`` without a stamp, the raw text when it does not parse."""
    seconds = F.greatest(F.lit(0), _half_up((F.unix_millis(now) - millis(stamp)) / 1000))
    minutes = _half_up(seconds / 60)
    hours = _half_up(minutes / 60)
    days = _half_up(hours / 24)

    def ago(number: Column, unit: str) -> Column:
        return F.concat(number.cast("string"), F.lit(f"{unit} ago"))

    return (
        F.when(stamp.isNull() | (stamp == ""), F.lit("never"))
        .when(instant(stamp).isNull(), stamp)
        .when(seconds < 60, ago(seconds, "s"))
        .when(minutes < 60, ago(minutes, "m"))
        .when(hours < 48, ago(hours, "h"))
        .otherwise(ago(days, "d"))
    )


def duration_ms(text: Column) -> Column:
    """Milliseconds of ``90s``, ``5m``, ``2h``, ``1d`` or a bare number of seconds; NULL when malformed."""
    pattern = r"^(\d+)\s*(ms|s|m|h|d)?$"
    trimmed = strip(text)
    amount = F.regexp_extract(trimmed, pattern, 1).try_cast("bigint")
    unit = F.regexp_extract(trimmed, pattern, 2)
    factor = F.lit(UNIT_MS["s"])
    for name, size in UNIT_MS.items():
        factor = F.when(unit == name, F.lit(size)).otherwise(factor)
    return F.when(trimmed.rlike(pattern), amount * factor)


def freshness_state(last_sync_at: Column, now: Column, stale_after_ms: int) -> Column:
    age = F.unix_millis(now) - millis(last_sync_at)
    return (
        F.when(last_sync_at.isNull(), F.lit("empty")).when(age > stale_after_ms, F.lit("stale")).otherwise(F.lit("current"))
    )
