"""Calendar expressions: local time, fixed-length windows from an origin, countdowns and durations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The election the countdown refers to, the local zone and the window length in days.
ELECTION_DATE = "2026-05-31"
LOCAL_ZONE = "America/Bogota"
WINDOW_DAYS = 3

_DAY_MICROS = 86_400_000_000


def local_time(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(ts, zone)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def days_until(ts: Column, target: str = ELECTION_DATE) -> Column:
    """Whole days left, rounded down, so one hour past the target is -1."""
    left = F.unix_micros(F.lit(target).cast("timestamp")) - F.unix_micros(ts)
    return F.floor(left / F.lit(_DAY_MICROS)).cast("int")


def window_index(day: Column, origin: Column, days: int = WINDOW_DAYS) -> Column:
    """Number of the ``days``-long window that ``day`` falls in; window 0 starts at ``origin``."""
    return F.floor(F.datediff(day, origin) / F.lit(days)).cast("int")


def window_start(index: Column, origin: Column, days: int = WINDOW_DAYS) -> Column:
    return F.date_add(origin, (index * days).cast("int"))


def window_end(index: Column, origin: Column, days: int = WINDOW_DAYS) -> Column:
    return F.date_add(origin, (index * days + (days - 1)).cast("int"))


_DURATION = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?$"


def iso_duration_seconds(c: Column) -> Column:
    """``PT1H2M3S`` -> 3723; NULL or anything else -> 0."""
    def part(i: int) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(c, _DURATION, i), F.lit("")).try_cast("bigint"), F.lit(0))
    return F.coalesce(part(1) * 3600 + part(2) * 60 + part(3), F.lit(0))


def epoch_text(seconds: Column) -> Column:
    """Epoch seconds -> ``yyyy-MM-dd HH:mm:ss`` in the session zone; NULL or 0 -> empty text."""
    shown = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")
    return F.when(seconds.isNull() | (seconds == 0), F.lit("")).otherwise(shown)


def run_seconds(started: Column, finished: Column) -> Column:
    """Length of a run in whole seconds, halves rounded up."""
    return F.round((F.unix_micros(finished) - F.unix_micros(started)) / F.lit(1_000_000), 0).cast("int")
