"""Periods and clocks (SC-02..06, SC-13, SC-14); wall-clock times are TIMESTAMP_NTZ."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F


def plus_hours(ts: Column, n) -> Column:
    return (ts + F.make_dt_interval(F.lit(0), n if isinstance(n, Column) else F.lit(n), F.lit(0), F.lit(0))).cast("timestamp_ntz")


def plus_minutes(ts: Column, n) -> Column:
    return (ts + F.make_dt_interval(F.lit(0), F.lit(0), n if isinstance(n, Column) else F.lit(n), F.lit(0))).cast("timestamp_ntz")


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def day_of(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def epoch(ts: Column) -> Column:
    """Seconds of a wall-clock time (the session time zone is UTC)."""
    return F.unix_timestamp(ts.cast("timestamp"))


def slot_of(ts: Column) -> Column:
    """Number of the ten-minute slot."""
    return F.floor(epoch(ts) / 600).cast("long")


def month_key(ts: Column) -> Column:
    return (F.year(ts) * 12 + F.month(ts) - 1).cast("int")


def half_of(key: Column) -> Column:
    """Half-year number of a month key."""
    return F.floor(key / 6).cast("int")


def published_half(key: Column) -> Column:
    """The last half-year that ended at least a month before the month of ``key``."""
    return F.floor((key - 7) / 6).cast("int")


def covering_report(ts: Column) -> Column:
    """The next time at or after ``ts`` whose hour is a multiple of three (PF-06)."""
    return plus_hours(ts, F.pmod(F.lit(3) - F.hour(ts) % 3, F.lit(3)))


def iso_weekday(ts: Column) -> Column:
    return (F.weekday(ts) + 1).cast("int")


def yearly_cycle(day_of_year: Column) -> tuple[Column, Column]:
    angle = day_of_year * (2 * pi / 365.25)
    return F.sin(angle), F.cos(angle)


def overlap_weight(k: Column, frac: Column, hours) -> Column:
    """Share of hour k inside [frac, frac + hours) (RB-01)."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.least(k + 1, frac + hours) - F.greatest(k, frac)))


def version_of(model: str, base: Column) -> Column:
    return F.concat(F.lit(f"{model}-fcst"), F.date_format(base, "yyyyMMddHHmm"))
