"""Dates and times. Timestamps are zone-less; the clock is always passed in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col

Moment = str | dt.date | dt.datetime | None


def settled(moment: Moment) -> Moment:
    """The moment itself, or the wall clock read once (UTC), for everything a run does."""
    return moment if moment is not None else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ", timespec="seconds")


def ntz(moment: Moment) -> Column:
    """Timestamp literal; None means the wall clock of the query."""
    if moment is None:
        return F.localtimestamp()
    text = moment if isinstance(moment, str) else moment.isoformat()
    return F.lit(text).cast("timestamp_ntz")


def day(moment: Moment) -> Column:
    """Date literal; None means today."""
    if moment is None:
        return F.current_date()
    text = moment if isinstance(moment, str) else moment.isoformat()
    return F.lit(text[:10]).cast("date")


def as_python_date(moment: Moment) -> dt.date:
    if moment is None:
        return dt.datetime.now(dt.timezone.utc).date()
    if isinstance(moment, dt.datetime):
        return moment.date()
    if isinstance(moment, dt.date):
        return moment
    return dt.date.fromisoformat(moment[:10])


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as an integer, by arithmetic rather than formatting."""
    d = col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("long")


def month_of(c: Column | str) -> Column:
    return F.trunc(col(c), "month")


def month_diff(later: Column | str, earlier: Column | str) -> Column:
    """Calendar month boundaries crossed (31 January to 1 February counts 1)."""
    def index(c):
        return F.year(c) * 12 + F.month(c)
    return (index(col(later)) - index(col(earlier))).cast("long")


def age_days(c: Column | str, as_of: Moment) -> Column:
    return F.datediff(day(as_of), col(c)).cast("long")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from start to end, cut toward zero."""
    gap = col(end).cast("timestamp_ntz") - col(start).cast("timestamp_ntz")

    def part(unit):
        return F.extract(F.lit(unit), gap).cast("long")
    return part("DAY") * 1440 + part("HOUR") * 60 + part("MINUTE")


def hours_between(start: Column | str, end: Column | str) -> Column:
    from .numbers import rnd
    return rnd(minutes_between(start, end) / F.lit(60.0), 2)


def week_from_sunday(c: Column | str) -> Column:
    """Week number 0..53, weeks beginning on Sunday."""
    d = col(c)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("long")
