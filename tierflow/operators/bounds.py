"""Ingest windows, month windows and high-water marks."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import LOCAL_ZONE

# Fixed value: how far a first incremental load looks back.
LOOK_BACK = timedelta(days=3)

Moment = str | date | datetime


@dataclass(frozen=True)
class Window:
    """Inclusive bounds of a load, in UTC. Only scheduled loads move the mark."""

    lo: datetime
    hi: datetime
    scheduled: bool = True


def utc(value: Moment) -> datetime:
    """`yyyy-MM-dd`, `yyyyMMdd`, ISO text, date or datetime as a UTC instant.

    A bare date means its midnight, so a back-fill that ends on a date covers
    of that date only 00:00:00.
    """
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    elif not isinstance(value, datetime):
        value = datetime.combine(value, time())
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def ingest_window(
    backfill: tuple[Moment, Moment] | None = None,
    mark: Moment | None = None,
    end: Moment | None = None,
    now: Moment | None = None,
    look_back: timedelta = LOOK_BACK,
) -> Window:
    """Bounds of the next load.

    A back-fill uses the dates it is given. A scheduled load ends at the
    configured `end` or now, and starts at the mark, or `look_back` earlier
    when there is no mark yet.
    """
    if backfill is not None:
        first, last = backfill
        return Window(utc(first), utc(last), scheduled=False)
    hi = utc(end or now or datetime.now(timezone.utc))
    lo = utc(mark) if mark else hi - look_back
    return Window(lo, hi)


def next_mark(window: Window) -> datetime:
    """Where the load after `window` starts: midnight of the day it ended on.

    The overlap re-reads that day, so rows that reach the source late on the
    same day are not lost; silver drops what it already has.
    """
    return datetime.combine(window.hi.date(), time(), timezone.utc)


def literal(value: datetime) -> str:
    """A bound as `yyyy-MM-dd HH:mm:ss+00:00` text."""
    return str(value)


def month_window(day: Moment | None = None, now: Moment | None = None) -> tuple[str, str]:
    """First and last date of the month of `day`, or of today in the zone of the
    stored dates (D3)."""
    today = utc(now or datetime.now(timezone.utc)).astimezone(ZoneInfo(LOCAL_ZONE))
    start = (utc(day) if day else today).date()
    last = calendar.monthrange(start.year, start.month)[1]
    return start.replace(day=1).isoformat(), start.replace(day=last).isoformat()


def month_bounds(day: Column) -> tuple[Column, Column]:
    """The same bounds as columns, for whole tables of days (D3)."""
    first = F.date_format(F.trunc(day, "MM"), "yyyy-MM-dd")
    last = F.date_format(F.last_day(day), "yyyy-MM-dd")
    return first, last


def latest_marks(marks: DataFrame) -> DataFrame:
    """The most recent mark of every ingest (K9).

    `marks` holds `ingest, lo, hi, run_ts`. All states have a fixed width, so
    this is a hash aggregation with map-side combine.
    """
    return marks.groupBy("ingest").agg(
        F.max_by("lo", "run_ts").alias("lo"), F.max_by("hi", "run_ts").alias("hi"), F.max("run_ts").alias("run_ts")
    )
