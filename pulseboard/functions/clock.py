"""Time ranges relative to an explicit "as of" moment.

No operator reads the wall clock: a run, a backfill and a test differ only in
the ``as_of`` they pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partition column of logs laid out by day; it is the date of ``time``. The name is reserved:
# a column of another name, such as "day", is a column like any other.
DAY_PARTITION = "log_day"
DAY_MINUTES = 24 * 60


Moment = str | date | datetime


@dataclass(frozen=True)
class Span:
    """Half-open time range [start, end)."""

    start: datetime
    end: datetime

    @property
    def first_day(self) -> date:
        return self.start.date()

    @property
    def last_day(self) -> date:
        return (self.end - timedelta(microseconds=1)).date()

    @property
    def whole_days(self) -> bool:
        return all(t == _midnight(t) for t in (self.start, self.end))


def _moment(as_of: Moment) -> datetime:
    if isinstance(as_of, str):
        return datetime.fromisoformat(as_of)
    if isinstance(as_of, datetime):
        return as_of
    return datetime(as_of.year, as_of.month, as_of.day)


def _midnight(as_of: Moment) -> datetime:
    return _moment(as_of).replace(hour=0, minute=0, second=0, microsecond=0)


def last_days(as_of: Moment, days: int) -> Span:
    """The ``days`` full days before the day of ``as_of``, that day excluded."""
    if days < 1:
        raise ValueError("days must be at least 1")
    end = _midnight(as_of)
    return Span(end - timedelta(days=days), end)


def yesterday(as_of: Moment) -> Span:
    return last_days(as_of, 1)


def history(as_of: Moment) -> Span:
    """Everything before the day of ``as_of``."""
    return Span(datetime.min, _midnight(as_of))


def bucket_minutes(minutes: int) -> int:
    """The width of a bucket, which must divide a day: buckets are counted from the epoch, days
    begin at midnight, and only then no bucket lies in two days."""
    if minutes < 1 or DAY_MINUTES % minutes:
        raise ValueError(f"buckets must divide a day; {minutes} minutes do not")
    return minutes


def closed_buckets(as_of: Moment, minutes: int = 15) -> Span:
    """From yesterday's midnight up to the start of the bucket that is still open."""
    minutes = bucket_minutes(minutes)
    midnight = _midnight(as_of)
    width = timedelta(minutes=minutes)
    done = (_moment(as_of) - midnight) // width
    return Span(midnight - timedelta(days=1), midnight + done * width)


def by_day(log: DataFrame) -> bool:
    """Whether a log is laid out by day."""
    return DAY_PARTITION in log.columns and isinstance(log.schema[DAY_PARTITION].dataType, T.DateType)


def day_of(log: DataFrame) -> Column:
    """The day of each row. A log laid out by day knows it without reading ``time``."""
    return F.col(DAY_PARTITION) if by_day(log) else F.to_date("time")


def rows_in(log: DataFrame, span: Span) -> DataFrame:
    """Rows of ``log`` with ``time`` inside ``span``.

    The bounds are literals of the column's own type, so the comparison reaches
    the Parquet scan without a cast. Of a log laid out by day only the span's
    partitions are read, and for whole days nothing else is compared.
    """
    bounds = []
    dated = by_day(log)
    if dated:
        bounds.append(f"{DAY_PARTITION} <= DATE '{span.last_day}'")
        if span.start != datetime.min:
            bounds.append(f"{DAY_PARTITION} >= DATE '{span.first_day}'")
    if not (dated and span.whole_days):
        kind = log.schema["time"].dataType.simpleString()
        bounds.append(f"time < {kind} '{span.end}'")
        if span.start != datetime.min:
            bounds.append(f"time >= {kind} '{span.start}'")
    return log.where(" AND ".join(bounds))
