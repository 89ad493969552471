"""Time expressions over wall-clock timestamps, independent of the session time zone."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86400


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hour_start(ts: Column | str) -> Column:
    """The full hour a time falls in, as a zone-free timestamp.

    ``date_trunc`` returns a zoned timestamp even for zone-free input, so a session zone with
    daylight saving would shift hours; date plus hour does not.
    """
    ts = _col(ts)
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def month_start(ts: Column | str) -> Column:
    """Midnight of the first of the month, as a zone-free timestamp."""
    return month_date(ts).cast("timestamp_ntz")


def month_date(ts: Column | str) -> Column:
    """The first of the month as a date."""
    return F.trunc(F.to_date(_col(ts)), "MM")


def _elapsed(start: Column | str, end: Column | str) -> Column:
    return _col(end).cast("timestamp_ntz") - _col(start).cast("timestamp_ntz")


def duration_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole elapsed seconds, negative when the end precedes the start."""
    return _elapsed(start, end).cast("interval second").cast("bigint")


def seconds_of_day(start: Column | str, end: Column | str) -> Column:
    """The seconds part of a time difference: whole days are dropped, negatives wrap.

    A difference of 25 hours gives 3600, one of -5 seconds gives 86395.
    """
    whole = duration_seconds(start, end)
    behind = _elapsed(start, end) < whole * F.expr("INTERVAL '1' SECOND")
    floored = whole - F.when(behind, F.lit(1)).otherwise(F.lit(0))
    return F.pmod(floored, F.lit(SECONDS_PER_DAY)).cast("int")


def seconds_of_day_udf(start: Column | str, end: Column | str) -> Column:
    """:func:`seconds_of_day` as a batch function: where a caller's own logic would go.

    The inner function travels to the tasks by value, so they need no copy of this package.
    """
    def seconds(start: pd.Series, end: pd.Series) -> pd.Series:
        return (end - start).dt.seconds.astype("Int32")

    return F.pandas_udf(seconds, T.IntegerType())(start, end)


def in_years(ts: Column | str, first: int, last: int) -> Column:
    """Time from one year to another, both included.

    A range reaches the file scan, which ``year(ts) = n`` does not.
    """
    ts = _col(ts)
    return (ts >= F.lit(f"{first:04d}-01-01").cast("timestamp_ntz")) & (
        ts < F.lit(f"{last + 1:04d}-01-01").cast("timestamp_ntz")
    )


def in_year(ts: Column | str, year: int) -> Column:
    return in_years(ts, year, year)


def on_day(ts: Column | str, day: str) -> Column:
    return F.to_date(_col(ts)) == F.lit(day).cast("date")


def days_between(ts: Column | str, first: str, last: str) -> Column:
    """Both days included, the last one to its end."""
    return F.to_date(_col(ts)).between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def moments_between(ts: Column | str, first: str, last: str) -> Column:
    """Plain timestamp bounds: of the last day only midnight is included."""
    return _col(ts).between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))
