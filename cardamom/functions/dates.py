"""Date expressions.

Day and year tests are written as half-open ranges on the timestamp itself,
because ``to_date(ts) = x`` and ``year(ts) = x`` do not reach the parquet scan.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardamom.functions.text import _col


def _as_date(day: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def _stamp(moment: dt.date) -> Column:
    # Cast from text so the literal takes no machine time zone on the way.
    if isinstance(moment, dt.datetime):
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(f"{moment.isoformat()} 00:00:00").cast("timestamp_ntz")


def on_day(ts: Column | str, day: dt.date | str) -> Column:
    ts, day = _col(ts), _as_date(day)
    return (ts >= _stamp(day)) & (ts < _stamp(day + dt.timedelta(days=1)))


def in_days(ts: Column | str, days: list[dt.date | str]) -> Column:
    """Timestamp falls on one of the listed days."""
    if not days:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [on_day(ts, d) for d in days])


def in_year(ts: Column | str, year: int) -> Column:
    ts = _col(ts)
    return (ts >= _stamp(dt.date(year, 1, 1))) & (ts < _stamp(dt.date(year + 1, 1, 1)))


def since(ts: Column | str, as_of: dt.datetime, days: int) -> Column:
    """Timestamp is not older than ``days`` before ``as_of``."""
    return _col(ts) >= _stamp(as_of - dt.timedelta(days=days))


def days_before(moment: dt.datetime, days: Column) -> Column:
    """``moment`` minus a per-row number of days."""
    return _stamp(moment) - F.make_dt_interval(days)


def time_of_day(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "HH:mm:ss")


def parse_iso_date(c: Column | str) -> Column:
    """``2024-03-13``"""
    return F.to_date(_col(c), "yyyy-MM-dd")


def parse_month_name_date(c: Column | str) -> Column:
    """``Nov 7, 1985`` or ``Nov 07, 1985``"""
    return F.to_date(_col(c), "MMM d, yyyy")


def parse_short_us_date(c: Column | str, pivot: int = 70) -> Column:
    """``10/30/22``; two-digit years from ``pivot`` on belong to the 1900s.

    Spark reads every two-digit year as 20xx.  The two centuries have their
    leap days in the same two-digit years from 70 to 99, so stepping back
    1200 months keeps the day.
    """
    day = F.to_date(_col(c), "MM/dd/yy")
    return F.when(F.year(day) >= 2000 + pivot, F.add_months(day, -1200)).otherwise(day)
