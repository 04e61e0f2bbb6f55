"""Date and time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value: str | dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal, independent of the session time zone."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def date_key(c: Column) -> Column:
    """YYYYMMDD as an int (``TO_CHAR(d, 'YYYYMMDD')::INTEGER``)."""
    d = F.to_date(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def day_of_week0(c: Column) -> Column:
    """``EXTRACT(DOW)``: 0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(c) - 1).cast("int")


def iso_week(c: Column) -> Column:
    """``EXTRACT(WEEK)``: ISO 8601 week number."""
    return F.weekofyear(c).cast("int")


def is_weekend(c: Column) -> Column:
    return F.dayofweek(c).isin(1, 7)


def month_name_padded(c: Column) -> Column:
    """``TO_CHAR(d, 'Month')``: English name blank-padded to 9."""
    return F.rpad(F.date_format(c, "MMMM"), 9, " ")


def day_name_padded(c: Column) -> Column:
    """``TO_CHAR(d, 'Day')``: English name blank-padded to 9."""
    return F.rpad(F.date_format(c, "EEEE"), 9, " ")


def month_start(c: Column) -> Column:
    """``DATE_TRUNC('month', x)::DATE``."""
    return F.trunc(F.to_date(c), "MM")
