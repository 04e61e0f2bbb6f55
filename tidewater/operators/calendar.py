"""Calendar dimension: generated days with their attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater import config as C
from tidewater.functions import (date_key, day_name_padded, day_of_week0, is_weekend,
                                 iso_week, month_name_padded)

CALENDAR_COLS = ["date_key", "date", "year", "quarter", "month", "month_name", "week",
                 "day_of_month", "day_of_week", "day_name", "is_weekend", "is_holiday"]


def calendar_attributes(d: Column) -> list[Column]:
    return [date_key(d).alias("date_key"), d.alias("date"), F.year(d).alias("year"),
            F.quarter(d).alias("quarter"), F.month(d).alias("month"),
            month_name_padded(d).alias("month_name"), iso_week(d).alias("week"),
            F.dayofmonth(d).alias("day_of_month"), day_of_week0(d).alias("day_of_week"),
            day_name_padded(d).alias("day_name"), is_weekend(d).alias("is_weekend"),
            F.lit(False).alias("is_holiday")]


def calendar_between(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day from ``start`` to ``end`` (both included) of each bounds row."""
    days = bounds.select(F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"),
                                              F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_attributes(F.col("d")))


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    return calendar_between(bounds)


def run_window(today: dt.date) -> tuple[dt.date, dt.date]:
    """``generate_series(today - 2 years, today + 1 year, 1 day)``."""
    def shift(d: dt.date, years: int) -> dt.date:
        try:
            return d.replace(year=d.year + years)
        except ValueError:  # 29 February -> 28 February, as interval arithmetic does
            return d.replace(year=d.year + years, day=28)
    return shift(today, -C.CALENDAR_YEARS_BACK), shift(today, C.CALENDAR_YEARS_AHEAD)
