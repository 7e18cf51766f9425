"""Daily sales and the series built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.functions import pct_change
from cardamom.operators import daily_totals, previous_value, running_total
from cardamom.plans.sales import sold


def daily_sales(tx: DataFrame) -> DataFrame:
    """Accepted sales per day, exact: ``day``, ``sales`` decimal."""
    return daily_totals(sold(tx))


def daily_report(daily: DataFrame) -> DataFrame:
    return daily.select("day", F.round("sales", 2).cast("double").alias("sales")).orderBy(
        F.col("day").desc()
    )


def day_over_day(daily: DataFrame) -> DataFrame:
    """Today, the previous day on record and the change in percent."""
    series = previous_value(daily, "day", "sales", "before")
    # Adding 0.0 turns a rounded negative zero into zero.
    change = F.round(pct_change(F.col("sales").cast("double"), F.col("before").cast("double")), 2)
    return series.select(
        "day",
        F.round("sales", 2).cast("double").alias("today"),
        F.round("before", 2).cast("double").alias("yesterday"),
        (change + F.lit(0.0)).alias("diff_pct"),
    ).orderBy("day")


def year_to_date(daily: DataFrame) -> DataFrame:
    """Today and the running total since 1 January."""
    series = running_total(daily, [F.year("day")], "day", "sales", "ytd")
    return series.select(
        "day",
        F.round("sales", 2).cast("double").alias("today"),
        F.round("ytd", 2).cast("double").alias("ytd"),
    ).orderBy("day")
