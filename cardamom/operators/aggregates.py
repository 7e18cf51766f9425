"""Aggregations that add up per key before anything is joined.

``sum`` and ``count`` combine on the map side, so a key that holds a third of
all rows reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions import exact_sum


def per_key_totals(
    df: DataFrame, keys: Sequence[str | Column], amount: str = "amount"
) -> DataFrame:
    """Exact ``total`` (decimal) and ``n`` per key, ready to be averaged or added up again."""
    return df.groupBy(*keys).agg(exact_sum(amount).alias("total"), F.count(amount).alias("n"))


def daily_totals(df: DataFrame, ts: str = "timestamp", amount: str = "amount") -> DataFrame:
    """Exact amount total per calendar day: columns ``day`` and ``sales`` (decimal)."""
    return df.groupBy(F.to_date(ts).alias("day")).agg(exact_sum(amount).alias("sales"))


def top_row(df: DataFrame, by: Sequence[Column]) -> DataFrame:
    """The first row in the given order, found without sorting the table."""
    return df.orderBy(*by).limit(1)


def last_value_row(df: DataFrame, seq: str) -> DataFrame:
    """The row inserted last."""
    return top_row(df, [F.col(seq).desc()])
