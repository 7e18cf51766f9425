"""Window operators.

Ties in the given order are settled by the caller's extra order columns, so a
re-run of a lost task ranks rows the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rn"
) -> DataFrame:
    """The first ``n`` rows of every key in ``order``, numbered from 1.

    Filtering the row number right here lets Spark keep only ``n`` rows per
    key in each map task (WindowGroupLimit), so a hot key is cut down before
    the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def previous_value(series: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Value of the row before, over a whole daily series.

    A window without partitions runs in one task.  ``series`` must hold one
    row per calendar day, which bounds it (a century is 36,525 rows) however
    large the table was that it sums up.
    """
    return series.withColumn(name, F.lag(value, 1).over(Window.orderBy(order)))


def running_total(
    df: DataFrame, partition: Sequence[Column | str], order: str, value: str, name: str
) -> DataFrame:
    """Running sum inside each partition, row by row."""
    w = (
        Window.partitionBy(*partition)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(name, F.sum(value).over(w))


def group_mean(
    df: DataFrame, keys: Sequence[str], value: Column, name: str, scale: int = 2
) -> DataFrame:
    """Mean over all rows of the key, beside every row.

    For groups already cut down by :func:`first_n_per_key`.
    """
    mean = F.avg(value).over(Window.partitionBy(*keys))
    return df.withColumn(name, F.round(mean, scale).cast("double"))
