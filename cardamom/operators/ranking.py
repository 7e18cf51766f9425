"""Top-k and row numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; Spark keeps k rows per task and merges them."""
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, k: int = 10) -> DataFrame:
    """Any ``k`` rows, in no particular order."""
    return df.limit(k)


def nth_row(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The n-th row (from 1) in the given order; empty when out of range."""
    if n < 1:
        return df.limit(0)
    return df.orderBy(*order).offset(n - 1).limit(1)


def number_rows(df: DataFrame, order: Sequence[Column], key: str, name: str = "position") -> DataFrame:
    """Number all rows 1, 2, 3, … in the given order, for reports of any size.

    ``row_number`` over an unpartitioned window would send the whole report
    through one task.  Instead the columns of ``order`` alone, among them the
    unique column ``key``, are dealt by ranges and sorted inside each; a row's
    number is its place in its range and the number of rows in the ranges
    before, and is joined back to the row by ``key``.  Nothing is run or written
    before the result is asked for.

    Both sides of the sum read the same exchange.  Should they not, because a
    session forbids that, a range's rows are not as many as were counted, which
    stops the job; numbers cannot come out wrong.  The offsets table has one
    row per range, so its broadcast is bounded by the number of ranges.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        df.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .select(
            F.col(key).alias("_key"),
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"),
        )
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_part").agg(F.count("_key").alias("_n"))
    offsets = counts.select("_part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = dealt.join(F.broadcast(offsets), "_part", "left")
    told = F.when(F.col("_at") < F.col("_n"), F.col("_before") + F.col("_at") + 1)
    number = F.coalesce(told, F.raise_error(F.lit("ranges were dealt twice")).cast("bigint"))
    return df.join(joined.select(F.col("_key").alias(key), number.alias(name)), key)
