"""The materialized daily-sales table and its upkeep.

Stored with one partition per day, rows without a day being one of them.  A
day's row is a state: the exact sum and number of its accepted sales, and which
files of the fact table they come from (a hash of each file's name).  Sums of
new files are added to it, and a file that it knows already is passed over, so
merging again, or again after a lost job, changes nothing.  Days are recomputed
from the fact table only where a rewrite changed or removed files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.functions import exact_sum
from cardamom.session import scratch_space
from cardamom.sources import of_partitions, overwrite_partitions

STATE = "sales decimal(34,6), n bigint, files array<bigint>, day date"


def _by_file(fact: DataFrame) -> DataFrame:
    """Accepted sales by day and file: ``day``, ``file``, ``sales`` and ``n``.

    Files without accepted sales are listed too.
    """
    accepted = F.when(~F.col("declined"), F.col("amount"))
    return (
        fact.withColumn("_accepted", accepted)
        .groupBy(F.col("tr_date").alias("day"), F.col("_file").alias("file"))
        .agg(exact_sum("_accepted").alias("sales"), F.count_if(~F.col("declined")).alias("n"))
    )


def with_file(fact: DataFrame) -> DataFrame:
    """The columns that sums need, and a hash of the file each row is from."""
    return fact.select("tr_date", "amount", "declined", F.xxhash64("_metadata.file_name").alias("_file"))


def _states(parts: DataFrame) -> DataFrame:
    """One state per day from partial ones (``files`` are lists of disjoint files)."""
    return parts.groupBy("day").agg(
        F.sum("sales").cast("decimal(34,6)").alias("sales"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        # As many as a day has files.
        F.flatten(F.collect_list("files")).alias("files"),
    )


def _stored(states: DataFrame) -> DataFrame:
    return states.select("sales", "n", "files", "day")


def build_daily_table(spark: SparkSession, fact_path: str, table_path: str) -> None:
    """Compute every day."""
    sums = _by_file(with_file(spark.read.parquet(fact_path)))
    states = _states(sums.withColumn("files", F.array("file")))
    # A row for each day: one range of days per task, one file per day.
    _stored(states).repartitionByRange("day").write.mode("overwrite").partitionBy("day").parquet(table_path)


def _state_table(spark: SparkSession, table_path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(table_path)


def merge_files(spark: SparkSession, table_path: str, rows: DataFrame) -> None:
    """Add the sales of new files (rows as :func:`with_file` gives them) to the days they fall on.

    Reads these rows and the states of their days.  Files that a day's state
    has counted already add nothing.
    """
    state = _state_table(spark, table_path)
    with scratch_space(spark) as keep:
        sums = keep(_by_file(rows), "sums")
        old = of_partitions(state, sums.select("day").distinct(), "day")
        known = old.select(F.col("day").alias("_day"), F.explode("files").alias("_known"))
        same = (F.col("file") == F.col("_known")) & F.col("day").eqNullSafe(F.col("_day"))
        new = sums.join(known, same, "left_anti").withColumn("files", F.array("file")).drop("file")
        merged = keep(_stored(_states(old.select(new.columns).unionByName(new))), "states")
        overwrite_partitions(merged, table_path, "day")


def refresh_daily_table(
    spark: SparkSession, fact_path: str, table_path: str, changed: DataFrame
) -> None:
    """Recompute the days listed in ``changed`` (column ``tr_date``), NULL among them.

    For days whose files a rewrite replaced: pass what ``rewrite_partitions``
    returns.  The list of days never becomes a driver-side filter: it is joined
    to the fact's partition column, and dynamic partition pruning opens those
    days only.  A day without sales any more is stored with none, in place of
    its old total.
    """
    with scratch_space(spark) as keep:
        days = keep(changed.select("tr_date").distinct(), "days")
        fact = with_file(spark.read.parquet(fact_path))
        sums = _by_file(of_partitions(fact, days, "tr_date")).withColumn("files", F.array("file")).drop("file")
        none = F.expr("cast(null as decimal(34,6))").alias("sales"), F.lit(0).cast("bigint").alias("n")
        empty = days.select(F.col("tr_date").alias("day"), *none, F.expr("cast(array() as array<bigint>)").alias("files"))
        states = keep(_stored(_states(sums.unionByName(empty))), "states")
        overwrite_partitions(states, table_path, "day")


def read_daily_table(spark: SparkSession, table_path: str) -> DataFrame:
    """``day``, ``sales``; days without sales are left out."""
    return _state_table(spark, table_path).filter("n > 0").select("day", "sales")
