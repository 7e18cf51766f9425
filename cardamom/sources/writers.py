"""Table writes: create-or-replace, append, partitioned facts, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardamom.session import drop_scratch, shared_dir
from cardamom.sources.partitions import columns_ddl
from cardamom.sources.readers import infer_csv_schema


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a columnar copy and return it as read back."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def create_table_as(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Create or replace a catalog table from a query."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def append_rows(df: DataFrame, path: str) -> None:
    """Insert-select: append to a table, matching its columns by name and type."""
    target = df.sparkSession.read.parquet(path).schema
    df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields]).write.mode(
        "append"
    ).parquet(path)


def write_partitioned_fact(
    df: DataFrame,
    path: str,
    ts: str = "timestamp",
    day: str = "tr_date",
    cluster_by: str = "business_id",
    spread_by: str = "transaction_id",
    mode: str = "overwrite",
    file_bytes: int = 128 << 20,
) -> DataFrame:
    """Write a fact table partitioned by day and clustered inside each day.

    Rows are dealt by day and the input is read once: adaptive execution splits
    a day that turns out larger than ``file_bytes`` over several tasks, by the
    tasks that its rows came from, and lets small days share one.  So a day with
    a third of all rows is several files, small days have one each, and every
    file is sorted by the cluster key, so parquet statistics skip row groups on
    it.  ``mode="append"`` adds the rows of a daily arrival the same way.
    """
    spark = df.sparkSession
    dated = df.withColumn(day, F.to_date(ts))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, file_bytes)
    try:
        (
            dated.hint("rebalance", F.col(day))
            .sortWithinPartitions(day, cluster_by, spread_by)
            .write.mode(mode)
            .partitionBy(day)
            .parquet(path)
        )
    finally:
        spark.conf.set(size, before)
    return read_partitioned(spark, path, dated, day)


def read_partitioned(spark: SparkSession, path: str, like: DataFrame, by: str) -> DataFrame:
    """A partitioned table with a known schema: nothing is inferred, the partition column comes last."""
    schema = StructType([f for f in like.schema.fields if f.name != by] + [like.schema[by]])
    return spark.read.schema(schema).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: str) -> None:
    """Replace only the partitions that ``df`` has rows for.

    The job commits new files before old ones go, and running it again gives
    the same result.  Partitions without rows in ``df`` stay as they are.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a session view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """CSV that :func:`cardamom.sources.read_csv` reads back."""
    writer = df.write.mode("overwrite").option("header", header).option("sep", sep)
    writer.option("quote", '"').option("escape", '"').csv(path)


def export_csv(df: DataFrame, path: str, order: Sequence[Column], sep: str = ";") -> None:
    """Ordered report as CSV.

    The sorted partitions are written in parallel without headers; file names
    follow the order.  The header is a file of its own that sorts before them,
    so the files read one after the other are the report with one header.
    """
    write_csv(df.orderBy(*order), path, sep=sep, header=False)
    names = df.sparkSession.createDataFrame([tuple(df.columns)], ", ".join(f"`{c}` string" for c in df.columns))
    place = shared_dir(df.sparkSession, "header")
    write_csv(names.coalesce(1), place, sep=sep, header=False)
    move_part(df.sparkSession, place, f"{path}/header.csv")
    drop_scratch(df.sparkSession, place)


def move_part(spark: SparkSession, folder: str, target: str) -> None:
    """Give the only part file of a folder a name of its own."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(folder)
    files = source.getFileSystem(conf).globStatus(jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*"))
    jvm.org.apache.hadoop.fs.FileUtil.copy(
        source.getFileSystem(conf), files[0].getPath(), jvm.org.apache.hadoop.fs.Path(target).getFileSystem(conf), jvm.org.apache.hadoop.fs.Path(target), True, conf
    )


def external_csv_table(spark: SparkSession, table: str, path: str, schema: str | StructType | None = None, sep: str = ",") -> DataFrame:
    """A catalog table over CSV files that stay where they are; dropping it leaves them.

    Without a ``schema`` the types are found from all values, in one pass over
    the files, and declared.
    """
    if schema is None:
        schema = infer_csv_schema(spark, path, sep)
    if isinstance(schema, StructType):
        schema = columns_ddl(schema)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    options = f"header 'true', sep '{sep}', quote '\"', escape '\"', mode 'FAILFAST'"
    spark.sql(f"CREATE TABLE {table} ({schema}) USING csv OPTIONS ({options}) LOCATION '{path}'")
    return spark.table(table)
