"""Updates and deletes on stored partitioned tables, through the session catalog.

A table is a catalog table, or a folder that is entered into the catalog for as
long as a rewrite takes.  Partitions are named by their values, never by folder
names: the catalog knows which folder holds the partition of a value that has
colons, slashes or percent signs in it.  An empty text is stored as NULL, as
Spark's partition folders know no difference.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardamom.session import delete_path, path_exists, scratch, scratch_space

# A rewrite keeps what it is about to do in this folder of the table; readers pass over names like it.
JOURNAL = "_rewrite"


def _literal(value: Any) -> str:
    """A partition value as SQL; the catalog casts the text to the column's type."""
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(by: str, value: Any) -> str:
    return f"PARTITION (`{by}` = {_literal(value)})"


def columns_ddl(schema: StructType) -> str:
    """Names and types as SQL declares them."""
    quoted = ((f.name.replace("`", "``"), f.dataType.simpleString()) for f in schema.fields)
    return ", ".join(f"`{name}` {kind}" for name, kind in quoted)


def create_partitioned_table(df: DataFrame, table: str, by: str, path: str | None = None) -> DataFrame:
    """Create or replace a catalog table with a partition for each value of ``by``."""
    writer = df.write.mode("overwrite").format("parquet").partitionBy(by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


@contextmanager
def as_table(spark: SparkSession, path: str, by: str, schema: StructType | None = None) -> Iterator[str]:
    """Enter a partitioned folder into the catalog under a name of its own; the files stay when it goes.

    Without a ``schema`` types are taken from the files and folder names, so
    text partitions that look like numbers need one.
    """
    schema = schema or spark.read.parquet(path).schema
    name = f"cardamom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns_ddl(schema)}) USING parquet PARTITIONED BY (`{by}`) LOCATION '{_literal(path)[1:-1]}'")
    try:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _described(spark: SparkSession, table: str, spec: str = "") -> dict[str, str]:
    out: dict[str, str] = {}
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").collect():
        out.setdefault(row["col_name"], row["data_type"])
    return out


def drop_partition(spark: SparkSession, table: str, by: str, value: Any) -> None:
    """Remove a partition and its files; one that is not there is no error."""
    if not spark.sql(f"SHOW PARTITIONS {table} {_spec(by, value)}").isEmpty():
        place = _described(spark, table, _spec(by, value))["Location"]
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec(by, value)}")
        delete_path(spark, place)  # dropping leaves the files of a table that is not the catalog's own


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that ``df`` has rows for, and enter new ones into the catalog."""
    spark = df.sparkSession
    with _dynamic_overwrite(spark):
        df.select(*(F.col(f"`{c}`") for c in spark.table(table).columns)).write.insertInto(table, overwrite=True)


def finish_rewrite(spark: SparkSession, table: str, by: str) -> bool:
    """Carry out a rewrite that was interrupted in its last step; False if there is none.

    Both parts of that step give the same table however often they run.
    """
    place = _described(spark, table)["Location"]
    if not path_exists(spark, f"{place}/{JOURNAL}/emptied/_SUCCESS"):
        return False
    schema = spark.table(table).schema
    replace_partitions(spark.read.schema(schema).parquet(f"{place}/{JOURNAL}/staged"), table)
    emptied = spark.read.schema(StructType([schema[by]])).parquet(f"{place}/{JOURNAL}/emptied")
    for row in emptied.toLocalIterator():
        drop_partition(spark, table, by, row[0])
    delete_path(spark, f"{place}/{JOURNAL}")
    spark.catalog.refreshTable(table)
    return True


def rewrite_table(
    spark: SparkSession,
    table: str,
    by: str,
    where: Column,
    change: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Update or delete rows of a partitioned catalog table, rewriting the least of it.

    ``change`` gets the whole content of the partitions (column ``by``) that
    have a row matching ``where``, and returns what should become of those rows.
    They may move to other partitions, whose rows stay.  Returns the touched
    partition values (one column, ``by``), emptied ones included.

    The new content of all partitions concerned, and the list of those that are
    left empty, are written to the table's journal first; only a whole journal
    is carried out.  So a failure before that leaves the table as it was, and
    one after it is mended by :func:`finish_rewrite`, which every rewrite calls
    first.  Rows without a partition value are matched like any other.  The
    values of emptied partitions reach the driver one at a time, no others do.
    """
    finish_rewrite(spark, table, by)
    stored = spark.table(table)
    journal = f"{_described(spark, table)['Location']}/{JOURNAL}"
    with scratch_space(spark) as keep:
        hit = keep(stored.filter(where).select(by).distinct(), "hit")
        change(of_partitions(stored, hit, by)).select(stored.columns).write.mode("overwrite").parquet(f"{journal}/staged")
        landed = keep(spark.read.schema(stored.schema).parquet(f"{journal}/staged").select(by).distinct(), "landed")
        others = _minus(landed, hit, by)
        if not others.isEmpty():
            of_partitions(stored, keep(others, "others"), by).write.mode("append").parquet(f"{journal}/staged")
        touched = scratch(hit.unionByName(landed).distinct(), "touched")
        _minus(hit, landed, by).write.mode("overwrite").parquet(f"{journal}/emptied")
        finish_rewrite(spark, table, by)
    return touched


def rewrite_partitions(
    spark: SparkSession,
    path: str,
    by: str,
    where: Column,
    change: Callable[[DataFrame], DataFrame],
    schema: StructType | None = None,
) -> DataFrame:
    """:func:`rewrite_table` on a partitioned folder (see :func:`as_table` for ``schema``)."""
    with as_table(spark, path, by, schema) as table:
        return rewrite_table(spark, table, by, where, change)


def _minus(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    return a.alias("a").join(b.alias("b"), F.col(f"a.{by}").eqNullSafe(F.col(f"b.{by}")), "left_anti").select(f"a.{by}")


def of_partitions(table: DataFrame, values: DataFrame, by: str) -> DataFrame:
    """The rows of some partitions.

    An equality join lets Spark prune partitions while it runs, which it does
    for a side with a filter that may be selective; this one is true for every
    value.  Rows without a value are a partition of their own, read only if it
    is asked for.
    """
    any_value = F.col(by).cast("string") >= F.lit("")
    some = table.filter(F.col(by).isNotNull()).join(values.filter(any_value), by, "left_semi")
    asked = values.filter(F.col(by).isNull()).limit(1).select(F.lit(1).alias("_asked"))
    none = table.filter(F.col(by).isNull()).withColumn("_one", F.lit(1))
    return some.select(table.columns).unionByName(none.join(asked, F.col("_one") == F.col("_asked"), "left_semi").select(table.columns))
