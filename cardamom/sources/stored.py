"""Stored catalog tables: inserts that check declared keys, and changes of columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.schemas import FOREIGN_KEYS, PRIMARY_KEYS


class KeyViolation(ValueError):
    """Rows that an insert must not add."""


def _among(stored: DataFrame, keys: Sequence[str], new: DataFrame, new_keys: Sequence[str]) -> DataFrame:
    """The keys of ``new`` that the stored table has; the stored side is only scanned, as long as the new one is small."""
    wanted = new.select(*(F.col(n).alias(f"_{i}") for i, n in enumerate(new_keys))).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).cast("string") == F.col(f"_{i}").cast("string") for i, k in enumerate(keys)])
    found = stored.select(*keys).join(wanted, same, "left_semi").distinct()
    return found.select(*(F.col(k).cast("string").alias(f"_{i}") for i, k in enumerate(keys)))


def broken_keys(spark: SparkSession, names: Mapping[str, str], table: str, new: DataFrame) -> list[str]:
    """What is wrong with rows that are to be added to ``table``; nothing, if they fit.

    ``names`` gives the catalog name of each declared table that is stored.
    """
    wrong = []
    key = PRIMARY_KEYS.get(table, [])
    if key:
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
        if not new.where(missing).isEmpty():
            wrong.append(f"{table}: no {', '.join(key)}")
        if not new.where(~missing).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            wrong.append(f"{table}: {', '.join(key)} twice among the new rows")
        if not _among(spark.table(names[table]), key, new, key).isEmpty():
            wrong.append(f"{table}: {', '.join(key)} is there already")
    for child, column, parent, parent_key in FOREIGN_KEYS:
        if child == table and parent in names:
            given = new.where(F.col(column).isNotNull())
            known = _among(spark.table(names[parent]), [parent_key], given, [column])
            lost = given.select(F.col(column).cast("string").alias("_0")).join(known, "_0", "left_anti")
            if not lost.isEmpty():
                wrong.append(f"{table}: {column} not in {parent}")
    return wrong


def insert_checked(spark: SparkSession, names: Mapping[str, str], table: str, new: DataFrame) -> None:
    """Append rows to a stored table if they keep its declared keys, else raise :class:`KeyViolation` and add none.

    Columns that ``new`` lacks are NULL; values are cast to the stored types.
    Parents are added before their children, in calls of their own.
    """
    schema = spark.table(names[table]).schema
    unknown = set(new.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"no such column: {sorted(unknown)}")
    have = set(new.columns)
    rows = new.select(*((F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))
    wrong = broken_keys(spark, names, table, rows)
    if wrong:
        raise KeyViolation("; ".join(wrong))
    rows.write.insertInto(names[table])


def change_columns(spark: SparkSession, table: str, change: Callable[[DataFrame], DataFrame], by: str | None = None) -> DataFrame:
    """Replace a stored table by what ``change`` makes of it: columns retyped, dropped, added.

    The new table is written beside the old one, which stays as it is until the
    two change names; that moves no rows.  ``by`` is its partition column.  The
    table must be the catalog's own, not one over files that lie elsewhere.
    """
    new, old = f"{table}__new", f"{table}__old"
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    writer = change(spark.table(table)).write.format("parquet")
    (writer.partitionBy(by) if by else writer).saveAsTable(new)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")
    return spark.table(table)
