"""Updates, deletes and column changes as copy-on-write.

Files are never changed in place: every function returns the table as it
should be, and the caller writes it (see ``cardamom.sources.writers``).
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def set_where(df: DataFrame, cond: Column, values: Mapping[str, Any]) -> DataFrame:
    """Set columns on the rows where ``cond`` is true; NULL counts as false."""
    new = {}
    for name, value in values.items():
        value = value if isinstance(value, Column) else F.lit(value)
        new[name] = F.when(cond, value.cast(df.schema[name].dataType)).otherwise(F.col(name))
    return df.withColumns(new)


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Drop rows where ``cond`` is true; rows where it is NULL stay."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def insert_rows(df: DataFrame, rows: list[Mapping[str, Any]]) -> DataFrame:
    """Append literal rows; values are cast to the column type, absent ones NULL."""
    unknown = {k for r in rows for k in r} - set(df.columns)
    if unknown:
        raise ValueError(f"no such column: {sorted(unknown)}")
    if not rows:
        return df
    # Of one column the values may be of several Python types; all are cast from text.
    text = [tuple(None if r.get(c) is None else _text(r[c]) for c in df.columns) for r in rows]
    fields = ", ".join(f"`{c}` string" for c in df.columns)
    new = df.sparkSession.createDataFrame(text, fields)
    return df.unionByName(new.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in df.schema.fields]))


def _text(value: Any) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def retype(df: DataFrame, types: Mapping[str, str | Column]) -> DataFrame:
    """Change column types: a type name casts, an expression replaces."""
    return df.withColumns(
        {c: t if isinstance(t, Column) else F.col(c).cast(t) for c, t in types.items()}
    )


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    absent = set(names) - set(df.columns)
    if absent:
        raise ValueError(f"no such column: {sorted(absent)}")
    return df.drop(*names)


def create_empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table with the given schema."""
    return spark.createDataFrame([], schema)
