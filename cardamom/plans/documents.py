"""JSON text columns to flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def flatten_json(
    df: DataFrame, column: str, schema: str | DataType, fields: dict[str, str]
) -> DataFrame:
    """Parse a JSON text column and lift the named paths to columns.

    ``fields`` maps a new column to a path below the document, e.g.
    ``{"session_id": "_id.`$oid`"}``.
    """
    parsed = df.withColumn("_doc", F.from_json(column, schema))
    lifted = {name: F.col(f"_doc.{path}") for name, path in fields.items()}
    return parsed.withColumns(lifted).drop("_doc", column)
