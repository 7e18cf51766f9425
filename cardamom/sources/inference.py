"""Column types of text tables, found in one pass.

Every column keeps, for each type, whether all its values so far are of that
type; these flags are combined by AND, so they are added up in the map tasks
and can be observed while the rows are on their way to somewhere else.  The
type of a column is then the narrowest that fits all values: int, bigint, a
decimal without fraction, double, date, timestamp, boolean, else text.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StringType, StructField, StructType

_DIGITS = r"\A[+-]?[0-9]+\z"
_DAY = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
_MOMENT = r"\A[0-9]{4}-[0-9]{1,2}(-[0-9]{1,2}([ T].*)?)?\z"
# From narrow to wide; the second column is the SQL type.
_KINDS = [("int", "int"), ("long", "bigint"), ("whole", ""), ("double", "double"), ("day", "date"), ("moment", "timestamp"), ("flag", "boolean")]


def _tests(text: Column) -> dict[str, Column]:
    whole = text.rlike(_DIGITS)
    return {
        "int": whole & text.try_cast("int").isNotNull(),
        "long": whole & text.try_cast("bigint").isNotNull(),
        "whole": whole & (F.length(F.regexp_replace(text, r"\A[+-]?0*", "")) <= 38),
        "double": text.try_cast("double").isNotNull(),
        "day": text.rlike(_DAY) & text.try_cast("date").isNotNull(),
        "moment": text.rlike(_MOMENT) & text.try_cast("timestamp").isNotNull(),
        "flag": F.lower(text).isin("true", "false"),
    }


def _present(df: DataFrame, name: str) -> Column:
    """A text, where there is one: nothing between two separators is no value."""
    return F.nullif(df["`" + name.replace("`", "``") + "`"], F.lit(""))


def type_flags(df: DataFrame) -> list[Column]:
    """Aggregates over a table of texts; :func:`types_from` reads them."""
    out = []
    for i, name in enumerate(df.columns):
        text = _present(df, name)
        for kind, test in _tests(text).items():
            out.append(F.bool_and(F.when(text.isNotNull(), test)).alias(f"{kind}_{i}"))
        out.append(F.max(F.length(F.regexp_replace(F.when(text.rlike(_DIGITS), text), r"\A[+-]?0*", ""))).alias(f"digits_{i}"))
    return out


def types_from(flags: Mapping[str, Any], names: list[str]) -> StructType:
    """The schema that the flags stand for.  A column without values is text."""
    fields = []
    for i, name in enumerate(names):
        kind: DataType = StringType()
        for flag, sql in _KINDS:
            if flags[f"{flag}_{i}"]:
                kind = StructType.fromDDL(f"x {sql}")[0].dataType if sql else DecimalType(flags[f"digits_{i}"], 0)
                break
        fields.append(StructField(name, kind))
    return StructType(fields)


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """A table of texts with the types of ``schema``, column by column."""
    columns = []
    for name, field in zip(df.columns, schema.fields):
        text = isinstance(field.dataType, StringType)
        columns.append((df["`" + name.replace("`", "``") + "`"] if text else _present(df, name).cast(field.dataType)).alias(field.name))
    return df.select(*columns)
