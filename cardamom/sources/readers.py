"""File and record sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cardamom.functions import trim_space
from cardamom.schemas import SCHEMAS
from cardamom.session import scratch
from cardamom.sources.inference import type_flags, typed, types_from


# A quote inside a quoted value is written twice, so it is its own escape.
_QUOTES = {"quote": '"', "escape": '"'}
BAD_LINE = "_bad_line"


def _csv(spark: SparkSession, sep: str, header: bool) -> DataFrameReader:
    return spark.read.option("header", header).option("sep", sep).options(**_QUOTES)


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str | StructType | None = None,
    sep: str = ",",
) -> DataFrame:
    """CSV with a header row; several files are read as one table.

    ``schema`` may be a name from :data:`SCHEMAS`; a declared type that does not
    fit fails the job (:func:`read_csv_lines` keeps such lines apart).  Without
    one the types are found from all values: the files are read once, into a
    columnar copy in the shared folder, and the types are observed on the way.
    """
    if schema is None:
        texts = _csv(spark, sep, header=True).csv(_paths(paths))
        seen = Observation("types")
        copy = scratch(texts.observe(seen, *type_flags(texts)), "texts")
        return typed(copy, types_from(seen.get, texts.columns))
    return _csv(spark, sep, header=True).option("mode", "FAILFAST").schema(_named(schema)).csv(_paths(paths))


def _named(schema: str | StructType) -> StructType:
    if isinstance(schema, StructType):
        return schema
    return SCHEMAS[schema] if schema in SCHEMAS else StructType.fromDDL(schema)


def infer_csv_schema(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> StructType:
    """The types of CSV files, from one pass over all of them."""
    texts = _csv(spark, sep, header=True).csv(_paths(paths))
    return types_from(texts.agg(*type_flags(texts)).first().asDict(), texts.columns)


def read_csv_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str | StructType,
    sep: str = ",",
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected): a bad line does not stop the load, and is not lost either.

    A line is bad if it has too few or too many values, or one that does not fit
    its declared type.  ``rejected`` has the ``file`` and the ``line`` as it is
    there.  The files are read once, into a copy in the shared folder that both
    tables come from, so they always belong together.
    """
    wanted = _named(schema)
    full = StructType([*wanted.fields, StructField(BAD_LINE, StringType())])
    reader = _csv(spark, sep, header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
    read = reader.schema(full).csv(_paths(paths))
    copy = scratch(read.select("*", F.col("_metadata.file_path").alias("_file")), "lines")
    rows = copy.filter(F.col(BAD_LINE).isNull()).select(*(F.col(f"`{x}`") for x in wanted.names))
    return rows, copy.filter(F.col(BAD_LINE).isNotNull()).select(F.col("_file").alias("file"), F.col(BAD_LINE).alias("line"))


def read_export(
    spark: SparkSession, path: str, schema: str | StructType, sep: str = ";"
) -> DataFrame:
    """The rows of a report that ``export_csv`` wrote; its header is a file of its own."""
    reader = spark.read.option("sep", sep).option("quote", '"').option("escape", '"')
    return reader.option("mode", "FAILFAST").option("pathGlobFilter", "part-*").schema(schema).csv(path)


def read_tsv_matches(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated match lines without a header: home, result, away.

    The line is stripped and split on tabs; quotes and blanks inside it belong
    to the names, and an empty name is an empty text.  Blank lines are left out;
    a line without exactly three parts stops the job.
    """
    lines = spark.read.text(path).select(trim_space("value").alias("line")).filter("line <> ''")
    parts = F.split("line", "\t", -1)
    bad = F.raise_error(F.concat(F.lit("line needs three parts: "), F.col("line")))
    whole = lines.filter(F.when(F.size(parts) == 3, True).otherwise(bad.cast("boolean")))
    return whole.select(*[parts[i].alias(c) for i, c in enumerate(SCHEMAS["matches"].fieldNames())])


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """One extended-JSON session document per line, flattened.

    Only the id and the user are read; other values, such as tokens, are
    opaque and stay in the file.
    """
    schema = "_id struct<`$oid`: string>, user_id string"
    docs = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return docs.select(F.col("_id.`$oid`").alias("session_id"), "user_id")


def read_pipe_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """``name|age|symptoms`` texts -> three trimmed text columns.

    A line with fewer than three parts raises; further parts are ignored.
    """
    parts = F.split(F.col(column), r"\|", -1)
    short = F.raise_error(F.concat(F.lit("line needs three parts: "), F.col(column)))
    # A filter, which is evaluated whatever columns are read later.  A NULL line has NULL parts.
    whole = F.when((F.size(parts) >= 3) | F.col(column).isNull(), True).otherwise(short.cast("boolean"))
    part = lambda i: trim_space(parts[i])
    return lines.filter(whole).select(
        part(0).alias("name"), part(1).alias("age_text"), part(2).alias("symptom_text")
    )


def records(
    spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: str | StructType
) -> DataFrame:
    """A frame from in-memory records with a declared schema."""
    return spark.createDataFrame(list(rows), schema)
