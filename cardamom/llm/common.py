"""Reading tables, and tables written to the cluster's shared folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage: what was written is not computed again when an executor
    is lost, and non-deterministic work cannot come out differently twice.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, which may hold dots."""
    return df["`" + name.replace("`", "``") + "`"]


def row_places(df: DataFrame) -> list[Column]:
    """What tells rows of a stored table apart, equal ones too: their file and place in it; nothing for other frames.

    A task that runs again finds the same places, unlike numbers counted on the way.
    """
    places = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
    try:
        df.select(*places)
    except AnalysisException:
        return []
    return places


def text_size(docs: DataFrame, text: str) -> tuple[int, int]:
    """Bytes of text and rows of a table: what the sizes of sketches and shards follow."""
    got = docs.agg(
        F.coalesce(F.sum(F.octet_length(column(docs, text)).cast("long")), F.lit(0)).alias("bytes"),
        F.count("*").alias("rows"),
    ).first()
    return int(got["bytes"]), int(got["rows"])


def held_out(doc_id: Column) -> Column:
    """True for the rows that nothing is learned from: crc32 of the id's text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def hash_sample(df: DataFrame, key: str, stratum: str, size: int) -> DataFrame:
    """About ``size`` rows of each stratum, the same ones at every run.

    A row is in if the hash of its key falls below size / rows of its stratum;
    a stratum with fewer rows is whole.  Nothing is sorted, so no task sees
    more than its own rows.  The counts are one row per stratum.
    """
    counts = {r[stratum]: r["n"] for r in df.groupBy(stratum).agg(F.count("*").alias("n")).toLocalIterator()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(stratum).eqNullSafe(F.lit(value)), F.lit(min(1.0, size / n))).otherwise(share)
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < share * (1 << 30))


def attach(rows: DataFrame, found: DataFrame, key: str, times: str, total: int, most: int = 1000) -> DataFrame:
    """Rows with the columns that ``found`` has for their key; keys are unique there and never NULL.

    ``times`` counts the rows of each key, ``total`` those of all.  Keys with
    more than one in ``most`` of the rows are fewer than ``most``: they are
    broadcast, so their rows are not shuffled into one task.  All other keys
    are joined through a shuffle.
    """
    heavy = F.col(times) > total / most
    hot = found.where(heavy).drop(times).withColumn("_hot", F.lit(True))
    marked = rows.join(F.broadcast(hot), key, "left")
    names = [x for x in found.columns if x not in (key, times)]
    done = marked.where("_hot").drop("_hot")
    rest = marked.where("_hot is null").drop("_hot", *names).join(found.where(~heavy).drop(times), key, "left")
    return done.unionByName(rest)
