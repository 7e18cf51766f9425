"""Record assembly: tagged unions and flat lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tagged_union(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Stack frames by column name, each with its source in ``tag``; keeps repeats."""
    tagged = [df.withColumn(tag, F.lit(label)) for label, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def chunk_records(flat: DataFrame, fields: Sequence[str], pos: str = "pos", value: str = "value"):
    """Cut a flat list of texts into records of ``len(fields)`` values.

    ``flat`` has one list item per row with its place from 0.  Each record
    gathers a fixed number of rows, so no group can grow.  ``seq`` numbers the
    records.
    """
    width = len(fields)
    slot = F.pmod(F.col(pos), F.lit(width))
    return flat.groupBy(F.floor(F.col(pos) / width).cast("bigint").alias("seq")).agg(
        *[F.max(F.when(slot == i, F.col(value))).alias(f) for i, f in enumerate(fields)]
    )
