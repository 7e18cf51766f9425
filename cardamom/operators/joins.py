"""Joins.

None of these forces a broadcast on a table: Catalyst and AQE broadcast a side
only after checking its size, otherwise both sides shuffle and AQE splits a
hot key of the left side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def keep_matching(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], unique: bool = False
) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right`` (EXISTS).

    Unless the right keys are ``unique`` already they are made distinct first:
    the partial aggregate collapses a hot key before the shuffle, and the join
    reuses that shuffle.
    """
    keys = _keys(on)
    wanted = right.select(*keys)
    return left.join(wanted if unique else wanted.distinct(), keys, "left_semi")


def keep_unmatched(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right`` (NOT EXISTS)."""
    keys = _keys(on)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def left_with_default(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], defaults: Mapping[str, Any]
) -> DataFrame:
    """Left join; columns that found no match take a default.  A matched NULL stays NULL."""
    keys = _keys(on)
    joined = left.join(right.withColumn("_found", F.lit(True)), keys, "left")
    filled = {
        c: F.when(F.col("_found"), F.col(c)).otherwise(F.lit(v).cast(right.schema[c].dataType))
        for c, v in defaults.items()
    }
    return joined.withColumns(filled).drop("_found")


def lookup_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A lookup table from literals in the code.

    It is a local relation (``VALUES``), whose size Spark knows, so a join with
    it is a broadcast one as long as that is small.  A frame made from Python
    rows is of unknown size, and the other side would be shuffled on its key.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not rows:
        return spark.createDataFrame([], wanted)
    # Parameters go by name: positional ones are not taken in their order inside VALUES.
    names = [[f"r{i}c{k}" for k in range(len(wanted))] for i in range(len(rows))]
    marks = ["(" + ", ".join(f"CAST(:{x} AS {f.dataType.simpleString()})" for x, f in zip(row, wanted.fields)) + ")" for row in names]
    args = {x: value for row, values in zip(names, rows) for x, value in zip(row, values)}
    values = spark.sql(f"SELECT * FROM VALUES {', '.join(marks)}", args=args)
    return values.toDF(*wanted.names)


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: str | Sequence[str],
    *,
    on_missing: str = "fail",
    defaults: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Bring in the columns of a lookup table whose key is unique.

    ``on_missing``: ``fail`` stops the job at the first unknown key,
    ``default`` fills ``defaults``, ``reject`` drops the row (get the rejects
    with :func:`keep_unmatched`).
    """
    keys = _keys(on)
    if on_missing == "reject":
        return df.join(table, keys, "inner")
    if on_missing == "default":
        return left_with_default(df, table, keys, defaults or {})
    if on_missing != "fail":
        raise ValueError(f"on_missing: {on_missing!r}")
    joined = df.join(table.withColumn("_found", F.lit(True)), keys, "left")
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit(f"no entry in lookup for {', '.join(keys)} = "), shown)
    # A filter, which is evaluated whatever columns are read later.
    ok = F.when(F.col("_found"), True).otherwise(F.raise_error(message).cast("boolean"))
    return joined.filter(ok).drop("_found")


def left_join_unique(left: DataFrame, right: DataFrame, on: str, most: int = 100) -> DataFrame:
    """Left join with a table whose key ``on`` is unique, whatever share of the rows a key has.

    A sketch of the frequent keys of ``left``, merged from the tasks' sketches,
    names the keys with more than one in ``most`` of the rows; there are fewer
    than ``most`` of them.  These meet their rows of ``right`` in a broadcast
    of at most that many rows.  All other rows are joined as Spark sees fit; if
    that is through a shuffle, rows that are done already, or whose key is
    NULL, are dealt by all their columns and meet nothing.  So no session
    setting is needed to split a hot key.  Which keys the sketch names decides
    where rows are joined, not what they are joined with.
    """
    kept = [c for c in right.columns if c != on]
    key = F.col(on)
    counted = left.select(on).agg(
        F.expr(f"approx_top_k(`{on}`, {most}, {100 * most})").alias("top"), F.count(on).alias("total")
    )
    heavy = counted.select(F.explode("top").alias("item"), "total").where(F.col("item.count") * most > F.col("total"))
    heavy = heavy.select(F.col("item.item").alias(on)).where(key.isNotNull())
    fields = [F.col(f"`{c}`") for c in kept]
    found = right.select(F.struct(*fields).alias("_hot_row"), on).join(F.broadcast(heavy), on, "left_semi")
    done = heavy.join(F.broadcast(found), on, "left").withColumn("_hot", F.lit(True))
    marked = left.join(F.broadcast(done), on, "left")
    apart = F.col("_hot").isNotNull() | key.isNull()
    spread = F.when(apart, F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in left.columns)), F.lit(1 << 20)) + 1).otherwise(0)
    # Always 0, but not as a literal: that would be taken out of the join's keys.
    zero = F.pmod(F.xxhash64(on), F.lit(1))
    others = right.select(on, F.struct(*fields).alias("_row"), zero.alias("_spread"))
    joined = marked.withColumn("_spread", spread).join(others, [on, "_spread"], "left")
    row = F.when(F.col("_hot"), F.col("_hot_row")).otherwise(F.col("_row"))
    return joined.select(*(F.col(f"`{c}`") for c in left.columns), *(row[c].alias(c) for c in kept))
