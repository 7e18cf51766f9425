"""Declared constraints as reports, and row validation with reasons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness, with their row count ``n_rows``."""
    present = df.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL in the key."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``n_repeated`` rows beyond the first of their key, ``n_missing`` with a NULL."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum(F.when(~missing, F.col("n") - 1)).alias("n_repeated"),
        F.sum(F.when(missing, F.col("n"))).alias("n_missing"),
    )


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent, with their row count ``n_rows``.

    Children are counted per key first, so a hot orphan is one row in the join.
    NULL references are allowed, as in SQL.
    """
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    parents = parent.select(F.col(parent_key).alias(key))
    return counted.join(parents, key, "left_anti")


def row_count_check(
    tables: Mapping[str, DataFrame], expected: Mapping[str, int | DataFrame]
) -> DataFrame:
    """One row per table: rows found, rows expected, and whether they agree.

    What is expected is a number, or the table that was the source.
    """
    out = None
    for name, df in tables.items():
        source = expected.get(name)
        counted = isinstance(source, DataFrame)
        want = source.agg(F.count("*")).scalar() if counted else F.lit(source).cast("bigint")
        row = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            want.alias("n_expected"),
            (F.col("n_rows") == want).alias("ok"),
        )
        out = row if out is None else out.unionAll(row)
    return out


@dataclass(frozen=True)
class Rule:
    """One check of one field: the SQL condition ``ok`` must hold, else ``reason`` applies."""

    field: str
    ok: str
    reason: str


def _texts(values: Sequence[str]) -> str:
    quoted = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return f"array({quoted})"


def first_failure(rules: Sequence[Rule]) -> Column:
    """Number (from 0) of the first rule a row breaks, NULL when it breaks none.

    One CASE, so later rules are not evaluated on a row that broke an earlier one.
    """
    cases = " ".join(
        f"WHEN NOT coalesce({r.ok}, false) THEN {i}" for i, r in enumerate(rules)
    )
    return F.expr(f"CASE {cases} END")


def split_valid(df: DataFrame, rules: Sequence[Rule], error: str = "error"):
    """(accepted, rejected); rejected rows carry the struct ``error``.

    ``error`` holds field, value and reason of the first rule broken.
    """
    number = first_failure(rules)
    accepted = df.filter(number.isNull())
    fields = _texts([r.field for r in rules])
    values = ", ".join(f"CAST({r.field} AS string)" for r in rules)
    reasons = _texts([r.reason for r in rules])
    details = F.expr(
        f"named_struct('field', {fields}[_rule], 'value', array({values})[_rule], "
        f"'reason', {reasons}[_rule])"
    )
    rejected = df.withColumn("_rule", number).filter("_rule IS NOT NULL")
    return accepted, rejected.withColumn(error, details).drop("_rule")
