"""Whole loads: raw files to star, raw files to lake, and the star's key report.

Each step reads tables and writes tables, so a job that dies half way is run
again from its files, and no lineage grows across steps.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.operators import lookup_table
from cardamom.plans import baskets, customers, daily_table, lake, sales
from cardamom.schemas import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS
from cardamom.sources import publish_view, read_csv, read_csv_lines, write_parquet, write_partitioned_fact

Files = Mapping[str, str | Sequence[str]]


def load_star(spark: SparkSession, files: Files, target: str, keep_bad_lines: bool = False) -> dict[str, DataFrame]:
    """Raw CSV files to the star schema under ``target``.

    ``files`` names the staging inputs ``users`` (one or more files),
    ``companies``, ``credit_cards``, ``products`` and ``transactions``, the
    last one separated by semicolons.  A basket whose list text is malformed
    has no bridge rows; it is in ``rejected_baskets`` with its text.  A line
    that does not fit its declared columns stops the load, or with
    ``keep_bad_lines`` goes to ``rejected_lines`` with its input and file.
    """
    bad_lines: list[DataFrame] = []

    def staged(name: str, sep: str = ",") -> DataFrame:
        if not keep_bad_lines:
            return read_csv(spark, files[name], f"staging_{name}", sep)
        rows, bad = read_csv_lines(spark, files[name], f"staging_{name}", sep)
        bad_lines.append(bad.select(F.lit(name).alias("input"), "file", "line"))
        return rows

    def store(name: str, df: DataFrame) -> DataFrame:
        return write_parquet(df, f"{target}/{name}")

    star = {
        "dim_users": store("dim_users", lake.load_users(staged("users"))),
        "dim_companies": store("dim_companies", lake.load_companies(staged("companies"))),
        "dim_credit_card": store("dim_credit_card", lake.load_cards(staged("credit_cards"))),
        "dim_products": store("dim_products", lake.load_products(staged("products"))),
        "fact_transactions": store(
            "fact_transactions", lake.load_fact(staged("transactions", ";"))
        ),
    }
    fact = star["fact_transactions"].withColumnRenamed("id", "transaction_id")
    bridge = baskets.bridge_from_text(fact).select(
        *[F.col(f.name).cast(f.dataType) for f in SCHEMAS["transaction_products"].fields]
    )
    status = customers.card_status(fact).select("card_id", "status")
    star["transaction_products"] = store("transaction_products", bridge)
    star["rejected_baskets"] = store("rejected_baskets", baskets.malformed_lists(fact))
    star["card_status"] = store("card_status", status)
    if keep_bad_lines:
        star["rejected_lines"] = store("rejected_lines", reduce(DataFrame.unionAll, bad_lines))
    return star


@dataclass(frozen=True)
class _Constraint:
    line: int
    table: str
    keys: tuple[str, ...]
    parent: tuple[str, str] | None = None  # table and column, for a foreign key

    def rows(self, tables: Mapping[str, DataFrame]) -> list[tuple[str, list[str], bool]]:
        """(table, key columns, whether its rows own the key) for each table that the constraint looks at."""
        mine = [(self.table, list(self.keys), self.parent is None)]
        return mine + ([(self.parent[0], [self.parent[1]], True)] if self.parent else [])


def _declared(tables: Mapping[str, DataFrame]) -> list[_Constraint]:
    found = [(t, tuple(k), None) for t, k in PRIMARY_KEYS.items() if t in tables]
    found += [(c, (k,), (p, pk)) for c, k, p, pk in FOREIGN_KEYS if c in tables and p in tables]
    return [_Constraint(i, *x) for i, x in enumerate(found)]


def _number(texts: Sequence[Column]) -> Column:
    return F.xxhash64(*texts)


def _violations(tables: Mapping[str, DataFrame], constraints: Sequence[_Constraint], full: bool) -> DataFrame:
    """By line: keys ``repeated``, ``missing`` and ``orphaned``, and groups of rows that ``clash``.

    A key travels as one number, its 64-bit hash, or with ``full`` as its text.
    A second hash tells groups in which different keys share the first.
    """
    passes: dict[str, list] = {}
    for c in constraints:
        for table, columns, own in c.rows(tables):
            texts = [F.col(k).cast("string") for k in columns]
            there = reduce(lambda a, b: a & b, [x.isNotNull() for x in texts])
            key = F.to_json(F.struct(*texts)) if full else _number(texts)
            # A foreign key that is NULL refers to nothing, on either side.
            wanted = F.lit(True) if own and c.parent is None else there
            row = F.struct(
                F.lit(c.line).cast("short").alias("line"),
                F.when(there, key).alias("key"),
                F.when(there, F.xxhash64(F.lit("second"), *texts)).alias("second"),
                F.lit(own).alias("own"),
            )
            passes.setdefault(table, []).append(F.when(wanted, row))
    rows = [tables[t].select(F.explode(F.array_compact(F.array(*made))).alias("r")).select("r.*") for t, made in passes.items()]
    counts = (
        reduce(DataFrame.unionAll, rows)
        .groupBy("line", "key")
        .agg(
            F.count_if("own").alias("owners"),
            F.count_if(~F.col("own")).alias("children"),
            F.min("second").alias("least"),
            F.max("second").alias("most"),
        )
    )
    there, alike = F.col("key").isNotNull(), F.col("least") == F.col("most")
    return counts.groupBy("line").agg(
        F.sum(F.when(there, F.greatest(F.col("owners") - 1, F.lit(0))).otherwise(0)).alias("repeated"),
        F.sum(F.when(there, 0).otherwise(F.col("owners"))).alias("missing"),
        F.sum(F.when(there & (F.col("owners") == 0), F.col("children")).otherwise(0)).alias("orphaned"),
        F.count_if(there & ~alike).alias("clash"),
    )


def key_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows that break a declared key: one line per constraint, 0 where it holds.

    Covers the primary keys (repeated and missing) and the foreign keys of
    those registered tables that are given.  Each table is read once and emits
    a number for each constraint it takes part in; all constraints are counted
    by these numbers in a single shuffle, where a hot key is one row per task.
    Constraints in which two different keys share a number, which 64 bits make
    next to impossible, are counted again by the keys themselves.  The counts,
    a row for each constraint, come to the driver.
    """
    constraints = _declared(tables)
    if not constraints:
        raise ValueError("no registered table given")
    spark = next(iter(tables.values())).sparkSession
    found = {r["line"]: r for r in _violations(tables, constraints, full=False).collect()}
    again = [c for c in constraints if c.line in found and found[c.line]["clash"]]
    if again:
        found |= {r["line"]: r for r in _violations(tables, again, full=True).collect()}
    out = []
    for c in constraints:
        n = found[c.line].asDict() if c.line in found else dict.fromkeys(("repeated", "missing", "orphaned"), 0)
        key = ", ".join(c.keys)
        if c.parent:
            out.append((c.table, f"not in {c.parent[0]}", key, n["orphaned"]))
        else:
            out += [(c.table, "repeated", key, n["repeated"]), (c.table, "missing", key, n["missing"])]
    return lookup_table(spark, out, "table_name string, check string, key string, n_bad bigint")


def build_lake(
    spark: SparkSession, files: Files, target: str, as_of: dt.datetime, seed: int = 7
) -> dict[str, DataFrame]:
    """Raw CSV files to bronze, silver and gold under ``target``.

    ``files`` names ``american_users``, ``european_users``, ``companies``,
    ``credit_cards``, ``products`` and ``transactions`` (semicolons).  Types
    are inferred except for the companies, as the raw layer declares them.
    Basket items that are no integers go to ``rejected_items``.
    """
    out: dict[str, DataFrame] = {}

    def store(layer: str, name: str, df: DataFrame) -> DataFrame:
        out[name] = write_parquet(df, f"{target}/{layer}/{name}")
        return out[name]

    def bronze(name: str, schema: str | None = None, sep: str = ",") -> DataFrame:
        return store("bronze", f"{name}_raw", read_csv(spark, files[name], schema, sep))

    raw = {n: bronze(n) for n in ("american_users", "european_users", "credit_cards", "products")}
    raw_companies = bronze("companies", "companies_raw")
    raw_tx = bronze("transactions", sep=";")

    products = store("silver", "products_clean", lake.clean_products(raw["products"]))
    tx = store("silver", "transactions_clean", lake.clean_transactions(raw_tx, "drop"))
    store("silver", "rejected_items", lake.rejected_items(raw_tx))
    store(
        "silver",
        "users_combined",
        lake.combine_users(raw["american_users"], raw["european_users"]),
    )
    companies = store("silver", "companies_clean", lake.clean_companies(raw_companies))
    store("silver", "credit_cards_clean", lake.clean_cards(raw["credit_cards"]))
    recent = store("silver", "transactions_recent", lake.redate_randomly(tx, as_of, seed=seed))

    out["v_marketing_kpis"] = publish_view(sales.marketing_view(tx, companies), "v_marketing_kpis")
    # Stored rows have no order; whoever shows the ranking sorts it.
    store("gold", "product_sales_ranking", baskets.ranking_rows(tx, products))
    store("gold", "transactions_flat", baskets.flat_sales(tx, products))
    fact_path = f"{target}/gold/fact_transactions"
    out["fact_transactions"] = write_partitioned_fact(recent, fact_path)
    daily_path = f"{target}/gold/daily_sales"
    daily_table.build_daily_table(spark, fact_path, daily_path)
    out["daily_sales"] = daily_table.read_daily_table(spark, daily_path)
    return out
