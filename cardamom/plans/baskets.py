"""Baskets: list text to rows, units per product, flat sales fact.

Items are counted per product id before the product table is joined, so a
product in a third of all baskets is one row in that join.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions import calculate_tax, is_int_list, json_items, money
from cardamom.operators import keep_matching, left_join_unique, left_with_default, top_k
from cardamom.plans.sales import sold


def _explode(df: DataFrame, keep: list[str], items: Column | str) -> DataFrame:
    """One row per list item; empty and NULL lists give none, NULL items stay.

    A plain ``explode`` makes the optimizer test ``size(items) > 0`` first, and
    where the list is still being parsed from text that parses it twice.  The
    outer form is not rewritten; its slot is NULL where there was no item.
    """
    exploded = df.select(*keep, F.posexplode_outer(items).alias("_slot", "product_id"))
    return exploded.filter("_slot IS NOT NULL").drop("_slot")


def bridge_from_text(tx: DataFrame) -> DataFrame:
    """(transaction_id, product_id) from well-formed list texts, read as JSON."""
    good = tx.filter(is_int_list("product_ids"))
    return _explode(good, ["transaction_id"], json_items("product_ids"))


def malformed_lists(tx: DataFrame) -> DataFrame:
    """Transactions whose list text is no integer list; NULL is not malformed."""
    return tx.filter(~is_int_list("product_ids")).select("transaction_id", "product_ids")


def dedupe_bridge(bridge: DataFrame) -> DataFrame:
    """One row per (transaction, product), as the composite key asks."""
    return bridge.select("transaction_id", "product_id").distinct()


def units_per_product(bridge: DataFrame, products: DataFrame) -> DataFrame:
    """How often each known product was sold; repeats in a basket count."""
    units = bridge.groupBy("product_id").agg(F.count("*").alias("n_sales"))
    return units.join(products.select("product_id", F.col("name").alias("product")), "product_id")


def basket_items(tx: DataFrame) -> DataFrame:
    """One row per basket item, next to the transaction's columns."""
    return _explode(tx, tx.columns, "product_ids")


def _item_counts(tx: DataFrame, name: str) -> DataFrame:
    return _explode(tx, [], "product_ids").groupBy("product_id").agg(F.count("*").alias(name))


def sales_ranking(tx: DataFrame, products: DataFrame) -> DataFrame:
    """:func:`ranking_rows` in order, for showing or exporting."""
    return ranking_rows(tx, products).orderBy(F.col("total_sold").desc(), "product_id")


def ranking_rows(tx: DataFrame, products: DataFrame) -> DataFrame:
    """Units sold per product, accepted transactions only, unsold products at 0; in no order.

    Counts the lists of the transactions; :func:`ranking_from_lines` counts rows.
    """
    listed = products.select("product_id", "name", "price", "colour")
    ranked = left_with_default(
        listed, _item_counts(sold(tx), "total_sold"), "product_id", {"total_sold": 0}
    )
    return ranked.select("product_id", "name", "price", "total_sold", "colour")


def ranking_from_lines(lines: DataFrame, tx: DataFrame, products: DataFrame) -> DataFrame:
    """The sales ranking where each item is a row (transaction_id, product_id).

    No list is built or read: lines of accepted transactions are kept by a semi
    join, counted per product, and only then meet the products.
    """
    accepted = sold(tx).select("transaction_id")
    kept = keep_matching(lines, accepted, "transaction_id", unique=True)
    counts = kept.groupBy("product_id").agg(F.count("*").alias("total_sold"))
    listed = products.select("product_id", "name", "price", "colour")
    ranked = left_with_default(listed, counts, "product_id", {"total_sold": 0})
    return ranked.select("product_id", "name", "price", "total_sold", "colour").orderBy(
        F.col("total_sold").desc(), "product_id"
    )


def flat_sales(tx: DataFrame, products: DataFrame, tax_rate: str = "0.21") -> DataFrame:
    """Every basket item with its transaction and product, price with tax.

    Unknown products keep their row with NULL product columns; declined
    transactions are included.  A product that a large share of the baskets
    hold is joined apart from the others (:func:`left_join_unique`).
    """
    dim = products.select(
        "product_id",
        F.col("product_id").alias("product_sku"),
        F.col("name").alias("product_name"),
        F.col("price").alias("product_price"),
    )
    price = money("product_price")
    tax = calculate_tax(price, F.lit(Decimal(tax_rate)), 2)
    return (
        left_join_unique(basket_items(tx), dim, "product_id")
        .withColumn("product_price_tax_inc", (price + tax).cast("double"))
        .drop("product_id")
    )


def top_products(tx: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """Products with the most units, declined included; unknown ones are one group.

    Equal to grouping the flat sales by (sku, name), but counted per product
    id before the join.
    """
    units = _item_counts(tx, "n")
    dim = products.select(
        "product_id",
        F.col("product_id").alias("product_sku"),
        F.col("name").alias("product"),
    )
    grouped = (
        units.join(dim, "product_id", "left")
        .groupBy("product_sku", "product")
        .agg(F.sum("n").alias("units"))
    )
    best = top_k(grouped, [F.col("units").desc(), F.col("product_sku").asc_nulls_last()], k)
    return best.select("product", "units")
