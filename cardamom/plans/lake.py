"""Bronze to silver cleaning, staging to star load, re-dating."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions import (
    bad_items,
    days_before,
    parse_int_list,
    parse_iso_date,
    parse_month_name_date,
    parse_price,
    parse_short_us_date,
    random_day_offset,
    since,
    strip_text,
    time_of_day,
    to_flag,
    to_float,
)
from cardamom.operators import tagged_union
from cardamom.schemas import SCHEMAS

# ---- silver ---------------------------------------------------------------


def clean_products(raw: DataFrame) -> DataFrame:
    """Typed products: ``$`` and ``WH-`` stripped, bad numbers fail."""
    return raw.select(
        F.col("id").cast("bigint").alias("product_id"),
        F.col("product_name").alias("name"),
        strip_text("warehouse_id", "WH-").cast("bigint").alias("warehouse_id"),
        parse_price("price").cast("double").alias("price"),
        "category",
        "weight",
        "brand",
        "cost",
        "colour",
        "launch_date",
    )


def clean_transactions(raw: DataFrame, on_bad_item: str) -> DataFrame:
    """Typed transactions: unreadable amounts 0, list text to an array, flags to booleans.

    ``on_bad_item`` says what happens to list items that are no integers:
    ``drop`` (:func:`rejected_items` keeps them), ``null`` or ``fail``.
    """
    return raw.select(
        F.col("id").alias("transaction_id"),
        "business_id",
        "card_id",
        "timestamp",
        F.coalesce(to_float("amount"), F.lit(0.0)).alias("amount"),
        to_flag("declined").alias("declined"),
        parse_int_list("product_ids", on_bad=on_bad_item).alias("product_ids"),
        "user_id",
        to_float("lat").alias("lat"),
        to_float("longitude").alias("longitude"),
    )


def rejected_items(raw: DataFrame) -> DataFrame:
    """(transaction_id, item) for every list item that is no integer."""
    items = F.explode(bad_items("product_ids")).alias("item")
    return raw.select(F.col("id").alias("transaction_id"), items)


# The columns of the combined users, in order.
USER_COLUMNS = [
    "name",
    "surname",
    "phone",
    "email",
    "birth_date",
    "country",
    "city",
    "postal_code",
]


def combine_users(american: DataFrame, european: DataFrame) -> DataFrame:
    """Both user files under one roof with their ``origin``."""
    pick = lambda df: df.select(F.col("id").alias("user_id"), *USER_COLUMNS)
    return tagged_union({"American": pick(american), "Europe": pick(european)}, "origin")


def clean_companies(raw: DataFrame) -> DataFrame:
    return raw.select(*SCHEMAS["companies_raw"].fieldNames())


def clean_cards(raw: DataFrame) -> DataFrame:
    kept = ["user_id", "iban", "pan", "pin", "cvv", "track1", "track2", "expiring_date"]
    return raw.select(F.col("id").alias("card_id"), *kept)


# ---- star -----------------------------------------------------------------


def _typed(df: DataFrame, table: str, **computed: Column) -> DataFrame:
    """Select the columns of a star table in order, cast to its types."""
    return df.select(
        *[
            computed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in SCHEMAS[table].fields
        ]
    )


def load_users(staging: DataFrame) -> DataFrame:
    return _typed(
        staging,
        "dim_users",
        birth_date=parse_month_name_date("birth_date"),
        signup_date=parse_iso_date("signup_date"),
    )


def load_companies(staging: DataFrame) -> DataFrame:
    return _typed(staging, "dim_companies", id=F.col("company_id"))


def load_cards(staging: DataFrame) -> DataFrame:
    return _typed(
        staging,
        "dim_credit_card",
        expiring_date=parse_short_us_date("expiring_date"),
        card_renewal_flag=to_flag("card_renewal_flag"),
    )


def load_products(staging: DataFrame) -> DataFrame:
    return _typed(staging, "dim_products", price=parse_price("price"), cost=parse_price("cost"))


def load_fact(staging: DataFrame) -> DataFrame:
    """Transactions with the timestamp split into date and time of day.

    Coordinates narrow from ten to six decimals, rounding half up.
    """
    return _typed(
        staging,
        "fact_transactions",
        company_id=F.col("business_id"),
        tr_date=F.to_date("timestamp"),
        tr_time=time_of_day("timestamp"),
        declined=to_flag("declined"),
        is_international=to_flag("is_international"),
    )


# ---- re-dating ------------------------------------------------------------


def redate(tx: DataFrame, as_of: dt.datetime, offset_days: Column) -> DataFrame:
    """All columns, with ``timestamp`` moved to so many days before ``as_of``."""
    return tx.drop("timestamp").withColumn("timestamp", days_before(as_of, offset_days))


def redate_randomly(
    tx: DataFrame, as_of: dt.datetime, max_days: int = 50, seed: int = 7
) -> DataFrame:
    return redate(tx, as_of, random_day_offset(max_days, seed))


def hashed_offset(key: Column, max_days: int = 50) -> Column:
    """A repeatable stand-in for the random offset, spread like it over 0..max_days."""
    share = F.pmod(key * 7919, F.lit(10007)) / 10007
    return F.round(share * max_days).cast("int")


def recent(tx: DataFrame, as_of: dt.datetime, days: int = 30, day: str | None = None) -> DataFrame:
    """Transactions of the last ``days`` days.

    On a table partitioned by ``day`` that column is tested too, so whole
    partitions are left out before any file is opened.
    """
    out = tx.filter(since("timestamp", as_of, days))
    if day is not None:
        first = (as_of - dt.timedelta(days=days)).date()
        out = out.filter(F.col(day) >= F.lit(first))
    return out
