"""The test tables in the roles of the card-payment tables.

Everything here is a projection (plus a join with the 25-row nation table), so
filters and column pruning still reach the parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardamom.schemas import SCHEMAS


# Declared so that opening a table costs no job to look at its files first.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def orders_as_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order is one transaction of its customer; status F means declined."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("business_id"),
        F.col("o_custkey").alias("card_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").alias("amount"),
        (F.col("o_orderstatus") == "F").alias("declined"),
    )


def events_as_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event is one transaction with a time of day; errors are declined."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("business_id"),
        F.col("user_id").alias("card_id"),
        "user_id",
        F.col("ts").alias("timestamp"),
        F.col("value").alias("amount"),
        (F.col("event_type") == "error").alias("declined"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a raw extract: text amounts and list texts, some of them bad.

    Amounts of status P carry a currency.  The basket names the customer's
    usual product, one of three bestsellers (each in a third of all baskets)
    and a special item that is often unknown; by priority it is a plain list,
    a list with odd blanks, one item, a list with a bad item, or missing.
    """
    usual = F.col("o_custkey").cast("string")
    special = F.col("o_orderkey").cast("string")
    bestseller = (F.col("o_orderkey") % 3).cast("string")
    priority = F.col("o_orderpriority")
    status = F.col("o_orderstatus")
    basket = (
        F.when(priority == "1-URGENT", F.concat_ws(", ", usual, bestseller, special))
        .when(priority == "2-HIGH", F.concat(F.lit(" "), usual, F.lit(" ,  "), bestseller))
        .when(priority == "3-MEDIUM", usual)
        .when(priority == "4-NOT SPECIFIED", F.concat_ws(",", bestseller, F.lit("n/a"), usual))
        .when(status != "P", F.lit(""))
    )
    amount = F.col("o_totalprice").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("business_id"),
        F.col("o_custkey").alias("card_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.when(status == "P", F.concat(amount, F.lit(" EUR"))).otherwise(amount).alias("amount"),
        (status == "F").alias("declined"),
        basket.alias("product_ids"),
        F.concat((F.col("o_custkey") % 90).cast("string"), F.lit(".25")).alias("lat"),
        F.when(status == "O", F.lit("unknown"))
        .otherwise((F.col("o_custkey") % 180).cast("string"))
        .alias("longitude"),
    )


def lines_as_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order line is one transaction of its supplier; amounts have fractions of a cent."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_suppkey").alias("user_id"),
        F.col("l_shipdate").alias("timestamp"),
        (F.col("l_extendedprice") * F.col("l_discount") / 1000).alias("amount"),
        (F.col("l_returnflag") == "R").alias("declined"),
    )


def suppliers_as_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("user_id"),
        F.col("s_name").alias("name"),
        F.lit("Ltd").alias("surname"),
        F.concat("s_suppkey", F.lit("@example.com")).alias("email"),
    )


def staging_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their basket texts in the full staging layout, flags as 0 and 1."""
    raw = raw_transactions(spark, sf_dir)
    known = {
        "id": F.col("id").cast("string"),
        "card_id": F.col("card_id").cast("string"),
        "business_id": F.col("business_id").cast("string"),
        "timestamp": F.col("timestamp").cast("timestamp"),
        "declined": F.col("declined").cast("int").cast("string"),
        "product_ids": F.col("product_ids"),
        "user_id": F.col("user_id").cast("int"),
    }
    return raw.select(
        *[
            known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SCHEMAS["staging_transactions"].fields
        ]
    )


def lineitem_as_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines are the bridge between transactions and products."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"), F.col("l_partkey").alias("product_id")
    )


def _customer_with_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_with_nation(spark, sf_dir).select(
        F.col("c_custkey").alias("company_id"),
        F.col("c_name").alias("company_name"),
        F.concat(F.lit("+"), "c_nationkey", F.lit(" "), "c_custkey").alias("phone"),
        F.concat("c_custkey", F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("website"),
    )


def company_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies where neither country nor contact is asked for: no join with the nations."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name")
    )


def event_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the companies that events refer to."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("company_id"), F.col("s_name").alias("company_name")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("surname"),
        F.concat("c_custkey", F.lit("@example.com")).alias("email"),
    )


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as cards; half of them share their account with a neighbour."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("card_id"),
        F.concat(F.lit("IBAN"), F.floor(F.col("c_custkey") / 2)).alias("iban"),
    )


def _text_date(days: str, base: str, pattern: str):
    day = F.date_add(F.lit(base).cast("date"), F.expr(days))
    return F.date_format(day, pattern)


def staging_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with text dates as in a raw user file."""
    return _customer_with_nation(spark, sf_dir).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("surname"),
        F.concat(F.lit("+"), "c_custkey").alias("phone"),
        F.concat("c_custkey", F.lit("@example.com")).alias("email"),
        _text_date("cast(c_custkey % 20000 as int)", "1950-01-01", "MMM d, yyyy").alias(
            "birth_date"
        ),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_nationkey").cast("string").alias("postal_code"),
        F.lit(None).cast("string").alias("address"),
        _text_date("cast(c_custkey % 3000 as int)", "2015-01-01", "yyyy-MM-dd").alias(
            "signup_date"
        ),
        F.col("c_mktsegment").alias("user_segment"),
        F.lit(None).cast("string").alias("income_band"),
        "n_regionkey",
    )


def staging_users_of(spark: SparkSession, sf_dir: str, region: str) -> DataFrame:
    """The users of one region, as one of the raw user files."""
    wanted = table(spark, sf_dir, "region").filter(F.col("r_name") == region)
    return staging_users(spark, sf_dir).join(wanted, F.expr("n_regionkey = r_regionkey"))


def staging_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies(spark, sf_dir).select(
        F.col("company_id").cast("string").alias("company_id"),
        "company_name",
        "phone",
        "email",
        "country",
        "website",
        F.col("website").alias("merchant_category"),
        F.col("country").alias("merchant_price_position"),
    )


def staging_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards with a two-digit expiry year between 1975 and 2029."""
    return cards(spark, sf_dir).select(
        F.col("card_id").cast("string").alias("id"),
        F.col("card_id").alias("user_id"),
        "iban",
        *[F.lit(None).cast("string").alias(c) for c in ("pan", "pin", "cvv", "track1", "track2")],
        _text_date("cast(card_id % 20000 as int)", "1975-01-01", "MM/dd/yy").alias(
            "expiring_date"
        ),
        F.when(F.col("card_id") % 2 == 0, "debit").otherwise("credit").alias("card_type"),
        (F.col("card_id") % 3 == 0).alias("card_renewal_flag"),
    )


def staging_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with ``$`` prices and ``WH-`` warehouses as in a raw product file."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit("$"), F.col("p_retailprice").cast("decimal(10,2)")).alias("price"),
        F.col("p_type").alias("colour"),
        F.col("p_size").cast("decimal(10,2)").alias("weight"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("WH-")).alias("warehouse_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("$"), F.col("p_size"), F.lit(".50")).alias("cost"),
        F.date_add(F.lit("2014-01-01").cast("date"), F.col("p_size")).alias("launch_date"),
    )


def staging_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the full staging layout."""
    step = F.col("value").cast("decimal(10,2)") * F.lit("0.0123457").cast("decimal(8,7)")
    blank = lambda name, kind: F.lit(None).cast(kind).alias(name)
    key = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("card_id"),
        key.alias("business_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").cast("decimal(10,2)").alias("amount"),
        (F.col("event_type") == "error").alias("declined"),
        key.alias("product_ids"),
        F.col("user_id").cast("int").alias("user_id"),
        step.cast("decimal(15,10)").alias("lat"),
        (-step).cast("decimal(15,10)").alias("longitude"),
        blank("discount_amount", "decimal(10,2)"),
        blank("tax_amount", "decimal(10,2)"),
        blank("shipping_amount", "decimal(10,2)"),
        F.col("event_type").alias("channel"),
        blank("campaign_id", "string"),
        blank("device_type", "string"),
        blank("is_international", "boolean"),
        F.when(F.col("event_type") == "error", "error").alias("decline_reason"),
        blank("distance_km", "decimal(10,2)"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as candidates; some nations send broken names and phones."""
    key = F.col("c_custkey")
    nation = F.col("c_nationkey")
    name = F.when(nation == 0, "  ").when(nation == 1, F.col("c_name"))
    digits = F.lpad(key.cast("string"), 9, "6")
    phone = (
        F.when(nation == 2, "123")
        .when(nation == 3, "600 00000")
        .when(nation == 4, "60000000x")
        .when(nation == 5, "")
    )
    text = lambda n: n.cast("string")
    return table(spark, sf_dir, "customer").select(
        key.alias("seq"),
        name.otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"))).alias("name"),
        phone.otherwise(digits).alias("phone"),
        text(key % 60).alias("experience"),
        text(key % 5).alias("catalan"),
        F.when(nation == 6, "1.0").otherwise(text(key % 4)).alias("excel"),
        text(F.floor(key / 7) % 4).alias("degree"),
    )


def clients(spark: SparkSession, sf_dir: str, codes: int) -> DataFrame:
    """Customers with an age, an age group and a behaviour or risk code."""
    key = F.col("c_custkey")
    age = 18 + key % 60
    group = (
        F.when(age <= 25, "18-25").when(age <= 40, "26-40").when(age <= 60, "41-60")
    ).otherwise("60+")
    return table(spark, sf_dir, "customer").select(
        key.alias("client_id"),
        F.col("c_name").alias("name"),
        age.alias("age"),
        group.alias("age_group"),
        (key % codes).alias("code"),
    )


# Severity of the words that part names are made of.
WORD_SEVERITIES = {"hot": 3, "red": 5, "large": 4, "cold": 1, "old": 1, "bolt": 2, "gear": 1}


def symptom_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as ``name|size|word , word`` lines."""
    words = F.replace(F.upper("p_name"), F.lit(" "), F.lit(" , "))
    return table(spark, sf_dir, "part").select(
        F.concat_ws("|", F.concat("p_name", F.lit(" "), "p_partkey"), "p_size", words).alias(
            "line"
        )
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as matches of a supplier against a part's maker."""
    away = F.col("l_partkey") % 100
    return (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_suppkey") != away)
        .select(
            F.concat(F.lit("team "), F.col("l_suppkey")).alias("home"),
            F.concat_ws(
                "-", F.col("l_linenumber"), (F.col("l_quantity").cast("int") % 5)
            ).alias("result"),
            F.concat(F.lit("team "), away).alias("away"),
        )
    )
