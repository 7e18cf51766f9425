"""Sales by company and by day.

Facts are added up per foreign key before they meet a dimension: the partial
aggregate takes the edge off hot keys and the join sees one row per key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.functions import (
    exact_sum,
    floor_mean,
    in_days,
    in_year,
    mean_of,
    on_day,
    rounded_mean,
    units,
)
from cardamom.operators import (
    daily_totals,
    keep_matching,
    keep_unmatched,
    per_key_totals,
    top_k,
    top_row,
)


def sold(tx: DataFrame) -> DataFrame:
    """Accepted transactions; an unknown (NULL) flag is not accepted."""
    return tx.filter(~F.col("declined"))


def selling_countries(tx: DataFrame, companies: DataFrame) -> DataFrame:
    """Countries with at least one sale."""
    sellers = sold(tx).filter(F.col("amount") >= 0).select(F.col("business_id").alias("company_id"))
    return keep_matching(companies, sellers, "company_id").select("country").distinct()


def number_of_selling_countries(tx: DataFrame, companies: DataFrame) -> DataFrame:
    return selling_countries(tx, companies).agg(F.count_distinct("country").alias("n_countries"))


def company_means(tx: DataFrame) -> DataFrame:
    """Total and number of accepted amounts per company."""
    return per_key_totals(sold(tx), [F.col("business_id").alias("company_id")])


def top_company(tx: DataFrame, companies: DataFrame) -> DataFrame:
    """The company with the highest mean sale."""
    means = company_means(tx).withColumn("avg_sale", mean_of(F.col("total"), F.col("n")))
    named = means.join(companies.select("company_id", "company_name"), "company_id")
    best = top_row(named, [F.col("avg_sale").desc(), F.col("company_id")])
    return best.select(F.col("company_name").alias("company"), "avg_sale")


def country_transactions(tx: DataFrame, companies: DataFrame, country: str) -> DataFrame:
    """Accepted transactions of one country's companies, without a join row."""
    there = companies.filter(F.col("country") == country).select(
        F.col("company_id").alias("business_id")
    )
    return keep_matching(sold(tx), there, "business_id", unique=True)


def above_average_companies(tx: DataFrame, companies: DataFrame) -> DataFrame:
    """Companies with sales above the overall mean, and the mean of those sales.

    A whole number of units exceeds the mean when it exceeds the mean's whole
    units, so the test is one of integers.
    """
    accepted = sold(tx)
    overall = accepted.agg(floor_mean(exact_sum("amount"), F.count("amount")))
    large = accepted.filter(units("amount") > overall.scalar())
    totals = per_key_totals(large, [F.col("business_id").alias("company_id")])
    named = totals.join(companies.select("company_id", "company_name"), "company_id", "left")
    return named.select(
        F.col("company_name").alias("company"),
        mean_of(F.col("total"), F.col("n")).alias("avg_sale"),
    ).orderBy(F.col("avg_sale").desc(), "company")


def overall_mean(tx: DataFrame) -> DataFrame:
    return sold(tx).agg(rounded_mean("amount").alias("avg_sale"))


def companies_without(tx: DataFrame, companies: DataFrame) -> DataFrame:
    """Companies that no transaction refers to."""
    seen = tx.select(F.col("business_id").alias("company_id"))
    return keep_unmatched(companies, seen, "company_id").select(
        F.col("company_name").alias("company")
    )


def companies_if_no_transactions(tx: DataFrame, companies: DataFrame) -> DataFrame:
    """All companies when the transaction table is empty, otherwise none.

    The literal reading of an uncorrelated NOT EXISTS; see
    :func:`companies_without` for what is usually meant.
    """
    return companies.filter(~tx.exists()).select(F.col("company_name").alias("company"))


def heavy_users(tx: DataFrame, users: DataFrame, more_than: int = 80) -> DataFrame:
    """Users with more than so many transactions, declined ones included.

    One aggregation gives both the test and the count, so the fact table is
    shuffled once (as partial counts).
    """
    counts = tx.groupBy("user_id").agg(F.count("*").alias("n_transactions"))
    heavy = counts.filter(F.col("n_transactions") > more_than)
    named = heavy.join(users.select("user_id", "name"), "user_id", "left")
    return named.select(F.col("name").alias("user"), "n_transactions").orderBy(
        F.col("n_transactions").desc(), "user"
    )


def mean_per_account(
    tx: DataFrame, cards: DataFrame, companies: DataFrame, company_name: str
) -> DataFrame:
    """Mean accepted amount per account (IBAN) at one company.

    The company test reduces the fact first, as a semi join; what is left is
    added up per card before it meets the card table.
    """
    there = companies.filter(F.col("company_name") == company_name).select(
        F.col("company_id").alias("business_id")
    )
    at_company = keep_matching(sold(tx), there, "business_id", unique=True)
    totals = per_key_totals(at_company, ["card_id"])
    per_iban = (
        totals.join(cards.select("card_id", "iban"), "card_id")
        .groupBy("iban")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    return per_iban.select("iban", mean_of(F.col("total"), F.col("n")).alias("avg_amount")).orderBy(
        F.col("avg_amount").desc(), "iban"
    )


def top_days(
    tx: DataFrame, k: int = 5, year: int | None = None, companies: DataFrame | None = None
) -> DataFrame:
    """The days with the highest revenue, of all time or of one year.

    With ``companies`` (the star form) only transactions of a listed company
    count; the lake form takes all.
    """
    accepted = sold(tx)
    if companies is not None:
        known = companies.select(F.col("company_id").alias("business_id"))
        accepted = keep_matching(accepted, known, "business_id", unique=True)
    if year is not None:
        accepted = accepted.filter(in_year("timestamp", year))
    days = daily_totals(accepted).select("day", F.round("sales", 2).cast("double").alias("revenue"))
    return top_k(days, [F.col("revenue").desc(), F.col("day")], k)


def transactions_in_range(
    tx: DataFrame, companies: DataFrame, low: float, high: float, days: list[str]
) -> DataFrame:
    """Accepted transactions with an amount in [low, high] on the listed days."""
    hits = sold(tx).filter(F.col("amount").between(low, high) & in_days("timestamp", days))
    joined = hits.join(companies, hits["business_id"] == companies["company_id"])
    return joined.select(
        F.col("company_name").alias("company"),
        "phone",
        "country",
        F.to_date("timestamp").alias("day"),
        "amount",
    ).orderBy(F.col("amount").desc(), "company", "day")


def volume_band(
    tx: DataFrame, companies: DataFrame, threshold: int = 400, inclusive: bool = True
) -> DataFrame:
    """Transactions per company and whether they reach a threshold.

    ``inclusive`` follows the label (``>=``); without it a company exactly at
    the threshold falls into the lower band.
    """
    n = F.col("n_transactions")
    reached = n >= threshold if inclusive else n > threshold
    counts = tx.groupBy(F.col("business_id").alias("company_id")).agg(
        F.count("*").alias("n_transactions")
    )
    band = F.when(reached, F.lit(f">= {threshold}")).otherwise(F.lit(f"< {threshold}"))
    return (
        counts.join(companies.select("company_id", "company_name"), "company_id")
        .select(F.col("company_name").alias("company"), "n_transactions", band.alias("band"))
        .orderBy("band", "company")
    )


def marketing_view(tx: DataFrame, companies: DataFrame, premium_over: float = 260) -> DataFrame:
    """Company contact data, mean accepted amount and Premium / Standard label."""
    joined = company_means(tx).join(companies, "company_id")
    mean = F.col("total") / F.col("n").cast("decimal(18,0)")
    return joined.select(
        F.col("company_id").alias("id"),
        F.col("company_name").alias("company"),
        "phone",
        "country",
        mean.alias("avg_amount"),
        F.when(mean > premium_over, "Premium").otherwise("Standard").alias("type"),
    )


def marketing_report(view: DataFrame) -> DataFrame:
    """The view, rounded, highest mean first."""
    return view.withColumn("avg_amount", F.round("avg_amount", 2).cast("double")).orderBy(
        F.col("avg_amount").desc(), F.col("type").desc(), "company"
    )


def country_day(
    tx: DataFrame, companies: DataFrame, country: str, day: dt.date | str
) -> DataFrame:
    """One country's transactions on one day with all company columns."""
    that_day = tx.filter(on_day("timestamp", day))
    there = companies.filter(F.col("country") == country)
    return that_day.join(there, that_day["business_id"] == there["company_id"])
