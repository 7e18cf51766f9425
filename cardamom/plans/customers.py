"""Per-card and per-user segmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.functions import exact_sum, mean_of, money
from cardamom.operators import first_n_per_key, group_mean
from cardamom.plans.sales import sold


def card_status(tx: DataFrame, last: int = 3) -> DataFrame:
    """A card whose last ``last`` transactions were all declined is inactive.

    A card with fewer transactions than that is never inactive.
    """
    newest = [F.col("timestamp").desc(), F.col("transaction_id").desc()]
    recent = first_n_per_key(tx, ["card_id"], newest, last)
    declined = F.sum(F.col("declined").cast("int"))
    return recent.groupBy("card_id").agg(
        F.when(declined == last, "inactive").otherwise("active").alias("status"),
        declined.alias("n_declined"),
    )


def active_cards(status: DataFrame) -> DataFrame:
    return status.filter(F.col("status") == "active").agg(F.count("*").alias("n_active"))


def _full_name():
    return F.concat(F.col("name"), F.lit(" "), F.col("surname")).alias("full_name")


def vip_users(tx: DataFrame, users: DataFrame, spent_over: float = 500) -> DataFrame:
    """Users whose accepted amounts add up to more than a limit, with profile."""
    stats = (
        sold(tx)
        .groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("n_purchases"),
            exact_sum("amount").alias("total"),
            F.count("amount").alias("n_amounts"),
            F.max("amount").alias("max_purchase"),
        )
        .filter(F.col("total") > spent_over)
    )
    return (
        stats.join(users.select("user_id", "name", "surname", "email"), "user_id")
        .select(
            "user_id",
            _full_name(),
            "email",
            "n_purchases",
            mean_of(F.col("total"), F.col("n_amounts")).alias("avg_ticket"),
            "max_purchase",
            F.round("total", 2).cast("double").alias("total_spent"),
        )
        .orderBy(F.col("total_spent").desc(), "user_id")
    )


def third_purchase(tx: DataFrame, users: DataFrame, nth: int = 3) -> DataFrame:
    """Day and amount of the n-th accepted purchase, and the mean of the first n.

    The mean is taken after the profile join, as a window beside the rows.
    Users with fewer purchases do not appear.
    """
    oldest = [F.col("timestamp"), F.col("transaction_id")]
    firsts = first_n_per_key(
        sold(tx).select("user_id", "timestamp", "transaction_id", "amount"),
        ["user_id"],
        oldest,
        nth,
    )
    joined = firsts.join(users.select("user_id", "name", "surname", "email"), "user_id")
    with_mean = group_mean(joined, ["user_id"], money("amount"), "avg_first")
    return with_mean.filter(F.col("rn") == nth).select(
        "user_id",
        _full_name(),
        "email",
        F.to_date("timestamp").alias("nth_day"),
        F.col("amount").alias("nth_amount"),
        "avg_first",
    )
