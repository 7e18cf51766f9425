"""Lookup-driven scoring: basket abandonment, patient triage, insurance price."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions import (
    amount_label,
    percent_label,
    py_round,
    score_items,
    snake_case,
    split_items,
    to_int,
)
from cardamom.operators import lookup, lookup_table, top_k, top_row
from cardamom.sources import read_pipe_lines

# Behaviour code -> segment, factor, message.
BEHAVIOURS = [
    (
        0,
        "Navega pero no añade productos",
        0.10,
        "Descubre las ultimas novedades exclusivas de la semana.",
    ),
    (
        1,
        "Agrega productos pero no llega al checkout",
        0.25,
        "Tus artículos en cesta te esperan.",
    ),
    (
        2,
        "Llega al checkout pero no paga",
        0.50,
        "Completa tu pedido ahora y disfruta de envío gratuito.",
    ),
    (
        3,
        "Cesta de compra abandonado (<24h)",
        0.75,
        "¡Date prisa! Tu cesta de la compra caducará muy pronto.",
    ),
    (
        4,
        "Cesta de compra abandonado (>24h)",
        0.90,
        "Te ofrecemos un cupon del 10% de descuento en tu cesta de compra",
    ),
]
# Age group -> factor.
AGE_FACTORS = [("18-25", 1.20), ("26-40", 1.00), ("41-60", 0.85), ("60+", 0.70)]
# Symptom -> severity.
SEVERITIES = {
    "fiebre_alta": 3,
    "dificultad_respirar": 5,
    "dolor_pecho": 4,
    "tos": 1,
    "fatiga": 1,
    "dolor_cabeza": 1,
}
# Risk code -> category, base price, fraud probability.
INSURANCE_LEVELS = [
    (0, "Baix risc", 120, 0.01),
    (1, "Risc mitjà", 200, 0.05),
    (2, "Risc alt", 350, 0.15),
    (3, "Risc crític", 500, 0.30),
]


# ---- basket abandonment -----------------------------------------------------


def abandonment_risk(clients: DataFrame) -> DataFrame:
    """Clients (client_id, name, age, age_group, code) with segment and risk.

    An unknown code or age group stops the job.
    """
    spark = clients.sparkSession
    behaviours = lookup_table(
        spark, BEHAVIOURS, "code bigint, segment string, code_factor double, message string"
    )
    ages = lookup_table(spark, AGE_FACTORS, "age_group string, age_factor double")
    joined = lookup(lookup(clients, behaviours, "code"), ages, "age_group")
    risk = py_round(F.col("code_factor") * F.col("age_factor"), 3)
    return joined.select(
        "client_id",
        "name",
        "age",
        "age_group",
        "code",
        "segment",
        "message",
        "code_factor",
        "age_factor",
        risk.alias("risk"),
    )


def risk_order() -> list[Column]:
    return [F.col("risk").desc(), F.col("client_id")]


def risk_report(risks: DataFrame) -> DataFrame:
    return risks.orderBy(*risk_order())


def contact_first(risks: DataFrame, k: int = 4) -> DataFrame:
    return top_k(risks, risk_order(), k).select("name", "segment", "risk")


def low_interest(risks: DataFrame, below: float = 0.20) -> DataFrame:
    """Names not worth a budget, one per row: the list has no size limit."""
    return risks.filter(F.col("risk") < below).select("client_id", "name")


def most_profitable(risks: DataFrame) -> DataFrame:
    return top_row(risks, risk_order()).select("name", "risk")


# ---- triage -----------------------------------------------------------------


def triage(lines: DataFrame, severities: Mapping[str, int] = SEVERITIES) -> DataFrame:
    """``name|age|symptom, symptom`` lines -> name, age, symptoms, risk.

    Each symptom counts as often as it is listed; unknown ones count 0.  An
    age that is no integer stops the job.
    """
    parts = read_pipe_lines(lines)
    symptoms = F.transform(split_items("symptom_text"), snake_case)
    bad_age = F.raise_error(F.concat(F.lit("age is no integer: "), F.col("age_text")))
    right = F.when(to_int("age_text").isNotNull() | F.col("age_text").isNull(), True)
    return parts.filter(right.otherwise(bad_age.cast("boolean"))).select(
        "name",
        to_int("age_text").alias("age"),
        symptoms.alias("symptoms"),
        score_items(symptoms, severities).cast("bigint").alias("risk"),
    )


def triage_report(patients: DataFrame) -> DataFrame:
    return patients.orderBy(F.col("risk").desc(), "name")


# ---- insurance --------------------------------------------------------------


def insurance_prices(clients: DataFrame) -> DataFrame:
    """Clients (client_id, name, age, code) with category, price and fraud risk.

    The price grows by one percent per year of age and is not rounded.
    """
    levels = lookup_table(
        clients.sparkSession,
        INSURANCE_LEVELS,
        "code bigint, category string, base_price bigint, fraud double",
    )
    priced = lookup(clients, levels, "code")
    final = F.col("base_price") * (F.lit(1) + F.col("age") / 100)
    return priced.select(
        "client_id", "name", "age", "category", "base_price", final.alias("final_price"), "fraud"
    )


def insurance_order() -> list[Column]:
    return [F.col("fraud").desc(), F.col("final_price").desc(), F.col("client_id")]


def insurance_report(prices: DataFrame) -> DataFrame:
    return prices.orderBy(*insurance_order())


def insurance_findings(prices: DataFrame) -> DataFrame:
    """Three findings, found in one pass without a sort.

    ``top_price`` is the first row of the report, which is ordered by fraud
    before price; ``highest_price`` is the client with the largest price.
    """

    def best(*order: str) -> Column:
        # The smaller client_id wins a tie, hence its minus sign.
        rank = F.struct(*[F.col(c) for c in order], (-F.col("client_id")).alias("tie"))
        return F.max_by(F.struct("name", "fraud", "final_price", "category"), rank)

    found = prices.agg(
        best("fraud", "final_price").alias("first"), best("final_price").alias("priciest")
    )
    first, priciest = F.col("first"), F.col("priciest")
    rows = F.array(
        F.struct(
            F.lit("max_fraud").alias("finding"),
            first["name"].alias("name"),
            percent_label(first["fraud"]).alias("shown"),
        ),
        F.struct(
            F.lit("top_price").alias("finding"),
            first["name"].alias("name"),
            amount_label(first["final_price"]).alias("shown"),
        ),
        F.struct(
            F.lit("manual_review").alias("finding"),
            first["name"].alias("name"),
            first["category"].alias("shown"),
        ),
        F.struct(
            F.lit("highest_price").alias("finding"),
            priciest["name"].alias("name"),
            amount_label(priciest["final_price"]).alias("shown"),
        ),
    )
    return found.filter(first.isNotNull()).select(F.inline(rows))


