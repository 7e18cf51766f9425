"""Candidate intake: validate, score, band, report.

Input: one row per candidate with ``seq`` (input order, unique) and the six
text fields below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardamom.functions import to_int, trim_space
from cardamom.operators import Rule, number_rows, split_valid, top_k

FIELDS = ["name", "phone", "experience", "catalan", "excel", "degree"]

# Accepted letters, level labels, band labels and limits, reasons.
NAME_PATTERN = r"[a-zA-ZáéíóúÁÉÍÓÚàèìòùÀÈÌÒÙäëïöüÄËÏÖÜñÑçÇ\s-]+"
CATALAN_LEVELS = ["sense coneixement", "fins a nivell B1", "nivell B2", "C1 o superior"]
EXCEL_LEVELS = ["nivell basic", "ús de funcions", "taules dinàmiques", "Visual Basic i Macros"]
DEGREES = ["ESO", "FP", "Universitat", "Master o superior"]
BANDS = ["Prioritat alta", "Candidat adequat", "No prioritari"]
BAND_FROM = [12, 8]
POINTS_PER_YEAR = 1.5
NAME_EMPTY = "el nombre no puede estar vacío."
NAME_SYMBOLS = "el nombre no puede contener números ni símbolos."
PHONE_EMPTY = "el teléfono no puede estar vacío."
PHONE_BLANK = "el teléfono no puede contener espacios en blanco."
PHONE_LENGTH = "el formato del teléfono es incorrecto (debe tener 9 dígitos)."
PHONE_DIGITS = "el teléfono debe contener solo números."
NOT_A_NUMBER = "debes escribir un número entero."
EXPERIENCE_RANGE = "la experiencia debe estar entre 0 y 50 años."
LEVEL_RANGE = "debes escribir una opción entre 0 y 3."


def typed(raw: DataFrame) -> DataFrame:
    """The raw rows with trimmed texts (``*_text``) and numbers (``*_int``) beside them."""
    texts = {f"{f}_text": trim_space(f) for f in FIELDS[:2]}
    return raw.withColumns(texts | {f"{f}_int": to_int(f) for f in FIELDS[1:]})


def rules() -> list[Rule]:
    """All checks in the order they apply; the first broken one rejects the row."""
    checks = [
        Rule("name", "name_text <> ''", NAME_EMPTY),
        Rule("name", rf"name_text RLIKE r'(?U)\A{NAME_PATTERN}\z'", NAME_SYMBOLS),
        Rule("phone", "phone_text <> ''", PHONE_EMPTY),
        Rule("phone", "NOT contains(phone_text, ' ')", PHONE_BLANK),
        Rule("phone", "length(phone_text) = 9", PHONE_LENGTH),
        Rule("phone", "phone_int IS NOT NULL", PHONE_DIGITS),
        Rule("experience", "experience_int IS NOT NULL", NOT_A_NUMBER),
        Rule("experience", "experience_int BETWEEN 0 AND 50", EXPERIENCE_RANGE),
    ]
    for field in ("catalan", "excel", "degree"):
        checks.append(Rule(field, f"{field}_int IS NOT NULL", NOT_A_NUMBER))
        checks.append(Rule(field, f"{field}_int BETWEEN 0 AND 3", LEVEL_RANGE))
    return checks


def _label(field: str, labels: list[str]) -> str:
    texts = ", ".join(f"'{text}'" for text in labels)
    return f"array({texts})[CAST({field}_int AS int)] AS {field}_level"


def _scored(valid: DataFrame) -> DataFrame:
    high, fit = BAND_FROM
    scored = valid.selectExpr(
        "seq",
        "name_text AS name",
        *[f"{f}_int AS {f}" for f in FIELDS[1:]],
        _label("catalan", CATALAN_LEVELS),
        _label("excel", EXCEL_LEVELS),
        _label("degree", DEGREES),
        f"experience_int * {POINTS_PER_YEAR}D + catalan_int + excel_int + degree_int AS score",
    )
    band = (
        F.when(F.col("score") >= high, BANDS[0])
        .when(F.col("score") >= fit, BANDS[1])
        .otherwise(BANDS[2])
    )
    return scored.withColumn("band", band)


def _rejects(invalid: DataFrame) -> DataFrame:
    return invalid.selectExpr(
        "seq", "name AS candidate", "error.field", "error.value", "error.reason"
    )


def intake(raw: DataFrame, max_accepted: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted and scored, rejected with field, value and reason).

    With ``max_accepted`` intake stops, in input order, once so many rows are
    accepted; later rows are neither accepted nor rejected.
    """
    valid, invalid = split_valid(typed(raw), rules())
    if max_accepted is None:
        return _scored(valid), _rejects(invalid)
    first = top_k(valid, [F.col("seq")], max_accepted)
    full = first.agg(F.when(F.count("*") == max_accepted, F.max("seq")).alias("last"))
    last = full.scalar()
    seen = invalid.filter(last.isNull() | (F.col("seq") < last))
    return _scored(first), _rejects(seen)


def report_order() -> list[Column]:
    """Band weight, score, then the record itself, all descending."""
    weight = F.when(F.col("band") == BANDS[0], 3).when(F.col("band") == BANDS[1], 2).otherwise(1)
    record = ["name", "phone", "experience", "catalan_level", "excel_level", "degree_level"]
    return [weight.desc(), *[F.col(c).desc() for c in ["score", *record]], F.col("seq")]


def report(accepted: DataFrame) -> DataFrame:
    """The ranked report with its position numbers."""
    ranked = number_rows(accepted, report_order(), key="seq")
    return ranked.select("position", "name", "phone", "score", "band")
