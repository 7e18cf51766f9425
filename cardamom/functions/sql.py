"""Functions for users who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_sql_functions(spark: SparkSession) -> None:
    """Create the session's SQL functions: ``calculate_tax(base, rate, decimals)``.

    All in doubles, halves away from zero, any number of decimals (negative
    ones round before the point); NULL in, NULL out.
    """
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION calculate_tax"
        "(base DOUBLE, rate DOUBLE, decimals INT) RETURNS DOUBLE "
        # From 2^52 on a double has no decimals left to round.  The rest beyond the
        # whole part is exact; adding a half to the product first would not be.
        "RETURN CASE WHEN abs(base * rate) * pow(10, decimals) < pow(2, 52) "
        "THEN signum(base * rate) * (floor(abs(base * rate) * pow(10, decimals)) + CASE WHEN "
        "abs(base * rate) * pow(10, decimals) - floor(abs(base * rate) * pow(10, decimals)) >= 0.5D "
        "THEN 1 ELSE 0 END) / pow(10, decimals) "
        "WHEN decimals IS NOT NULL THEN base * rate END"
    )
