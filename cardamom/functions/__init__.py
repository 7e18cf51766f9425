"""Column expressions.  All of them stay in the JVM; none is a Python UDF."""

from cardamom.functions.dates import (
    days_before,
    in_days,
    in_year,
    on_day,
    parse_iso_date,
    parse_month_name_date,
    parse_short_us_date,
    since,
    time_of_day,
)
from cardamom.functions.lists import (
    bad_items,
    is_int_list,
    json_items,
    parse_int_list,
    score_items,
    split_items,
)
from cardamom.functions.numbers import (
    calculate_tax,
    exact_sum,
    floor_mean,
    mean_of,
    money,
    parse_price,
    pct_change,
    random_day_offset,
    rounded_mean,
    rounded_sum,
    to_flag,
    to_float,
    to_int,
    units,
)
from cardamom.functions.rounding import py_round
from cardamom.functions.sql import register_sql_functions
from cardamom.functions.text import (
    amount_label,
    full_match,
    percent_label,
    snake_case,
    strip_text,
    trim_space,
)

__all__ = [
    "amount_label",
    "bad_items",
    "calculate_tax",
    "days_before",
    "exact_sum",
    "floor_mean",
    "full_match",
    "in_days",
    "in_year",
    "is_int_list",
    "json_items",
    "mean_of",
    "money",
    "on_day",
    "parse_int_list",
    "parse_iso_date",
    "parse_month_name_date",
    "parse_price",
    "parse_short_us_date",
    "pct_change",
    "percent_label",
    "py_round",
    "random_day_offset",
    "register_sql_functions",
    "rounded_mean",
    "rounded_sum",
    "score_items",
    "since",
    "snake_case",
    "split_items",
    "strip_text",
    "time_of_day",
    "to_flag",
    "to_float",
    "to_int",
    "trim_space",
    "units",
]
