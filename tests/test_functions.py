import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardamom import functions as fn


def one(spark, column, **values):
    """Value of a column expression over a single row of literals."""
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (" 12 ", 12),
        ("+5", 5),
        ("-3", -3),
        ("\t7\n", 7),
        ("12.0", None),
        ("1_0", None),
        ("", None),
        ("x", None),
        ("99999999999999999999", None),
        (None, None),
    ],
)
def test_to_int(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(fn.to_int("t")).first()[0] == expected


def test_to_float(spark):
    frame = spark.createDataFrame([("1.5",), (" 2 ",), ("1e3",), ("3 EUR",), ("",), (None,)], "t string")
    got = [r[0] for r in frame.select(fn.to_float("t")).collect()]
    assert got == [1.5, 2.0, 1000.0, None, None, None]


def test_price_text(spark):
    assert float(one(spark, fn.parse_price("p"), p="$161.11")) == 161.11
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, fn.parse_price("p"), p="free")


def test_three_rounding_rules(spark):
    # Half to even on a scored product, half up on money, none on a price.
    assert one(spark, fn.py_round(F.lit(0.25) * F.lit(0.85), 3)) == 0.212
    frame = spark.createDataFrame([(1.00,), (1.01,)], "a double")
    assert frame.select(fn.rounded_mean("a")).first()[0] == 1.01


def test_exact_sum(spark):
    frame = spark.createDataFrame(
        [(0.1,), (0.2,), (-1000000.55,), (99999999.99,), (None,)], "a double"
    )
    got = [str(v) for v in frame.agg(fn.exact_sum("a"), fn.exact_sum(F.col("a").cast("decimal(10,2)"))).first()]
    assert got == ["98999999.740000"] * 2
    assert frame.filter("a IS NULL").agg(fn.exact_sum("a")).first()[0] is None


def test_exact_sum_passes_what_a_bigint_of_cents_holds(spark):
    # 2 * 10^4 rows of 9 * 10^14 are 1.8 * 10^21 cents.
    frame = spark.range(20000).select(F.lit(9e14).alias("a"))
    assert str(frame.agg(fn.exact_sum("a")).first()[0]) == "18000000000000000000.000000"


def test_mean_from_parts_equals_mean(spark):
    frame = spark.createDataFrame([(0.10,), (0.20,), (0.25,)], "a double")
    whole = frame.select(fn.rounded_mean("a")).first()[0]
    parts = frame.agg(F.sum(fn.money("a")).alias("t"), F.count("a").alias("n"))
    assert parts.select(fn.mean_of(F.col("t"), F.col("n"))).first()[0] == whole == 0.18


def test_sums_keep_fractions_of_a_cent(spark):
    frame = spark.range(1000).select(F.lit(0.004).alias("a"), F.when(F.col("id") > 0, -0.0035).alias("b"))
    got = frame.select(fn.rounded_sum("a"), fn.rounded_mean("a"), fn.rounded_sum("b")).first()
    assert tuple(got) == (4.0, 0.0, -3.5)
    for bad in (float("nan"), float("inf"), 1e300):
        with pytest.raises(Exception, match="no number that can be added up"):
            frame.select(fn.exact_sum(F.lit(bad))).collect()


def test_means_of_very_many_rows(spark):
    parts = spark.createDataFrame(
        [(999999999.99, 10**9), (1000000000.0, 10**9), (-0.01, 3), (0.0, 0), (None, 2)], "t double, n long"
    ).select(F.col("t").cast("decimal(34,6)").alias("t"), "n")
    got = parts.select(fn.mean_of(F.col("t"), F.col("n")), fn.floor_mean(F.col("t"), F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(1.0, 999999), (1.0, 1000000), (-0.0, -3334), (None, None), (None, None)]


def test_python_rounding(spark):
    rng = random.Random(1)
    values = [2.675, 0.6375, 0.75 * 0.85, -2.675, 0.5, 1.5, 2.5, -0.5, 1e15 + 0.5, 2.0**53, 123456789.125, 1e-9, -0.0]
    values += [rng.choice([1, 10, 1e4, 1e9]) * rng.random() for _ in range(2000)]
    values += [round(rng.random() * 1000, 3) / 2 for _ in range(3000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for scale in (0, 1, 2, 3, 6):
        got = [r[0] for r in frame.select(fn.py_round("v", scale)).collect()]
        assert got == [float(round(v, scale)) for v in values]
    labels = frame.limit(3).select(fn.amount_label("v"), fn.percent_label("v")).collect()
    assert [tuple(r) for r in labels] == [(f"{v:.2f} €", f"{v:.0%}") for v in values[:3]]


def test_numbers_and_flags_in_text(spark):
    frame = spark.createDataFrame(
        [("1.5", "1"), (" -2e3 ", "0"), ("1.5d", "TRUE"), ("NaN", "no"), ("Infinity", " "), ("1e999", None), (".5", "t"), ("", "f")],
        "n string, f string",
    )
    got = frame.select(fn.to_float("n"), fn.to_flag("f")).collect()
    assert [r[0] for r in got] == [1.5, -2000.0, None, None, None, None, 0.5, None]
    assert [r[1] for r in got] == [True, False, True, False, None, None, True, False]
    assert [r[0] for r in spark.createDataFrame([(1,), (0,), (None,)], "f int").select(fn.to_flag("f")).collect()] == [True, False, None]
    with pytest.raises(Exception, match="no flag: 2"):
        frame.select(fn.to_flag(F.lit("2"))).collect()


def test_pct_change_is_null_on_zero(spark):
    frame = spark.createDataFrame(
        [(3.0, 2.0), (1.0, 0.0), (1.0, None), (None, 1.0)], "now double, before double"
    )
    got = [r[0] for r in frame.select(fn.pct_change("now", "before")).collect()]
    assert got == [50.0, None, None, None]


def test_tax(spark):
    frame = spark.createDataFrame([("903.50",), (None,)], "p string")
    price = fn.money("p")
    rate = F.lit("0.21").cast("decimal(3,2)")
    got = [r[0] for r in frame.select((price + fn.calculate_tax(price, rate, 2)).cast("double")).collect()]
    # 903.50 * 0.21 = 189.735, up to 189.74
    assert got == [1093.24, None]


def test_random_offset_covers_both_ends_half_as_often(spark):
    n = 200_000
    counts = {
        r["d"]: r["n"]
        for r in spark.range(n)
        .select(fn.random_day_offset(50, 3).alias("d"))
        .groupBy("d")
        .agg(F.count("*").alias("n"))
        .collect()
    }
    assert sorted(counts) == list(range(51))
    assert 0.4 < counts[0] / (n / 50) < 0.6
    assert 0.4 < counts[50] / (n / 50) < 0.6
    assert 0.9 < counts[25] / (n / 50) < 1.1


def test_text(spark):
    assert one(spark, fn.trim_space("t"), t="\t  a b \n") == "a b"
    assert one(spark, fn.snake_case("t"), t=" Fiebre  ALTA ") == "fiebre__alta"
    assert one(spark, fn.strip_text("t", "WH-"), t="WH-4") == "4"
    assert one(spark, fn.percent_label(F.lit(0.3))) == "30%"
    assert one(spark, fn.percent_label(F.lit(0.005))) == "0%"
    assert one(spark, fn.amount_label(F.lit(775))) == "775.00 €"


@pytest.mark.parametrize(("text", "ok"), [("abc", True), ("ab1", False), ("abc\n", False), ("", False)])
def test_full_match_covers_the_whole_text(spark, text, ok):
    assert one(spark, fn.full_match("t", "[a-z]+"), t=text) is ok


def test_date_parsing(spark):
    assert one(spark, fn.parse_month_name_date("t"), t="Nov 7, 1985") == dt.date(1985, 11, 7)
    assert one(spark, fn.parse_month_name_date("t"), t="Nov 07, 1985") == dt.date(1985, 11, 7)
    assert one(spark, fn.parse_iso_date("t"), t="2024-03-13") == dt.date(2024, 3, 13)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("10/30/22", dt.date(2022, 10, 30)),
        ("01/02/69", dt.date(2069, 1, 2)),
        ("01/02/70", dt.date(1970, 1, 2)),
        ("02/29/72", dt.date(1972, 2, 29)),
        ("12/31/99", dt.date(1999, 12, 31)),
        ("02/29/00", dt.date(2000, 2, 29)),
    ],
)
def test_two_digit_years(spark, text, expected):
    assert one(spark, fn.parse_short_us_date("t"), t=text) == expected


def test_day_and_year_ranges_equal_truncation(spark):
    stamps = [
        "2021-12-31 23:59:59.999999",
        "2022-01-01 00:00:00",
        "2022-03-12 00:00:00",
        "2022-03-12 23:59:59.999999",
        "2022-03-13 00:00:00",
        "2022-12-31 23:59:59.999999",
        "2023-01-01 00:00:00",
    ]
    frame = spark.createDataFrame([(s,) for s in stamps], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("ts"), F.col("s").cast("timestamp").alias("tz")
    )
    for ts in ("ts", "tz"):
        checks = frame.select(
            fn.on_day(ts, "2022-03-12") == (F.to_date(ts) == F.lit("2022-03-12").cast("date")),
            fn.in_year(ts, 2022) == (F.year(ts) == 2022),
            fn.in_days(ts, ["2022-01-01", "2022-03-13"])
            == F.to_date(ts).isin(dt.date(2022, 1, 1), dt.date(2022, 3, 13)),
        )
        assert all(all(r) for r in checks.collect())
    assert frame.filter(fn.in_days("ts", [])).count() == 0


def test_since_and_days_before(spark):
    as_of = dt.datetime(2024, 3, 1, 12, 30)
    frame = spark.range(3).select(fn.days_before(as_of, F.col("id").cast("int")).alias("ts"))
    assert [r[0] for r in frame.collect()] == [as_of - dt.timedelta(days=d) for d in range(3)]
    assert frame.filter(fn.since("ts", as_of, 1)).count() == 2


def test_time_of_day(spark):
    stamp = F.lit("2024-01-01 07:05:09.5").cast("timestamp_ntz")
    assert one(spark, fn.time_of_day(stamp)) == "07:05:09"


LISTS = [("1, 2, 3",), ("7",), (" 4 ,4",), ("1,x,3",), ("",), ("  ",), (None,), ("1,,2",)]


def lists(spark, column):
    frame = spark.createDataFrame(LISTS, "t string")
    return [r[0] for r in frame.select(column).collect()]


def test_int_lists_drop_bad_items(spark):
    got = lists(spark, fn.parse_int_list("t", on_bad="drop"))
    assert got == [[1, 2, 3], [7], [4, 4], [1, 3], [], [], [], [1, 2]]


def test_int_lists_keep_bad_items_as_null(spark):
    got = lists(spark, fn.parse_int_list("t", on_bad="null"))
    assert got == [[1, 2, 3], [7], [4, 4], [1, None, 3], [], [], [], [1, None, 2]]


def test_int_lists_can_fail(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        lists(spark, fn.parse_int_list("t", on_bad="fail"))
    with pytest.raises(ValueError, match="on_bad"):
        fn.parse_int_list("t", on_bad="ignore")


def test_well_formed_lists_read_as_json(spark):
    assert lists(spark, fn.is_int_list("t")) == [True, True, True, False, True, True, None, False]
    frame = spark.createDataFrame(LISTS, "t string").filter(fn.is_int_list("t"))
    assert [r[0] for r in frame.select(fn.json_items("t")).collect()] == [[1, 2, 3], [7], [4, 4], [], []]
    with pytest.raises(Exception, match="MALFORMED_RECORD|malformed"):
        lists(spark, fn.json_items("t"))


@pytest.mark.parametrize("sep", [",", "|", ";", "\t", "."])
def test_separators_are_literal(spark, sep):
    assert one(spark, fn.split_items("t", sep), t=f"a{sep}b{sep}") == ["a", "b", ""]


def test_score_counts_repeats_and_unknown(spark):
    scores = {"tos": 1, "fiebre": 3}
    items = F.array(F.lit("tos"), F.lit("tos"), F.lit("fiebre"), F.lit("otro"))
    assert one(spark, fn.score_items(items, scores)) == 5
    assert one(spark, fn.score_items(items, scores, default=10)) == 15


def test_decimals_are_added_up_without_doubles(spark):
    from decimal import Decimal

    big = Decimal("12345678901234567.89")
    rows = [(big, 1.25), (Decimal("-0.55"), 2.5), (None, None)] + [(Decimal("0.01"), 0.0)] * 3
    frame = spark.createDataFrame(rows, "d decimal(20,2), x double")
    got = frame.agg(fn.exact_sum("d").alias("d"), fn.exact_sum("x").alias("x"), fn.exact_sum(-F.col("d")).alias("m"), fn.exact_sum(F.col("d").cast("decimal(38,12)")).alias("w")).first()
    assert got["d"] == big - Decimal("0.52") and got["x"] == Decimal("3.75") and got["m"] == Decimal("0.52") - big and got["w"] == got["d"]
    assert frame.where("d is null").agg(fn.exact_sum("d")).first()[0] is None
    assert spark.sql("SELECT 7 AS i").agg(fn.exact_sum("i")).first()[0] == 7
