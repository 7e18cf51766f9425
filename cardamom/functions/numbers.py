"""Numeric expressions: exact money, three rounding rules, safe division."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardamom.functions.text import _col, strip_text

SCALE = 6  # decimals that amounts are added up with
MONEY = f"decimal(28,{SCALE})"


def money(c: Column | str) -> Column:
    """Amount as an exact decimal.

    Tables keep ``amount`` as read so filters on it reach the parquet scan.
    Sums go through :func:`exact_sum`, which is faster.
    """
    return _col(c).cast(MONEY)


def _finite(x: Column) -> Column:
    """``x`` as double; what is no finite number of a size that fits stops the job."""
    x = x.cast("double")
    bad = F.raise_error(F.concat(F.lit("amount is no number that can be added up: "), x.cast("string")))
    return F.when(F.abs(x) < F.lit(9e18), x).when(x.isNotNull(), bad.cast("double"))


def units(c: Column | str, scale: int = SCALE) -> Column:
    """Amount as a whole number of units of ``10 ** -scale``, up to 9 * 10^18 of them."""
    return _finite(F.rint(_col(c).cast("double") * 10**scale)).cast("bigint")


def exact_sum(c: Column | str, scale: int = SCALE) -> Column:
    """Sum of an amount, each taken to ``scale`` decimals, as ``decimal(34,scale)``.

    Nothing else is rounded, so reports round once, at the end.  Adding
    decimals costs an object per row; adding integers does not and is about as
    fast as adding doubles.  Whole amounts are added up in two halves (above
    and below 2^16), fractions by themselves, and all are put together once per
    group.  That holds for more than 10^12 rows of the largest amount.

    Decimals are cut into whole part and fraction as decimals, as a double has
    only 15 digits.  The type is known only when the query is analysed; the
    branch for the other one is then folded away.
    """
    x, d = _finite(_col(c)), _col(c).cast(f"decimal(38,{scale})")
    is_decimal = F.typeof(_col(c)).startswith("decimal")
    whole = F.when(is_decimal, F.floor(d).cast("bigint")).otherwise(F.floor(x))
    fraction = F.when(is_decimal, ((d - F.floor(d)) * 10**scale).cast("bigint"))
    part = fraction.otherwise(F.rint((x - F.floor(x)) * 10**scale).cast("bigint"))
    high = F.sum(F.shiftright(whole, 16)).cast("decimal(20,0)")
    low = F.sum(whole.bitwiseAND(F.lit(0xFFFF))).cast("decimal(20,0)")
    total = (high * F.lit(1 << 16) + low).cast(f"decimal(38,{scale})")
    parts = F.sum(part).cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))
    return (total + parts).cast(f"decimal(34,{scale})")


def rounded_sum(c: Column | str, scale: int = 2) -> Column:
    """Sum of an amount, rounded half up once, as a double."""
    return F.round(exact_sum(c), scale).cast("double")


def rounded_mean(c: Column | str) -> Column:
    """Mean of an amount rounded half up to two decimals."""
    return mean_of(exact_sum(c), F.count(_col(c)))


def mean_of(total: Column, n: Column, scale: int = 2) -> Column:
    """``total / n`` rounded half up, from an exact total and a count.

    Taking both parts lets a plan add up per key first and average later,
    after the join.  The quotient is one of whole numbers: a decimal quotient
    would be rounded to some decimals before it is rounded again.
    """
    whole = (F.abs(total.cast(f"decimal(34,{SCALE})")) * F.lit(Decimal(10**SCALE))).cast("decimal(36,0)")
    step = (n.cast("decimal(19,0)") * F.lit(Decimal(10 ** (SCALE - scale)))).cast("decimal(30,0)")
    mean = F.call_function("div", whole * 2 + step, step * 2)
    mean = mean.cast("double") / 10**scale
    return F.when(n > 0, F.when(total < 0, -mean).otherwise(mean))


def floor_mean(total: Column, n: Column) -> Column:
    """The largest whole number of units (see :func:`units`) that does not exceed the mean."""
    whole = (total * F.lit(Decimal(10**SCALE))).cast("decimal(36,0)")
    n = n.cast("decimal(19,0)")
    down = F.when(whole < 0, -F.call_function("div", n - 1 - whole, n)).otherwise(F.call_function("div", whole, n))
    return F.when(n > 0, down)


def parse_price(c: Column | str, symbol: str = "$") -> Column:
    """``$161.11`` -> 161.11; text that is not a price raises in ANSI mode."""
    return strip_text(c, symbol).cast(MONEY)


# An integer in text, outer blanks allowed as in a cast.
_INTEGER = r"\A\s*[+-]?[0-9]+\s*\z"


def to_int(c: Column | str) -> Column:
    """Integer or NULL.  Accepts outer blanks and a sign, not ``12.0``.

    A failing cast costs an exception per value; the pattern sorts out what is
    no number first.
    """
    text = _col(c).cast("string")
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


# A decimal number in text; neither "NaN", "Infinity" nor a type suffix as in "1.5d".
_NUMBER = r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"


def to_float(c: Column | str) -> Column:
    """Finite floating-point number or NULL."""
    text = _col(c).cast("string")
    value = text.try_cast("double")
    return F.when(text.rlike(_NUMBER) & (F.abs(value) < float("inf")), value)


def to_flag(c: Column | str) -> Column:
    """A flag written 0/1, true/false, t/f, yes/no or y/n, of any type; other texts stop the job.

    NULL and blank are NULL.
    """
    text = F.lower(F.trim(_col(c).cast("string")))
    bad = F.raise_error(F.concat(F.lit("no flag: "), text)).cast("boolean")
    return (
        F.when(text.isin("1", "true", "t", "yes", "y"), True)
        .when(text.isin("0", "false", "f", "no", "n"), False)
        .when(text != "", bad)
    )


def pct_change(now: Column | str, before: Column | str) -> Column:
    """Percent change; NULL when ``before`` is zero or NULL, never an error."""
    now, before = _col(now), _col(before)
    return F.try_divide(now - before, before) * 100


def calculate_tax(base: Column | str, rate: Column, decimals: int) -> Column:
    """Tax on an amount, rounded half up; NULL in, NULL out."""
    return F.round(_col(base) * rate, decimals)


def random_day_offset(max_days: int, seed: int) -> Column:
    """Random whole days, 0..max_days; rounding makes both ends half as likely."""
    return F.round(F.rand(seed) * max_days).cast("int")
