"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardamom.functions.rounding import py_round


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_space(c: Column | str) -> Column:
    """Strip every kind of white space; a bare ``trim`` strips only U+0020."""
    return F.regexp_replace(_col(c), r"(?U)\A\s+|\s+\z", "")


def strip_text(c: Column | str, token: str) -> Column:
    """Remove every occurrence of a literal token, e.g. ``$`` or ``WH-``."""
    return F.replace(_col(c).cast("string"), F.lit(token), F.lit(""))


def snake_case(c: Column | str) -> Column:
    """Trimmed, lower case, each inner blank one underscore."""
    return F.replace(F.lower(trim_space(c)), F.lit(" "), F.lit("_"))


def full_match(c: Column | str, pattern: str) -> Column:
    r"""True when the whole text matches.

    ``rlike`` searches, so the pattern is anchored; ``\z`` rather than ``$``
    because ``$`` also accepts a trailing line break.
    """
    return _col(c).rlike(rf"(?U)\A(?:{pattern})\z")


def percent_label(share: Column | str) -> Column:
    """0.3 -> ``30%``; halves go to the even neighbour."""
    return F.format_string("%.0f%%", py_round(_col(share).cast("double") * 100, 0))


def amount_label(amount: Column | str, unit: str = "€") -> Column:
    """775.0 -> ``775.00 €``; 2.675, a little less in binary, -> ``2.67 €``."""
    return F.format_string(f"%.2f {unit}", py_round(amount, 2))
