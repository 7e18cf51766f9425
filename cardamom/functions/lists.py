"""Delimited-text and array expressions (basket lists, symptom lists)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardamom.functions.numbers import to_int
from cardamom.functions.text import _col, full_match, trim_space

# Integers as JSON writes them, with JSON's own blanks around them.
_BLANK = r"[ \t\r\n]*"
_INT = rf"{_BLANK}-?(0|[1-9][0-9]*){_BLANK}"
_INT_LIST = rf"{_BLANK}|{_INT}(,{_INT})*"


def split_items(c: Column | str, sep: str = ",") -> Column:
    """Split on a literal one-character separator (``split`` takes a regex)."""
    if len(sep) != 1:
        raise ValueError(f"separator must be one character: {sep!r}")
    return F.split(_col(c).cast("string"), sep if sep.isalnum() else "\\" + sep, -1)


def parse_int_list(c: Column | str, sep: str = ",", *, on_bad: str) -> Column:
    """``"1, 2, 3"`` -> ``[1, 2, 3]``; NULL or blank text gives an empty array.

    ``on_bad`` says what happens to an item that is no integer: ``drop`` it
    (:func:`bad_items` lists what goes), keep it as ``null``, or ``fail`` the job.
    """
    empty = F.array().cast("array<bigint>")
    items = split_items(c, sep)
    if on_bad == "drop":
        numbers = F.filter(F.transform(items, to_int), lambda x: x.isNotNull())
        return F.coalesce(numbers, empty)
    if on_bad == "null":
        numbers = F.transform(items, to_int)
    elif on_bad == "fail":
        numbers = F.transform(items, lambda x: trim_space(x).cast("bigint"))
    else:
        raise ValueError(f"on_bad: {on_bad!r}")
    return F.when(trim_space(c) != "", numbers).otherwise(empty)


def bad_items(c: Column | str, sep: str = ",") -> Column:
    """The items of a list text that are no integer, as texts; none for NULL or blank text."""
    bad = F.filter(split_items(c, sep), lambda x: to_int(x).isNull())
    return F.when(trim_space(c) != "", bad).otherwise(F.array().cast("array<string>"))


def is_int_list(c: Column | str) -> Column:
    """True for text that is a well-formed, possibly empty, integer list."""
    return full_match(c, _INT_LIST)


def json_items(c: Column | str, item_type: str = "bigint") -> Column:
    """Read ``"1, 2, 3"`` as the JSON array ``[1, 2, 3]``.

    One bad item makes the whole array invalid, and that fails the job; test
    with :func:`is_int_list` first where such rows must be set aside.
    """
    text = F.concat(F.lit("["), _col(c), F.lit("]"))
    # A NULL list has no items, so explode drops it like an empty one.
    return F.from_json(text, f"array<{item_type}>", {"mode": "FAILFAST"})


def score_items(items: Column | str, scores: Mapping[str, int], default: int = 0) -> Column:
    """Sum of each item's score; repeats count again, unknown items ``default``.

    ``scores`` is a fixed dictionary of a few entries and becomes a literal map.
    """
    table = F.create_map(*[F.lit(x) for kv in scores.items() for x in kv])
    points = F.transform(_col(items), lambda x: F.coalesce(table[x], F.lit(default)))
    return F.aggregate(points, F.lit(0), lambda acc, x: acc + x)
