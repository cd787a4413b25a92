"""Measures, publication status, shares and ordinals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arealoom.functions import vocab
from arealoom.functions.text import _col, trim_all

__all__ = [
    "map_values", "parse_bool", "parse_measure", "pct", "plain_number", "publication_status",
    "size_mb", "sum_null_safe",
]

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _to_double(text: Column) -> Column:
    """A matched number or nothing; nothing is made null first, as a failing cast is slow."""
    return F.nullif(text, F.lit("")).try_cast("double")


def plain_number(c) -> Column:
    """Text to double, null for anything that is not a plain decimal number."""
    return _to_double(F.regexp_extract(trim_all(_col(c).cast("string")), _NUMBER, 0))


def parse_measure(c, suppressed=None) -> Column:
    """Published figure to double. Thousands separators, ``$`` and ``%`` are dropped; suppressed
    tokens and ``<n`` or ``>n`` cells stay null, never the bare number.

    Only a plain number survives the last step, so the usual suppressed tokens need no test;
    ``suppressed`` adds tokens that look like numbers, such as ``999``."""
    text = F.trim(F.regexp_replace(_col(c).cast("string"), r"^\s+|\s+$|[,$%]", ""))
    number = F.regexp_extract(text, _NUMBER, 0)
    if suppressed:
        hidden = "^(" + "|".join("\\Q" + t + "\\E" for t in suppressed) + ")$"
        number = F.regexp_replace(number, hidden, "")
    return _to_double(number)


def publication_status(c) -> Column:
    """Why a published cell has, or lacks, a number."""
    text = F.lower(trim_all(F.coalesce(_col(c).cast("string"), F.lit(""))))
    return (
        F.when(text.isin(vocab.NOT_PUBLISHED), "not_published")
        .when(text.isin(vocab.NOT_AVAILABLE), "not_available")
        .when(parse_measure(text).isNotNull(), "published_numeric")
        .otherwise("published_non_numeric")
    )


def parse_bool(c) -> Column:
    text = F.lower(trim_all(_col(c).cast("string")))
    return F.when(text.isin("true", "1"), F.lit(True)).when(text.isin("false", "0"), F.lit(False))


def map_values(c, mapping: dict, default=None) -> Column:
    """Look a value up in a small fixed mapping."""
    if not mapping:
        return F.lit(default)
    keys = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(keys, _col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def pct(numerator, denominator, digits: int | None = None) -> Column:
    """Percentage, null where the denominator is zero; rounding is half-up."""
    value = F.try_divide(_col(numerator) * 100.0, _col(denominator).cast("double"))
    return value if digits is None else F.round(value, digits)


def size_mb(c) -> Column:
    return F.round(_col(c) / F.lit(1048576.0), 6)


def sum_null_safe(c, zero_if_all_null: bool = False) -> Column:
    """Sum that is null when every input is null; pass ``zero_if_all_null`` for zero instead."""
    total = F.sum(_col(c))
    return F.coalesce(total, F.lit(0.0)) if zero_if_all_null else total
