"""Codes, names, slugs, paths and links."""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealoom.functions import vocab

__all__ = [
    "alnum_key", "bind", "clean_text", "column_letters", "count_links", "distinct_list", "extract_code",
    "key_tokens", "name_key", "norm_code", "norm_year", "path_parts", "short_code", "short_label",
    "slug", "strip_tags", "to_json_notes", "trim_all",
]

_BOM = "﻿"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it. Conditional
    branches are not covered by common-subexpression elimination, so a costly value that several
    branches need is bound first."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def trim_all(c) -> Column:
    """Trim every kind of ASCII whitespace, not only spaces."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


# The null tokens of codes, blank apart, as one pattern.
_NULL_TOKEN = "(?i)^(" + "|".join(t for t in vocab.NULL_CODES if t) + ")$"


def norm_code(c, mode: str = "compact") -> Column:
    """Area code as text: trimmed, without BOM, null tokens or a trailing ``.0``.

    ``mode``: ``keep`` leaves inner text alone, ``compact`` drops whitespace, ``alnum`` keeps upper
    case letters and digits, ``digits`` keeps digits. Two or three replacements, each done once.
    """
    text = _col(c).cast("string")
    if mode == "compact":
        text = F.regexp_replace(text, rf"[\s{_BOM}]+", "")
    else:
        text = F.regexp_replace(text, rf"^[\s{_BOM}]+|[\s{_BOM}]+$|{_BOM}", "")
    text = F.regexp_replace(text, _NULL_TOKEN + r"|\.0$", "")
    if mode == "alnum":
        text = F.regexp_replace(F.upper(text), "[^A-Z0-9]+", "")
    elif mode == "digits":
        text = F.regexp_replace(text, "[^0-9]+", "")
    elif mode not in ("keep", "compact"):
        raise ValueError(f"unknown code mode {mode!r}")
    return F.nullif(text, F.lit(""))


def slug(c, max_len: int = 140, variant: str = "and", empty: str = "unnamed") -> Column:
    """Snake-case name. Variants: ``plain``; ``and`` spells out ``&``; ``symbols`` also spells out
    ``%`` and ``$``; ``bare`` is ``symbols`` without bracketed text."""
    text = F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    if variant == "bare":
        text = F.regexp_replace(text, r"\([^)]*\)", " ")
    if variant != "plain":
        text = F.replace(text, F.lit("&"), F.lit(" and "))
    if variant in ("symbols", "bare"):
        text = F.replace(text, F.lit("%"), F.lit(" pct "))
        text = F.replace(text, F.lit("$"), F.lit(" dollar "))
    text = F.btrim(F.regexp_replace(text, "[^a-z0-9]+", "_"), F.lit("_"))
    if empty:
        text = F.coalesce(F.nullif(text, F.lit("")), F.lit(empty))
    return F.rtrim(F.substring(text, 1, max_len), F.lit("_"))


def key_slug(c, max_len: int = 140, variant: str = "and", empty: str = "unnamed") -> Column:
    """``slug`` for names that tell rows apart: one that would be cut ends in eight digits of a hash of
    the whole text."""
    whole = slug(c, 1 << 20, variant, empty)
    short = F.rtrim(F.substring(whole, 1, max_len - 9), F.lit("_"))
    digest = F.substring(F.md5(_col(c).cast("string")), 1, 8)
    return F.when(F.length(whole) <= max_len, whole).otherwise(F.concat_ws("_", short, digest))


def alnum_key(c) -> Column:
    return F.regexp_replace(F.lower(_col(c).cast("string")), "[^a-z0-9]+", "")


def name_key(c, stop_phrases=None) -> Column:
    """Matching key of an area name: no bracketed text, punctuation or administrative words."""
    phrases = "|".join(stop_phrases or vocab.AREA_STOP_PHRASES)
    text = F.lower(trim_all(F.coalesce(_col(c).cast("string"), F.lit(""))))
    text = F.replace(text, F.lit("&"), F.lit(" and "))
    text = F.regexp_replace(text, r"\([^)]*\)", " ")
    text = F.regexp_replace(text, rf"\b({phrases})\b", " ")
    return trim_all(F.regexp_replace(text, "[^a-z0-9]+", " "))


def clean_text(c) -> Column:
    """Collapse whitespace; null tokens become null."""
    text = F.trim(F.regexp_replace(_col(c).cast("string"), rf"[\s{_BOM}]+", " "))
    return F.nullif(F.regexp_replace(text, _NULL_TOKEN, ""), F.lit(""))


def extract_code(c, pattern: str = r"(\d{3,9})", width: int | None = None) -> Column:
    """First match of ``pattern``, else the text itself; all-digit codes are zero-padded."""
    text = F.regexp_replace(F.trim(_col(c).cast("string")), r"^\s+|\s+$|\.0\s*$", "")
    code = bind(text, lambda t: F.coalesce(F.nullif(F.regexp_extract(t, pattern, 1), F.lit("")), t))
    if width:
        short = f"^[0-9]{{1,{max(1, width - 1)}}}$"
        code = bind(code, lambda t: F.when(t.rlike(short), F.lpad(t, width, "0")).otherwise(t))
    return F.nullif(F.regexp_replace(code, _NULL_TOKEN, ""), F.lit(""))


def short_code(c) -> Column:
    """First digit and last four digits of a hierarchical code of five digits or more."""
    return F.nullif(
        F.regexp_replace(F.regexp_replace(norm_code(c, "digits"), "^.{0,4}$", ""), "^(.).*(.{4})$", "$1$2"),
        F.lit(""),
    )


# Shape of an embedded code per target level.
_TOKEN_SHAPES = {
    "SA2": r"(?<!\d)\d{9}(?!\d)",
    "LGA": r"(?<!\d)\d{4,5}(?!\d)",
    "PHN": r"(?i)\bPHN\s*\d{1,3}\b|(?<!\d)\d{1,3}(?!\d)",
}


def key_tokens(c, target: str) -> Column:
    """Distinct join keys a cell may hold: the whole cell, then codes embedded in it. A ``name``
    target gives the single name key."""
    text = _col(c).cast("string")
    if target.lower().endswith("name"):
        key = name_key(text)
        return F.when(key != "", F.array(key)).otherwise(F.array().cast("array<string>"))
    exact = F.array(norm_code(text))
    shape = _TOKEN_SHAPES.get(target.upper())
    tokens = exact if shape is None else F.concat(
        exact,
        F.transform(
            F.coalesce(
                F.regexp_extract_all(text, F.lit(shape), F.lit(0)), F.array().cast("array<string>")
            ),
            lambda token: norm_code(token),
        ),
    )
    return F.array_distinct(F.array_compact(tokens))


def norm_year(c) -> Column:
    """Financial-year label with a plain hyphen."""
    return trim_all(F.translate(_col(c).cast("string"), "–—", "--"))


def short_label(c, phrases=(" of Australia", " Australia")) -> Column:
    text = _col(c)
    for phrase in phrases:
        text = F.replace(text, F.lit(phrase), F.lit(""))
    return text


# The character references seen in link labels.
_ENTITIES = [
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ("&apos;", "'"), ("&amp;", "&"),
]


@F.pandas_udf(T.StringType())
def _unescape_all(text: pd.Series) -> pd.Series:
    return text.map(_html.unescape, na_action="ignore")


def strip_tags(c, all_entities: bool = False) -> Column:
    """Text without tags, with character references decoded and whitespace collapsed.
    ``all_entities`` decodes every named and numeric reference through an Arrow batch."""
    text = F.regexp_replace(_col(c), "<[^>]+>", " ")
    if all_entities:
        text = _unescape_all(text)
    else:
        for entity, plain in _ENTITIES:
            text = F.replace(text, F.lit(entity), F.lit(plain))
    return trim_all(F.regexp_replace(text, r"[\s ]+", " "))


def path_parts(c, root: str = "") -> dict[str, Column]:
    """Columns for the parts of a path; either separator is accepted."""
    path = F.replace(_col(c), F.lit("\\"), F.lit("/"))
    prefix = root.replace("\\", "/").rstrip("/") + "/" if root else ""
    relative = path
    if prefix:
        inside = F.startswith(path, F.lit(prefix))
        relative = F.when(inside, F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)
    name = F.substring_index(path, "/", -1)
    return {
        "relative_path": relative,
        "file_name": name,
        "file_extension": F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)),
        "top_folder": F.when(F.contains(relative, F.lit("/")), F.substring_index(relative, "/", 1))
        .otherwise(F.lit("")),
    }


def count_links(c, distinct: bool = True) -> Column:
    links = F.regexp_extract_all(_col(c), F.lit("(?i)https?://[^\\s\"'<>]+"), F.lit(0))
    return F.size(F.array_distinct(links) if distinct else links)


def column_letters(c) -> Column:
    """Spreadsheet letters of a 1-based column index up to three letters (18,278 columns)."""
    n = _col(c).cast("int")

    def letter(x):
        return F.char(F.lit(65) + x)

    one = letter(n - 1)
    m = n - 27
    two = F.concat(letter(F.floor(m / 26)), letter(m % 26))
    k = n - 703
    three = F.concat(letter(F.floor(k / 676)), letter(F.floor(k / 26) % 26), letter(k % 26))
    return (
        F.when(n.between(1, 26), one)
        .when(n.between(27, 702), two)
        .when(n.between(703, 18278), three)
    )


def distinct_list(c) -> Column:
    """Array without repeats or nulls, first occurrence kept."""
    return F.array_distinct(F.array_compact(_col(c)))


def to_json_notes(**values) -> Column:
    return F.to_json(F.struct(*[_col(v).alias(k) for k, v in values.items()]))
