"""Row filters shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.operators.audit import ContractError
from arealoom.operators.reshape import spec_condition
from arealoom.session import col_name


def filter_code(df: DataFrame, col: str, digits: str = "9") -> DataFrame:
    """Codes of the given number of digits, for example ``9`` or ``8,12``."""
    return df.filter(F.col(col).rlike(f"^[0-9]{{{digits}}}$"))


def exclude_pattern(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Drop special areas by name; a null name is kept."""
    return df.filter(F.col(col).isNull() | ~F.col(col).rlike(pattern))


def filter_spec(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    return df.filter(spec_condition(spec))


def filter_year_level(
    df: DataFrame, year_col: str, year: int, level_col: str, level_pattern: str
) -> DataFrame:
    """Rows of a year and a geography level; the year counts only if some row carries it.

    Whether it does is a scalar subquery over the year column."""
    found = F.regexp_extract(F.col(year_col).cast("string"), r"(20\d{2}|19\d{2})", 1) == str(year)
    known = df.agg(F.coalesce(F.bool_or(found), F.lit(False)).alias("k")).scalar()
    return df.filter((found | ~known) & F.lower(level_col).rlike(level_pattern))


def rows_containing(
    df: DataFrame, pattern: str = r"fail|error|forbidden|exception", columns=None
) -> DataFrame:
    """Rows with the pattern in any column."""
    cells = F.array(*[F.lower(F.col(col_name(c)).cast("string")) for c in columns or df.columns])
    return df.filter(F.exists(F.array_compact(cells), lambda x: x.rlike(pattern)))


def filter_status(df: DataFrame, col: str, value: str, require: bool = True) -> DataFrame:
    """Manifest rows with a status; raises when there are none."""
    kept = df.filter(F.lower(F.trim(col)) == value.lower())
    if require and kept.limit(1).isEmpty():
        raise ContractError(f"no row has {col} = {value}")
    return kept


def filter_names(df: DataFrame, col: str, allow: str, structural=(), deny: str = "contents|notes") -> DataFrame:
    """Names that match ``allow`` or are structural, without contents and notes sheets."""
    name = F.lower(F.trim(col))
    wanted: Column = name.rlike(allow)
    if structural:
        wanted = wanted | name.isin([s.lower() for s in structural])
    return df.filter(wanted & ~name.rlike(deny))
