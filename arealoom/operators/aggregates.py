"""Grouped summaries. Every one aggregates on the map side before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.functions.measures import pct, size_mb
from arealoom.functions.text import trim_all
from arealoom.session import col_name


def _names(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def first_by(value: Column, keep: Column, order: Column) -> Column:
    """Value of the first row, by ``order``, where ``keep`` holds."""
    return F.min_by(value, F.when(keep, order))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys on more than one row; the null key is a key too."""
    return df.groupBy(*_names(keys)).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def rollup_codes(df: DataFrame, key: str, name: str, value: str, order: Column) -> DataFrame:
    """One row per code: first non-blank name, sum (null when nothing was published), row counts."""
    named = F.col(name).isNotNull() & (trim_all(name) != "")
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            first_by(F.col(name), named, order).alias(name),
            F.sum(value).alias(value),
            F.count("*").alias("source_rows"),
            F.count(value).alias("published_rows"),
            F.count_if(F.col(value).isNull()).alias("suppressed_rows"),
        )
    )


def sum_measures(df: DataFrame, keys, measures: list[str], zero_if_all_null: bool = False) -> DataFrame:
    """Sums that stay null when every input is null."""
    def total(m):
        return F.coalesce(F.sum(m), F.lit(0.0)) if zero_if_all_null else F.sum(m)

    return df.groupBy(*_names(keys)).agg(*[total(m).alias(m) for m in measures])


def first_non_null(df: DataFrame, keys, cols: list[str], order: Column) -> DataFrame:
    return df.groupBy(*_names(keys)).agg(
        *[first_by(F.col(c), F.col(c).isNotNull(), order).alias(c) for c in cols]
    )


def distribution(df: DataFrame, cols, share_digits: int = 3) -> DataFrame:
    """Row count and percentage of every combination, nulls included.

    The total is a scalar subquery over the counts, so no row meets a second shuffle."""
    counts = df.groupBy(*_names(cols)).agg(F.count("*").alias("row_count"))
    total = counts.agg(F.sum("row_count").alias("t")).scalar()
    return counts.withColumn("row_pct", pct("row_count", total, share_digits))


def summarise_status(audit: DataFrame, by, table: str, rows: str, columns: str) -> DataFrame:
    return audit.groupBy(*_names(by)).agg(
        F.count(table).alias("tables"), F.sum(rows).alias("rows"), F.max(columns).alias("columns_max")
    )


def joined_labels(c: str, sep: str = ";") -> Column:
    """Sorted distinct values of a label column, joined; meant for enumerated labels."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def rollup_inventory(inv: DataFrame, by, size: str, lists: list[str], sep: str = ";") -> DataFrame:
    """Files, bytes, megabytes and the labels seen, per family or folder."""
    total = F.sum(size)
    return inv.groupBy(*_names(by)).agg(
        F.count("*").alias("file_count"),
        total.alias("total_size_bytes"),
        size_mb(total).alias("total_size_mb"),
        *[joined_labels(c, sep).alias(c) for c in lists],
    )


def missingness(df: DataFrame, columns=None) -> DataFrame:
    """Missing count and percentage of every column, from one aggregate."""
    names = list(columns or df.columns)
    counts = df.agg(
        F.count("*").alias("__rows"),
        *[F.count(col_name(c)).alias(f"__{i}") for i, c in enumerate(names)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.col("__rows") - F.col(f"__{i}")).alias("missing_count"),
            pct(F.col("__rows") - F.col(f"__{i}"), F.col("__rows"), 3).alias("missing_pct"),
        )
        for i, c in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*entries))).orderBy(F.desc("missing_pct"), "column_name")


def period_inventory(
    df: DataFrame, period: str, target: str, start: str, end: str
) -> DataFrame:
    """Rows per period, whether it lies in the window, and signed days from the target."""
    day = F.col(period)
    return (
        df.filter(day.isNotNull())
        .groupBy(period)
        .agg(F.count("*").alias("row_count"))
        .select(
            period,
            "row_count",
            day.between(F.lit(start).cast("date"), F.lit(end).cast("date")).alias("in_window"),
            F.datediff(day, F.lit(target).cast("date")).alias("days_from_target"),
        )
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in full, as one number."""
    per = df.groupBy(*[col_name(c) for c in df.columns]).agg(F.count("*").alias("__n"))
    return per.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"))


def coverage_summary(log: DataFrame, status: str, rows: str) -> DataFrame:
    """Extraction log in one row: regions by outcome and rows extracted."""
    text = F.lower(F.col(status))
    return log.agg(
        F.count("*").alias("regions"),
        F.count_if(text == "ok").alias("extracted"),
        F.count_if(text == "empty").alias("empty"),
        F.count_if(text == "failed").alias("failed"),
        F.coalesce(F.sum(rows), F.lit(0)).alias("rows_extracted"),
        pct(F.count_if(text == "ok"), F.count("*"), 3).alias("extracted_pct"),
    )


def distinct_parents(spine: DataFrame, cols: list[str]) -> DataFrame:
    """Parent areas of the spine, sorted: the list of extraction targets."""
    return spine.select(*cols).distinct().orderBy(*cols)


def availability_flags(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Per group of columns: how many are present, whether any is, whether all are."""
    out = []
    for group, cols in groups.items():
        present = F.lit(0)
        for c in cols:
            present = present + F.col(col_name(c)).isNotNull().cast("int")
        out += [
            present.alias(f"{group}_present_count"),
            (present > 0).alias(f"{group}_any_available"),
            (present == len(cols)).alias(f"{group}_complete"),
        ]
    return df.select("*", *out)
