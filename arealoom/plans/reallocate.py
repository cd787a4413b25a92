"""Counts moved from one boundary edition to another."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.functions.labels import classify, match_text
from arealoom.functions.measures import parse_measure
from arealoom.operators.aggregates import rollup_codes
from arealoom.operators.bridges import allocate, allocation_audit
from arealoom.operators.joins import contract_join, fallback_join
from arealoom.operators.period import choose_period, select_period
from arealoom.session import col_name


@dataclass
class Reallocation:
    """Lazy results of a re-allocation."""

    period: DataFrame
    source: DataFrame
    allocated: DataFrame
    audit: DataFrame
    master: DataFrame


def reallocate_counts(
    source: DataFrame,
    bridge: DataFrame,
    spine: DataFrame,
    *,
    code: str,
    name: str,
    value: str,
    period: str,
    order: Column,
    from_col: str,
    to_col: str,
    ratio: str,
    prefix: str,
    min_pct: float = 98.0,
    **period_options,
) -> Reallocation:
    """Select the reference period, roll counts up to one row per source code, re-allocate them
    through the bridge and join them onto the spine, with control totals."""
    chosen = choose_period(source.select(period), period, **period_options)
    rows = select_period(source, period, **period_options)
    rolled = rollup_codes(rows, code, name, value, order).withColumnRenamed(code, from_col)
    allocated = allocate(rolled, bridge, from_col, to_col, ratio, [value])
    audit = allocation_audit(rolled, allocated, bridge, from_col, [value], min_pct)
    named = allocated.withColumnsRenamed(
        {c: f"{prefix}_{c}" for c in allocated.columns if c != to_col}
    )
    master = contract_join(
        spine, named, to_col, validate="m:1", flag=f"source_{prefix}_present_flag", check=False
    )
    return Reallocation(chosen, rolled, allocated, audit, master)


def wide_to_concepts(
    wide: DataFrame, key: str, taxonomy: list[tuple[str, str]], columns=None
) -> DataFrame:
    """Sum wide columns by the concept their header names; columns without a concept are left out.

    Headers are few, so the mapping is settled on them alone and applied in one aggregate."""
    names = [c for c in (columns or wide.columns) if c != key]
    headers = wide.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(c) for c in names])).alias("header")
    )
    labelled = headers.withColumn("concept", classify(match_text("header"), taxonomy)).collect()
    groups: dict[str, list[str]] = {}
    for row in labelled:
        if row["concept"]:
            groups.setdefault(row["concept"], []).append(row["header"])
    parsed = wide.select(
        key, *[parse_measure(F.col(col_name(c))).alias(c) for g in groups.values() for c in g]
    )

    def concept_sum(cols):
        present = F.coalesce(*[F.col(col_name(c)) for c in cols]).isNotNull()
        total = F.lit(0.0)
        for c in cols:
            total = total + F.coalesce(F.col(col_name(c)), F.lit(0.0))
        return F.when(present, total)

    rows = parsed.select(key, *[concept_sum(cols).alias(g) for g, cols in groups.items()])
    return rows.groupBy(key).agg(*[F.sum(g).alias(g) for g in groups])


def allocate_wide(
    wide: DataFrame,
    bridge: DataFrame,
    *,
    key: str,
    derived_key: Column,
    from_col: str,
    bridge_derived: Column,
    to_col: str,
    ratio: str,
    measures: list[str],
    scope: str = "row",
) -> DataFrame:
    """Allocate several measures at once, matching source codes exactly or by a derived code."""
    left = wide.withColumn("__left_derived", derived_key)
    right = bridge.select(from_col, to_col, ratio).withColumn("__right_derived", bridge_derived)
    joined = fallback_join(left, right, (key, from_col), ("__left_derived", "__right_derived"), scope)
    matched = joined.filter(F.col(to_col).isNotNull())
    return matched.groupBy(to_col).agg(
        *[F.sum(F.col(m) * F.col(ratio)).alias(m) for m in measures],
        F.count_if(F.col("join_method") == "exact_key").alias("exact_edges"),
        F.count_if(F.col("join_method") == "derived_key").alias("derived_edges"),
    )
