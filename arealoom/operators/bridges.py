"""Weighted correspondences between geographies: shares, allocation, dominant region, audits.

A bridge is an edge list (from code, to code, ratio). Group figures are aggregated and joined back
with ``spread_join`` rather than taken over a window, so that AQE can deal the edges of a hot code over
several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.operators.audit import Check, run_checks
from arealoom.operators.joins import spread_join
from arealoom.session import col_name


def allocatable(bridge: DataFrame, from_col: str, to_col: str, ratio: str) -> DataFrame:
    """Edges that can carry a count: both codes present and a positive finite ratio."""
    r = F.col(ratio)
    usable = r.isNotNull() & ~F.isnan(r) & (r > 0) & (r < float("inf"))
    return bridge.filter(F.col(from_col).isNotNull() & F.col(to_col).isNotNull() & usable)


def flag_split(bridge: DataFrame, from_col: str, to_col: str, name: str = "allocation_required") -> DataFrame:
    """Mark edges whose source code has more than one target.

    Targets are made distinct and counted, both by hash: a least and greatest text would be sorted."""
    pairs = bridge.select(from_col, to_col).distinct()
    split = pairs.groupBy(from_col).agg((F.count(to_col) > 1).alias(name))
    plain = bridge.drop(name) if name in bridge.columns else bridge
    return spread_join(plain, split, [(F.col(col_name(from_col)), from_col)]).withColumn(name, F.coalesce(name, F.lit(False)))


def allocate(
    values: DataFrame,
    bridge: DataFrame,
    from_col: str,
    to_col: str,
    ratio: str,
    measures: list[str],
    zero_if_all_null: bool = False,
) -> DataFrame:
    """Re-allocate counts to target codes: value × ratio summed per target.

    ``values`` holds one row per source code. A target fed only by suppressed counts stays null
    unless ``zero_if_all_null``. Also counts contributing codes, edges and split edges, and the
    ratio range.
    """
    edges = allocatable(bridge, from_col, to_col, ratio).select(from_col, to_col, ratio)
    split = edges.select(from_col, to_col).distinct().groupBy(from_col).agg((F.count(to_col) > 1).alias("__split"))
    # both sides have one row per code, so the edges take part in one join
    sources = values.select(from_col, *measures).join(split, from_col)
    carried = spread_join(edges, sources, [(F.col(col_name(from_col)), from_col)], "inner")

    def total(m):
        s = F.sum(F.col(m) * F.col(ratio))
        return F.coalesce(s, F.lit(0.0)) if zero_if_all_null else s

    return carried.groupBy(to_col).agg(
        *[total(m).alias(m) for m in measures],
        F.count_distinct(from_col).alias("contributing_codes"),
        F.count("*").alias("contributing_edges"),
        F.count_if("__split").alias("split_edges"),
        F.min(ratio).alias("min_ratio"),
        F.max(ratio).alias("max_ratio"),
    )


def allocation_audit(
    values: DataFrame,
    allocated: DataFrame,
    bridge: DataFrame,
    from_col: str,
    measures: list[str],
    min_pct: float = 98.0,
) -> DataFrame:
    """Control totals in one row: source, allocated, unmatched, difference, retained percentage.

    The three sides are aggregated apart and stacked as partial totals, so no rows are paired."""
    total = F.lit(0.0)
    for m in measures:
        total = total + F.coalesce(F.col(m).cast("double"), F.lit(0.0))
    lost = values.join(bridge.select(from_col), from_col, "left_anti")

    def part(df, name, codes):
        return df.agg(
            F.lit(name).alias("part"),
            F.coalesce(F.sum(total), F.lit(0.0)).alias("total"),
            codes.alias("codes"),
        )

    stacked = (
        part(values, "source", F.count(from_col))
        .unionByName(part(allocated, "allocated", F.count("*")))
        .unionByName(part(lost, "unmatched", F.count(from_col)))
    )

    def pick(name, column):
        return F.max(F.when(F.col("part") == name, F.col(column)))

    row = stacked.agg(
        pick("source", "codes").alias("source_codes"),
        pick("allocated", "codes").alias("target_codes"),
        pick("unmatched", "codes").alias("unmatched_codes"),
        pick("source", "total").alias("source_total"),
        pick("allocated", "total").alias("allocated_total"),
        pick("unmatched", "total").alias("unmatched_total"),
    )
    retained = F.try_divide(F.col("allocated_total") * 100.0, F.col("source_total"))
    return row.select(
        "*",
        (F.col("source_total") - F.col("allocated_total")).alias("total_difference"),
        F.round(retained, 4).alias("retained_pct"),
        F.when(retained >= min_pct, "pass").otherwise("review").alias("status"),
    )


def share_of_total(
    df: DataFrame, group, part, value: str, share: str = "share", total: str = "group_total"
) -> DataFrame:
    """Summed value of each part of a group, and its share of the group.

    Parts are summed first; group totals are taken from the parts, not from the raw rows."""
    groups = [group] if isinstance(group, str) else list(group)
    parts = [part] if isinstance(part, str) else list(part)
    summed = df.groupBy(*groups, *parts).agg(
        F.sum(value).alias(value), F.count("*").alias("unit_count")
    )
    totals = summed.groupBy(*groups).agg(F.sum(value).alias(total))
    joined = spread_join(summed, totals, [(F.col(col_name(g)), g) for g in groups], "inner")
    return joined.withColumn(share, F.try_divide(F.col(value), F.col(total)))


def ratio_sum_check(
    bridge: DataFrame, from_col: str, ratio: str, low: float = 0.98, high: float = 1.02
) -> DataFrame:
    """Ratio sum of each source code and whether it leaves the tolerance.

    The sum is compared to twelve places, so that neither the order of the edges nor binary fractions
    decide where it lies on a bound: a bound is inside."""
    sums = bridge.filter(F.col(from_col).isNotNull()).groupBy(from_col).agg(
        F.sum(ratio).alias("ratio_sum")
    )
    return sums.withColumn("outside_tolerance", ~F.round("ratio_sum", 12).between(low, high))


def mapping_cardinality(bridge: DataFrame, a: str, b: str) -> DataFrame:
    """How many codes of either side map to more than one code of the other, as one row."""
    pairs = bridge.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b).distinct()

    def side(key, name):
        per = pairs.groupBy(key).agg(F.count("*").alias("n"))
        return per.agg(
            F.lit(name).alias("side"), F.count("*").alias("codes"), F.count_if(F.col("n") > 1).alias("many")
        )

    both = side(a, "a").unionByName(side(b, "b"))

    def pick(s, c):
        return F.max(F.when(F.col("side") == s, F.col(c)))

    return both.agg(
        pick("a", "codes").alias("from_codes"),
        pick("b", "codes").alias("to_codes"),
        pick("a", "many").alias("one_to_many"),
        pick("b", "many").alias("many_to_one"),
    )


def normalise_ratio(df: DataFrame, col: str, rule: str = "median") -> DataFrame:
    """Divide a whole column by 100 when it looks like percentages: ``median`` above 1, or
    ``max`` above 1.5.

    The median test is exact without sorting: it needs only how many values exceed 1 and the two
    values next to 1. It is planned as a scalar subquery."""
    x = F.col(col_name(col))
    if rule == "max":
        scale = df.agg((F.max(x) > 1.5).alias("s"))
    elif rule == "median":
        above, n = F.count_if(x > 1), F.count(x)
        low, high = F.max(F.when(x <= 1, x)), F.min(F.when(x > 1, x))
        scale = df.agg(
            F.when(above * 2 > n, True)
            .when((above * 2 == n) & (n > 0), (low + high) / 2 > 1)
            .otherwise(False)
            .alias("s")
        )
    else:
        raise ValueError(f"unknown scale rule {rule!r}")
    return df.withColumn(col, F.when(scale.scalar(), x / 100.0).otherwise(x))


def dominant(
    bridge: DataFrame,
    key: str,
    code: str,
    weight: str | None = None,
    carry=(),
    then: list[Column] | None = None,
) -> DataFrame:
    """The region holding most of each key: largest weight, then ``then``, then smallest code.

    One aggregate per key; a null weight ranks last. Adds ``multi_region`` and the method used."""
    tie = list(then or [])
    if weight is None:
        rank, method = [], F.lit("single_or_first_record_no_weight_found")
    else:
        w = F.col(weight).cast("double")
        rank = [w.isNull(), -w]
        method = F.when(F.count(weight) > 0, "dominant_by_weight").otherwise(
            "single_or_first_record_no_weight_found"
        )
    order = F.struct(
        *[c.alias(f"r{i}") for i, c in enumerate(rank + tie)], F.col(code).alias("code")
    )
    taken = [code, *([weight] if weight else []), *carry]
    best = (
        bridge.filter(F.col(key).isNotNull() & F.col(code).isNotNull())
        .groupBy(key)
        .agg(
            F.min_by(F.struct(*taken), order).alias("__best"),
            (F.min(code) != F.max(code)).alias("multi_region"),
            method.alias("assignment_method"),
        )
    )
    return best.select(key, *[F.col(f"__best.{c}").alias(c) for c in taken], "multi_region", "assignment_method")


def audit_bridge(
    bridge: DataFrame, from_col: str, to_col: str, ratio: str, low: float = 0.98, high: float = 1.02
) -> DataFrame:
    """The standard checks of a bridge: missing codes and ratios, ratio bounds, cardinality both
    ways, ratio sums. Edge checks share one scan; the per-code checks aggregate per code first."""
    r = F.col(ratio)
    zero = lambda v: v == 0
    edges = run_checks(
        bridge,
        [
            Check("rows", F.count("*"), lambda v: v > 0),
            Check("missing_from_codes", F.count_if(F.col(from_col).isNull()), zero),
            Check("missing_to_codes", F.count_if(F.col(to_col).isNull()), zero, "review"),
            Check("missing_ratios", F.count_if(r.isNull()), zero, "review"),
            Check("ratios_outside_0_1", F.count_if((r < 0) | (r > 1.000001)), zero, "review"),
        ],
    )
    # edges are folded to pairs once; codes are counted from the pairs, with no text in an aggregate
    pairs = bridge.groupBy(from_col, to_col).agg(F.sum(ratio).alias("__sum"))
    per_from = pairs.filter(F.col(from_col).isNotNull()).groupBy(from_col).agg(
        (F.count(to_col) > 1).alias("__split"), F.sum("__sum").alias("__sum")
    )
    per_to = pairs.filter(F.col(to_col).isNotNull()).groupBy(to_col).agg((F.count(from_col) > 1).alias("__merge"))
    sources = run_checks(
        per_from,
        [
            Check("from_codes", F.count("*")),
            Check("one_to_many", F.count_if("__split")),
            Check("ratio_sums_outside", F.count_if(~F.col("__sum").between(low, high)), zero, "review"),
        ],
    )
    targets = run_checks(
        per_to, [Check("to_codes", F.count("*")), Check("many_to_one", F.count_if("__merge"))]
    )
    return edges.unionByName(sources).unionByName(targets)
