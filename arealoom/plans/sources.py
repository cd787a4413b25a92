"""Choosing sources, validating candidates, extracting indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.functions.labels import classify, join_readiness, score_terms, signals
from arealoom.functions.measures import parse_measure
from arealoom.functions.periods import coalesce_period, extract_periods
from arealoom.functions.text import norm_code
from arealoom.operators.aggregates import first_non_null
from arealoom.operators.joins import in_spine, merge_wide, spread_join, unpivot_text
from arealoom.operators.profiling import is_indicator_name
from arealoom.operators.reshape import melt
from arealoom.operators.windows import select_best, top_n_demoted
from arealoom.session import col_name

# Order of preference of readiness labels.
READY_RANK = {
    "joinable_now_sa2": 0, "joinable_now_sa3": 1, "context_only_unbridged": 2,
    "context_only_review": 3, "context_only_state": 4,
}


def describe_sources(
    inv: DataFrame, text: str, content: str, families: list[tuple[str, str]]
) -> DataFrame:
    """Family, signals, readiness and period of every source in an inventory."""
    named = inv.withColumn("source_family", classify(F.lower(text), families, "unknown"))
    flags = signals(F.concat_ws(" ", text, content))
    ready = join_readiness(flags, F.col("source_family"))
    in_content, in_text = extract_periods(content), extract_periods(text)
    dated = named.select("*", in_content.alias("__c"), in_text.alias("__t"))
    period = coalesce_period(
        F.array_min("__c"), F.array_max("__c"), F.array_min("__t"), F.array_max("__t")
    )
    return dated.withColumns({**ready, **period}).drop("__c", "__t")


def select_sources(
    described: DataFrame, unique_id: str, name: str, size: str, include_context: bool = False
) -> DataFrame:
    """Earliest joinable source per family; every source is kept and labelled."""
    rank = classify(
        F.col("join_readiness"), [(str(v), f"^{k}$") for k, v in READY_RANK.items()], "9"
    ).cast("int")
    limit = 5 if include_context else 2
    order = [
        F.col("period_min").asc_nulls_last(), rank.asc(), F.col(name).asc(), F.col(size).asc(),
        F.col(unique_id).asc(),
    ]
    eligible = (rank < limit) & ~F.lower(name).rlike(r"\.(js|css)$")
    return select_best(described, "source_family", order, unique_id, eligible)


def profile_tables(tables: dict[str, DataFrame], keys: DataFrame, skip=()) -> DataFrame:
    """One row for each column of many tables: ``table_name``, ``column_name``, distinct normalised values,
    how many of them are keys, the share of the keys found, non-missing and numeric values.

    All tables are one pool of (table, column, value), counted once per distinct value: any number of
    tables is one job, and a hot value collapses before the shuffle."""
    pool = None
    for name, df in tables.items():
        rows = unpivot_text(df, [c for c in df.columns if c not in skip]).select(F.lit(name).alias("table_name"), "column_name", "value")
        pool = rows if pool is None else pool.unionByName(rows)
    values = pool.groupBy("table_name", "column_name", "value").agg(F.count("*").alias("n"))
    numeric = parse_measure("value").isNotNull()
    by_key = values.select("*", norm_code("value").alias("key")).groupBy("table_name", "column_name", "key").agg(
        F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("n"), F.sum(F.when(numeric, F.col("n"))).alias("numbers")
    )
    known = keys.select(norm_code(keys.columns[0]).alias("key")).filter("key IS NOT NULL").distinct()
    total = known.agg(F.count("*")).scalar()
    matched = spread_join(by_key, known.select("key", F.lit(1).alias("known")), [(F.col("key"), "key")])
    return matched.groupBy("table_name", "column_name").agg(
        F.count("key").alias("unique_values"),
        F.count("known").alias("matched_values"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("non_missing"),
        F.coalesce(F.sum("numbers"), F.lit(0)).alias("numeric_values"),
    ).withColumn("coverage", F.try_divide("matched_values", total))


def extract_indicators(
    tables: dict[str, DataFrame],
    targets: dict[str, DataFrame],
    target: str,
    order: str,
    min_rate: float = 0.85,
) -> tuple[DataFrame, DataFrame] | None:
    """Indicators of every table whose best column matches a target key set well enough.

    Returns one wide row per key, and the long indicator rows. Key and indicator columns of all tables
    come from one pooled profile (one row per column reaches the driver), so the number of jobs does
    not grow with the tables."""
    keyset = targets[target]
    spine = keyset.select(norm_code(keyset.columns[0]).alias("join_key"))
    profiles: dict[str, dict] = {}
    for row in profile_tables(tables, keyset, [order]).collect():
        profiles.setdefault(row.table_name, {})[row.column_name] = row
    wides, longs = [], []
    for table, df in tables.items():
        found = profiles.get(table, {})
        rated = [(r.matched_values / r.unique_values, r.coverage or 0.0, c) for c, r in found.items() if r.unique_values]
        good = [(-rate, -coverage, c) for rate, coverage, c in rated if rate >= min_rate]
        if not good:
            continue
        best = min(good)[2]
        shares = {c: r.numeric_values / r.non_missing for c, r in found.items() if r.numeric_values}
        keep = [c for c in df.columns if shares.get(c, 0) >= 0.5 and is_indicator_name(c, best)]
        cols = [f"{table}__{c}" for c in keep]
        matched = in_spine(
            df.select(
                norm_code(F.col(col_name(best))).alias("join_key"), F.col(order).alias("__order"),
                *[parse_measure(F.col(col_name(c))).alias(n) for c, n in zip(keep, cols, strict=True)],
            ),
            spine, "join_key",
        )
        wides.append(first_non_null(matched, "join_key", cols, F.col("__order")))
        longs.append(melt(matched.drop("__order"), ["join_key"], cols, "indicator", "value"))
    if not wides:
        return None
    long = longs[0]
    for more in longs[1:]:
        long = long.unionByName(more)
    return merge_wide(wides, "join_key"), long


def validate_candidates(
    candidates: DataFrame,
    category: str,
    text: str,
    weights: list[tuple[str, int]],
    unique_id: str,
    values: DataFrame,
    keys: DataFrame,
    per_category: int = 8,
    min_rate: float = 0.95,
) -> DataFrame:
    """Best-scored candidates per category, with the match of their key values and advice.

    ``values`` holds (candidate id, key value); ``keys`` the reference keys."""
    scored = candidates.withColumn("priority", score_terms(text, weights))
    summary: Column = F.lower(text).rlike("workbook_summary|contents")
    picked = top_n_demoted(
        scored, category, summary, [F.desc("priority"), F.col(unique_id)], per_category
    )
    tokens = values.join(picked.select(unique_id), unique_id, "left_semi").select(
        unique_id, norm_code(values.columns[1]).alias("key")
    ).filter("key is not null").distinct()
    known = keys.select(norm_code(keys.columns[0]).alias("key")).distinct().withColumn("__k", F.lit(1))
    rates = tokens.join(known, "key", "left").groupBy(unique_id).agg(
        F.count("*").alias("unique_keys"), F.count("__k").alias("matched_keys")
    )
    rate = F.coalesce(F.try_divide("matched_keys", "unique_keys"), F.lit(0.0))
    return picked.join(rates, unique_id, "left").withColumn("match_rate", rate).withColumn(
        "recommended_action",
        F.when(F.col("match_rate") >= min_rate, F.concat(F.lit("safe_"), F.col(category)))
        .when(F.col("match_rate") > 0, "review_key_match_before_join")
        .otherwise("hold_context_only_no_validated_key_match"),
    )
