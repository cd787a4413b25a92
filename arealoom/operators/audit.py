"""Checks, contracts and audit tables.

An audit table has ``check_name``, ``value``, ``status`` and ``notes``; status is ``pass``,
``review``, ``fail`` or ``info``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.session import col_name


class ContractError(ValueError):
    """A table broke a declared contract."""


@dataclass(frozen=True)
class Check:
    """A named aggregate with an optional rule for its status."""

    name: str
    value: Column
    passes: object = None  # Column -> Column, true when the check passes
    on_fail: str = "fail"
    notes: str = ""


def _names(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def status_of(check: Check, value: Column) -> Column:
    if check.passes is None:
        return F.lit("info")
    return F.when(check.passes(value), "pass").otherwise(check.on_fail)


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Every check in one scan and one aggregate, turned on its side."""
    row = df.agg(*[c.value.cast("double").alias(c.name) for c in checks])
    entries = []
    for check in checks:
        value = F.col(col_name(check.name))
        entries.append(
            F.struct(
                F.lit(check.name).alias("check_name"),
                value.alias("value"),
                status_of(check, value).alias("status"),
                F.lit(check.notes).alias("notes"),
            )
        )
    return row.select(F.inline(F.array(*entries)))


def key_report(df: DataFrame, keys) -> DataFrame:
    """One row: rows, null-key rows, distinct keys, repeated keys and the rows they hold."""
    keys = _names(keys)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(col_name(k)).isNull()
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    present = ~missing
    n = F.col("__n")
    return counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(missing, n)), F.lit(0)).alias("null_key_rows"),
        F.count_if(present).alias("distinct_keys"),
        F.count_if(present & (n > 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(present & (n > 1), n)), F.lit(0)).alias("duplicate_key_rows"),
    )


def expect_unique(df: DataFrame, keys) -> None:
    """Raise unless every non-null key occurs once."""
    keys = _names(keys)
    repeated = df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("__n")).filter("__n > 1")
    sample = [tuple(r)[:-1] for r in repeated.limit(3).collect()]
    if sample:
        raise ContractError(f"{keys} repeat, for example {sample}")


def expect_not_null(df: DataFrame, keys) -> None:
    missing = F.lit(False)
    for k in _names(keys):
        missing = missing | F.col(col_name(k)).isNull()
    if not df.filter(missing).limit(1).isEmpty():
        raise ContractError(f"null keys in {_names(keys)}")


def dependency_violations(df: DataFrame, fine: str, parent: str) -> DataFrame:
    """Fine areas with more than one parent."""
    pairs = df.filter(F.col(fine).isNotNull()).select(fine, parent).distinct()
    return pairs.groupBy(fine).agg(F.count(parent).alias("parent_count")).filter("parent_count > 1")


def expect_fd(df: DataFrame, fine: str, parent: str) -> None:
    rows = dependency_violations(df, fine, parent).limit(3).collect()
    if rows:
        raise ContractError(f"{fine} has several {parent}: {[r[0] for r in rows]}")


def row_profile(df: DataFrame, key, stage: str) -> DataFrame:
    """One row: stage, row count, distinct key count, column count."""
    report = key_report(df, key)
    return report.select(
        F.lit(stage).alias("stage"),
        "row_count",
        "distinct_keys",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
    )


def join_audit(before: DataFrame, after: DataFrame, key) -> DataFrame:
    """Rows kept and columns gained across a join, as one row."""
    both = row_profile(before, key, "before").unionByName(row_profile(after, key, "after"))

    def at(stage, column):
        return F.max(F.when(F.col("stage") == stage, F.col(column)))

    return both.agg(
        at("before", "row_count").alias("rows_before"),
        at("after", "row_count").alias("rows_after"),
        at("before", "column_count").alias("columns_before"),
        at("after", "column_count").alias("columns_after"),
    ).withColumn(
        "status",
        F.when(
            (F.col("rows_before") == F.col("rows_after"))
            & (F.col("columns_after") >= F.col("columns_before")),
            "pass",
        ).otherwise("fail"),
    )


def range_report(df: DataFrame, metrics: dict[str, tuple[Column, float, float]]) -> DataFrame:
    """Aggregates against plausible ranges."""
    return run_checks(
        df,
        [
            Check(name, value, lambda v, lo=lo, hi=hi: v.between(lo, hi), notes=f"{lo} to {hi}")
            for name, (value, lo, hi) in metrics.items()
        ],
    )


def expect_range(df: DataFrame, metrics: dict[str, tuple[Column, float, float]]) -> None:
    gate(range_report(df, metrics))


def coverage(df: DataFrame, key: str, ref: DataFrame, ref_key: str, target: str) -> DataFrame:
    """Share of distinct source codes known to a bridge, and how many map to several targets."""
    codes = df.select(F.col(key).alias("__code")).filter("__code is not null").distinct()
    fan_out = (
        ref.filter(F.col(ref_key).isNotNull())
        .groupBy(F.col(ref_key).alias("__ref"))
        .agg((F.min(target) != F.max(target)).alias("__split"))
    )
    totals = codes.join(fan_out, F.col("__code") == F.col("__ref"), "left").agg(
        F.count("*").alias("unique_codes"),
        F.count("__ref").alias("matched_codes"),
        F.count_if("__split").alias("codes_needing_allocation"),
    )
    pct = F.round(F.try_divide(F.col("matched_codes") * 100.0, F.col("unique_codes")), 3)
    return totals.select(
        "unique_codes",
        "matched_codes",
        (F.col("unique_codes") - F.col("matched_codes")).alias("unmatched_codes"),
        pct.alias("coverage_pct"),
        "codes_needing_allocation",
        F.when(F.col("matched_codes") == F.col("unique_codes"), "pass")
        .when(pct >= 95, "review")
        .otherwise("fail")
        .alias("status"),
    )


def validate_register(df: DataFrame, key: str, enums: dict[str, list[str]]) -> DataFrame:
    """Unique id and allowed values of a register, as an audit table.

    The duplicate count comes from counts per id, the value checks ride on the same scan."""
    bad = {c: F.sum(F.when(~F.col(c).isin(allowed) | F.col(c).isNull(), 1).otherwise(0))
           for c, allowed in enums.items()}
    per_key = df.groupBy(key).agg(
        F.count("*").alias("__n"), *[v.alias(f"__bad_{c}") for c, v in bad.items()]
    )
    zero = lambda v: v == 0
    return run_checks(
        per_key,
        [
            Check("rows", F.sum("__n")),
            Check("null_ids", F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("__n"))), F.lit(0)), zero),
            Check("duplicate_ids", F.count_if(F.col(key).isNotNull() & (F.col("__n") > 1)), zero),
            *[
                Check(f"values_not_allowed_{c}", F.coalesce(F.sum(f"__bad_{c}"), F.lit(0)), zero)
                for c in enums
            ],
        ],
    )


def gate(audit: DataFrame, name: str = "check_name") -> None:
    """Raise when any check failed; the audit table is small by construction."""
    failed = [r[0] for r in audit.filter("status = 'fail'").select(name).limit(20).collect()]
    if failed:
        raise ContractError(f"failed checks: {failed}")


def column_diff(
    before: list[str], after: list[str], renames: dict[str, str] | None = None
) -> list[tuple[str, str, str]]:
    """(old, new, change) for every column; change is kept, renamed, created or dropped."""
    renames = renames or {}
    arrived = set(after)
    rows, used = [], set()
    for old in before:
        new = renames.get(old, old)
        if new in arrived:
            rows.append((old, new, "kept" if new == old else "renamed"))
            used.add(new)
        else:
            rows.append((old, "", "dropped"))
    rows += [("", new, "created") for new in after if new not in used]
    return rows


def column_change_audit(
    before: DataFrame, after: DataFrame, renames: dict[str, str] | None = None
) -> DataFrame:
    """Column changes with the missing count of each surviving column, in one aggregate."""
    rows = column_diff(before.columns, after.columns, renames)
    counts = after.agg(
        F.count("*").alias("__rows"),
        *[F.count(col_name(c)).alias(f"__{i}") for i, c in enumerate(after.columns)],
    )
    position = {c: i for i, c in enumerate(after.columns)}
    entries = [
        F.struct(
            F.lit(old).alias("old_column"),
            F.lit(new).alias("new_column"),
            F.lit(change).alias("change"),
            (
                F.col("__rows") - F.col(f"__{position[new]}") if new else F.lit(None).cast("long")
            ).alias("missing_count"),
        )
        for old, new, change in rows
    ]
    return counts.select(F.inline(F.array(*entries)))


def explain_unmatched(
    spine: DataFrame, matched: DataFrame, key: str, logs: dict[str, DataFrame]
) -> DataFrame:
    """Spine rows without a match, with each log's columns under its own suffix."""
    out = spine.join(matched.select(key), key, "left_anti")
    for suffix, log in logs.items():
        renamed = log.withColumnsRenamed({c: f"{c}_{suffix}" for c in log.columns if c != key})
        out = out.join(renamed, key, "left")
    return out


def allocation_gate(
    audit: DataFrame, min_pct: float = 98.0, fail_unmatched: bool = False
) -> DataFrame:
    """Status of an allocation from its control totals; retained is a percentage."""
    short = F.col("retained_pct").isNull() | (F.col("retained_pct") < min_pct)
    chain = F.when(short, "review")
    if fail_unmatched:
        chain = F.when(F.col("unmatched_codes") > 0, "fail").when(short, "review")
    return audit.withColumn("status", chain.otherwise("pass"))
