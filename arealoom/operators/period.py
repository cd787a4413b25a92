"""Selection of the reference period a table is aligned on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POLICIES = ("target_window", "latest_within_window", "closest_to_target_any", "earliest", "latest")


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


def choose_period(
    periods: DataFrame,
    col: str,
    policy: str = "target_window",
    target: str = "2021-12-31",
    start: str = "2021-01-01",
    end: str = "2022-06-30",
    tie: str = "later",
) -> DataFrame:
    """One row: the selected period, why, whether it lies in the window, days from the target.

    A single aggregate; ``periods`` may repeat dates. ``target_window`` prefers the window and
    falls back to the closest period anywhere; ``closest_to_target_any`` ignores the window."""
    if policy not in POLICIES:
        raise ValueError(f"unknown period policy {policy!r}")
    day, number = F.col(col), F.unix_date(F.col(col))
    inside = day.between(_day(start), _day(end))
    distance = F.abs(F.datediff(day, _day(target)))
    late = -number if tie == "later" else number
    any_inside = F.coalesce(F.bool_or(inside), F.lit(False))
    nearest = F.min_by(day, F.struct(distance.alias("a"), late.alias("b")))
    nearest_inside = F.min_by(day, F.when(inside, F.struct(distance.alias("a"), late.alias("b"))))
    first_nearest = F.min_by(day, F.struct(distance.alias("a"), number.alias("b")))
    none_inside = "no_period_inside_window_closest_available_to_target"
    if policy == "earliest":
        chosen, basis = F.min(day), F.lit("earliest_available")
    elif policy == "latest":
        chosen, basis = F.max(day), F.lit("latest_available")
    elif policy == "closest_to_target_any":
        chosen, basis = nearest, F.lit("closest_to_target_any")
    elif policy == "latest_within_window":
        chosen = F.coalesce(F.max(F.when(inside, day)), first_nearest)
        basis = F.when(any_inside, "latest_available_inside_target_window").otherwise(none_inside)
    else:
        chosen = F.coalesce(nearest_inside, nearest)
        basis = F.when(any_inside, "closest_to_target_inside_window").otherwise(none_inside)
    picked = periods.agg(chosen.alias("selected_period"), basis.alias("__basis"))
    sel = F.col("selected_period")
    return picked.select(
        sel,
        F.when(sel.isNull(), "no_available_periods").otherwise(F.col("__basis")).alias("alignment_basis"),
        F.coalesce(sel.between(_day(start), _day(end)), F.lit(False)).alias("in_target_window"),
        F.datediff(sel, _day(target)).alias("days_from_target"),
    )


def select_period(df: DataFrame, col: str, **options) -> DataFrame:
    """Rows of the selected period. The choice is a scalar subquery over the date column alone, so
    the rows are filtered in the scan's own stage."""
    chosen = choose_period(df.select(col), col, **options).select("selected_period")
    return df.filter(F.col(col) == chosen.scalar())
