"""One row per area: building the spine and adding regions to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealoom.functions.text import norm_code, trim_all
from arealoom.operators.bridges import dominant
from arealoom.operators.catalog import standardise
from arealoom.operators.joins import contract_join


def build_spine(
    df: DataFrame,
    codes: list[str],
    names: list[str] = (),
    aliases: dict[str, list[str]] | None = None,
    code_pattern: str = r"^\d{9}$",
) -> DataFrame:
    """Normalised, distinct area hierarchy. ``codes`` runs from the finest level up; rows whose
    finest code has the wrong shape are left out. Other columns are dropped."""
    named = standardise(df, aliases) if aliases else df
    return (
        named.select(
            *[norm_code(c).alias(c) for c in codes], *[trim_all(n).alias(n) for n in names]
        )
        .filter(F.col(codes[0]).rlike(code_pattern))
        .distinct()
    )


def enrich_spine(spine: DataFrame, key: str, bridges: dict[str, tuple[DataFrame, str, str | None]]) -> DataFrame:
    """Add the dominant region of several bridges. ``bridges`` maps a prefix to (bridge, code
    column, weight column); the bridge carries the spine key."""
    out = spine
    for prefix, (bridge, code, weight) in bridges.items():
        best = dominant(bridge, key, code, weight)
        renamed = {
            code: f"{prefix}_code",
            "multi_region": f"{prefix}_multi_region",
            "assignment_method": f"{prefix}_assignment_method",
        }
        if weight:
            renamed[weight] = f"{prefix}_weight"
        out = contract_join(
            out, best.withColumnsRenamed(renamed), key, validate="m:1",
            flag=f"source_{prefix}_present_flag", check=False,
        )
    return out
