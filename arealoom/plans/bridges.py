"""Building bridges from published correspondences and from finer units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.functions.measures import map_values, parse_measure, plain_number
from arealoom.functions.text import norm_code
from arealoom.operators.audit import expect_range
from arealoom.operators.bridges import dominant, flag_split, normalise_ratio, share_of_total
from arealoom.operators.catalog import project_required
from arealoom.operators.joins import compose_bridge, contract_join
from arealoom.session import materialise


def build_bridge(
    df: DataFrame,
    rename: dict[str, str],
    from_col: str,
    to_col: str,
    ratio: str,
    provenance: dict[str, str] | None = None,
    expected: dict[str, tuple[Column, float, float]] | None = None,
) -> DataFrame:
    """Correspondence table to a bridge with a split flag. ``expected`` ranges guard against a
    file of the wrong geography; a value outside raises before anything is written."""
    edges = project_required(df, rename)
    edges = edges.select(
        norm_code(from_col).alias(from_col),
        norm_code(to_col).alias(to_col),
        plain_number(ratio).alias(ratio),
        *[c for c in edges.columns if c not in (from_col, to_col, ratio)],
        *[F.lit(v).alias(k) for k, v in (provenance or {}).items()],
    ).filter(F.col(from_col).isNotNull())
    if expected:
        # The check and the flag both read the edges, so they are computed once and stored.
        edges = materialise(edges, "bridge")
        expect_range(edges, expected)
    return flag_split(edges, from_col, to_col)


def build_area_bridge(
    fine_to_a: DataFrame, fine_to_b: DataFrame, unit, a: str, b: str, area: str, carry_b=()
) -> tuple[DataFrame, DataFrame]:
    """Area-share bridge from fine units mapped to both geographies, and its dominant region."""
    units = compose_bridge(fine_to_a, fine_to_b, unit).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull()
    )
    full = share_of_total(units, a, [b, *carry_b], area)
    best = dominant(full, a, b, "share", carry=[*carry_b, area, "unit_count", "group_total"])
    return full, best


def build_ratio_bridge(
    df: DataFrame, key: str, code: str, ratio: str | None = None, key_pattern: str = r"^\d{9}$",
    scale_rule: str = "median", carry=(),
) -> tuple[DataFrame, DataFrame]:
    """Bridge from a concordance with ratios or percentages; without a ratio every edge counts 1.
    Returns all edges and the dominant one per key."""
    share = F.lit(1.0) if ratio is None else parse_measure(ratio)
    edges = df.select(
        norm_code(key).alias(key), norm_code(code).alias(code), share.alias("ratio"), *carry
    )
    if ratio is not None:
        edges = normalise_ratio(edges, "ratio", scale_rule)
    edges = edges.filter(F.col(code).isNotNull() & F.col(key).rlike(key_pattern)).withColumn(
        "ratio", F.coalesce("ratio", F.lit(1.0))
    )
    return edges, dominant(edges, key, code, "ratio", carry)


def dominant_category(
    fine_area: DataFrame,
    fine_category: DataFrame,
    unit,
    area_key: str,
    category: str,
    weight: str,
    spine: DataFrame | None = None,
    ordinals: dict[str, int] | None = None,
) -> DataFrame:
    """Category covering most of each area, weighed by its fine units; ties go to the larger unit
    count, then the smaller code."""
    units = compose_bridge(fine_area, fine_category, unit).filter(F.col(category).isNotNull())
    shares = share_of_total(units.withColumn(weight, F.coalesce(weight, F.lit(0.0))), area_key, category, weight)
    best = dominant(
        shares, area_key, category, "share", carry=[weight, "unit_count"], then=[-F.col("unit_count")]
    )
    if ordinals:
        best = best.withColumn(f"{category}_ordinal", map_values(category, ordinals))
    if spine is None:
        return best
    return contract_join(spine, best, area_key, validate="m:1", flag="category_present", check=False)
