"""Wide masters: assembly, derived features, service activity, checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.functions.measures import parse_measure, publication_status
from arealoom.operators.aggregates import availability_flags, missingness
from arealoom.operators.audit import expect_unique
from arealoom.operators.catalog import catalog_of, column_roles, resolve_features
from arealoom.operators.joins import contract_join
from arealoom.operators.reshape import select_measures
from arealoom.session import col_name


def assemble_master(
    spine: DataFrame, key, sources: dict[str, DataFrame], check: bool = True
) -> DataFrame:
    """Left-join one-row-per-area sources onto the spine, each with a presence flag.

    The spine and every source are checked once for one row per key, on their key columns alone; joins
    of checked sides stay one row per area, so what is already joined is not checked again."""
    keys = [key] if isinstance(key, str) else list(key)
    if check:
        for side in (spine, *sources.values()):
            expect_unique(side, keys)
    out = spine
    for name, source in sources.items():
        out = contract_join(
            out, source, key, validate="m:n", flag=f"source_{name}_present_flag", check=False,
        )
    return out


def master_dictionary(master: DataFrame, name: str = "master", rules=None) -> DataFrame:
    """Role, use and missingness of every column of a master."""
    roles = column_roles(catalog_of(master.sparkSession, {name: master}), rules)
    return roles.join(missingness(master), "column_name").orderBy("ordinal")


def derive_features(
    master: DataFrame, keys: list[str], rules: dict[str, list], group: str = "features"
) -> tuple[DataFrame, DataFrame]:
    """Resolve features (``rules`` of each as in ``feature_score``) on the column names, parse them in one
    projection, count what is there.

    Returns the features and the mapping, in which ambiguous choices are marked."""
    mapping = resolve_features(catalog_of(master.sparkSession, {"master": master}), rules)
    chosen = {r["feature"]: r["column_name"] for r in mapping.collect()}
    names = list(rules)
    features = master.select(
        *keys,
        *[
            (parse_measure(F.col(col_name(chosen[n]))) if n in chosen else F.lit(None).cast("double")).alias(n)
            for n in names
        ],
    )
    return availability_flags(features, {group: names}), mapping


def activity_context(
    long: DataFrame,
    key: str,
    specs: dict[str, dict[str, str]],
    raw: str,
    order: Column,
    master: DataFrame,
    flag: str = "has_activity_extract",
) -> DataFrame:
    """Long service activity to selected wide measures, repeated over the fine areas of a master."""
    parsed = long.withColumns(
        {"__number": parse_measure(raw), "__status": publication_status(raw)}
    )
    wide = select_measures(parsed, key, specs, "__number", raw, "__status", order)
    counted = availability_flags(wide, {"activity": list(specs)})
    return contract_join(master, counted, key, validate="m:1", flag=flag, check=False)


def checkpoint_without(master: DataFrame, source: str, status: str) -> DataFrame:
    """The master passed on unchanged when an optional source is missing, and says so."""
    return master.select(
        "*",
        F.lit(False).alias(f"source_{source}_present_flag"),
        F.lit(status).alias(f"source_{source}_status"),
    )
