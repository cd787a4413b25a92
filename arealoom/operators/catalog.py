"""Operators on column names.

A *catalog* is a table (table_name, ordinal, column_name) of the columns of many tables; rules over
names are queries on it, so hundreds of thousands of source tables are resolved in one job. The
``*_of`` helpers apply the same rules to the columns of one DataFrame.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arealoom.functions import vocab
from arealoom.functions.labels import classify, pattern_points
from arealoom.functions.text import alnum_key, bind, slug
from arealoom.operators.audit import ContractError
from arealoom.session import col_name

CATALOG_SCHEMA = "table_name string, ordinal int, column_name string"


def catalog_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    rows = [
        F.struct(F.lit(t).alias("table_name"), F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"))
        for t, df in tables.items()
        for i, c in enumerate(df.columns)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


# --- one table -----------------------------------------------------------------------------


def clean_header(name: str) -> str:
    return re.sub(r"\s+", " ", name.replace("﻿", "")).strip()


def project_required(df: DataFrame, rename: dict[str, str]) -> DataFrame:
    """Exactly the required columns under their new names; a missing one raises."""
    missing = [c for c in rename if c not in df.columns]
    if missing:
        raise ContractError(f"missing columns {missing}; found {df.columns}")
    return df.select(*[F.col(col_name(old)).alias(new) for old, new in rename.items()])


def standardise(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Rename to canonical names; per canonical name the first alias present wins."""
    keys = {}
    for c in df.columns:
        keys.setdefault(_key(c), c)
    chosen = {}
    for canonical, names in aliases.items():
        hit = next((keys[_key(n)] for n in names if _key(n) in keys), None)
        if hit is not None:
            chosen.setdefault(hit, canonical)
    return df.withColumnsRenamed(chosen)


def _key(name: str) -> str:
    return re.sub("[^a-z0-9]+", "", name.lower())


def pick_column(columns: list[str], candidates: list[str]) -> str | None:
    """Exact match on letters and digits, else the first column that contains, or is contained
    in, a candidate."""
    keys = {}
    for c in columns:
        keys.setdefault(_key(c), c)
    wanted = [_key(c) for c in candidates]
    exact = next((keys[w] for w in wanted if w in keys), None)
    if exact is not None:
        return exact
    return next((c for k, c in keys.items() if k and any(w in k or k in w for w in wanted)), None)


def unique_names(names: list[str], max_len: int = 140) -> list[str]:
    """Slugs of headers, numbered where they repeat, never clashing with another header."""
    slugs = []
    for name in names:
        text = re.sub("[^a-z0-9]+", "_", str(name).strip().lower().replace("&", " and ")).strip("_")
        text = text[:max_len].strip("_") or "unnamed"
        slugs.append("col" if re.match(r"(nan|none|unnamed)$|unnamed_", text) else text)
    natural, seen, out = set(slugs), {}, []
    for s in slugs:
        seen[s] = seen.get(s, 0) + 1
        n = seen[s]
        numbered = f"{s}_{n}"
        out.append(s if n == 1 else f"{s}__{n}" if numbered in natural else numbered)
    return out


def prefix_columns(df: DataFrame, prefix: str, keep=()) -> DataFrame:
    return df.select(
        *[F.col(col_name(c)).alias(c if c in keep else f"{prefix}__{c}") for c in df.columns]
    )


def rename_by_suffix(df: DataFrame, rules=None, prefix: str = "") -> DataFrame:
    """Replace the first matching column suffix; two columns ending up alike raise."""
    names = [_suffixed(c, rules or vocab.SUFFIX_RENAMES) if c.startswith(prefix) else c for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ContractError(f"renames collide: {repeated}")
    return df.toDF(*names)


def _suffixed(name: str, rules) -> str:
    for old, new in rules:
        if name.endswith(old):
            return name[: -len(old)] + new
    return name


def with_source_metadata(
    df: DataFrame, family: str, path: str, table: str, period: str = ""
) -> DataFrame:
    return df.select(
        F.lit(family).alias("source_family"),
        F.lit(path).alias("source_path"),
        F.lit(table).alias("source_table"),
        F.lit(period).alias("source_reference_period"),
        "*",
    )


def select_prefix(df: DataFrame, keys: list[str], prefixes: list[str], drop=()) -> DataFrame:
    """Key columns and those with a prefix, without duplicate labels."""
    kept = [
        c for c in df.columns
        if c not in keys and c not in drop and any(c.startswith(p) for p in prefixes)
    ]
    return df.select(*keys, *[col_name(c) for c in kept])


def conform(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Declared columns only, in order; absent ones are typed nulls."""
    return df.select(
        *[
            (F.col(col_name(c)) if c in df.columns else F.lit(None)).cast(t).alias(c)
            for c, t in schema.items()
        ]
    )


# --- many tables ---------------------------------------------------------------------------


def resolve_columns(catalog: DataFrame, candidates: list[str]) -> DataFrame:
    """Per table the column that answers a list of candidate names: exact match in candidate
    order, else the first column containing, or contained in, one. ``match_kind`` records which."""
    wanted = F.array(*[F.lit(_key(c)) for c in candidates])

    def place(key):
        """Position of an exact match, 0 for containment, null for neither."""
        fuzzy = (key != "") & F.exists(wanted, lambda w: F.contains(w, key) | F.contains(key, w))
        exact = F.array_position(wanted, key)
        return F.when(exact > 0, exact).when(fuzzy, F.lit(0).cast("long"))

    found = catalog.select("*", bind(alnum_key("column_name"), place).alias("__place"))
    rank = F.struct((F.col("__place") == 0).cast("int").alias("kind"), "__place", "ordinal")
    return (
        found.filter("__place is not null")
        .select("table_name", "column_name", rank.alias("__rank"))
        .groupBy("table_name")
        .agg(
            F.min_by("column_name", F.struct("__rank", "column_name")).alias("column_name"),
            F.when(F.min("__rank.kind") == 0, "exact").otherwise("contains").alias("match_kind"),
        )
    )


def resolve_aliases(catalog: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Per table and canonical name the column of the first alias present."""
    key = alnum_key("column_name")
    found = [
        F.struct(
            F.lit(canonical).alias("canonical"),
            F.array_position(F.array(*[F.lit(_key(n)) for n in names]), key).alias("place"),
        )
        for canonical, names in aliases.items()
    ]
    ranked = catalog.select("*", F.inline(F.array(*found))).filter("place > 0")
    return ranked.groupBy("table_name", "canonical").agg(
        F.min_by("column_name", F.struct("place", "ordinal", "column_name")).alias("column_name")
    )


def find_columns(catalog: DataFrame, must=(), any_of=(), exclude=()) -> DataFrame:
    """Per table the first column whose name holds all ``must`` terms, one of ``any_of`` and none
    of ``exclude``."""
    name = slug("column_name")

    def has(term):
        return F.contains(name, F.lit(term))

    cond = F.lit(True)
    for term in must:
        cond = cond & has(term)
    if any_of:
        one = F.lit(False)
        for term in any_of:
            one = one | has(term)
        cond = cond & one
    for term in exclude:
        cond = cond & ~has(term)
    return catalog.filter(cond).groupBy("table_name").agg(
        F.min_by("column_name", F.struct("ordinal", "column_name")).alias("column_name")
    )


#: What a rule of a feature says instead of points: every match has the pattern, or none has it.
MUST, NEVER = "must", "never"


def feature_score(rules, column: str = "column_name") -> Column:
    """Points of a column as a feature; null where it is none.

    ``rules`` is a list of (points, pattern) over the slug of the name, with ``MUST`` or ``NEVER`` in
    place of points for what decides whether the column can be the feature at all. Leftover categories
    cost points unless a ``MUST`` names them."""
    name = slug(column, 1000, "plain")
    demands = [p for kind, p in rules if kind == MUST]
    bans = [p for kind, p in rules if kind == NEVER]
    leftovers = [(w, p) for w, p in vocab.LEFTOVER_POINTS if not any(p in d for d in demands)]
    points = pattern_points(name, [(w, p) for w, p in rules if w not in (MUST, NEVER)] + leftovers)
    possible = F.lit(True)
    for pattern in demands:
        possible = possible & name.rlike(pattern)
    for pattern in bans:
        possible = possible & ~name.rlike(pattern)
    return F.when(possible, F.lit(vocab.FEATURE_POINTS) + points)


def resolve_features(catalog: DataFrame, features: dict[str, list]) -> DataFrame:
    """Per table and feature the best column, its score and whether the best score was shared;
    ``features`` gives the rules of each."""
    scored = [F.struct(F.lit(name).alias("feature"), feature_score(rules).alias("score")) for name, rules in features.items()]
    hits = catalog.select("table_name", "column_name", F.inline(F.array(*scored))).filter(
        "score is not null"
    )
    levels = hits.groupBy("table_name", "feature", "score").agg(
        F.min("column_name").alias("column_name"), F.count("*").alias("ties")
    )
    return levels.groupBy("table_name", "feature").agg(
        F.max_by("column_name", "score").alias("column_name"),
        F.max("score").alias("score"),
        (F.max_by("ties", "score") > 1).alias("ambiguous"),
        F.sum("ties").alias("candidates"),
    )


def unique_columns(catalog: DataFrame) -> DataFrame:
    """Adds ``unique_name``: the slug of the header, numbered per table where it repeats. A number
    that would clash with another header of the table is set off with two underscores."""
    base = slug("column_name")
    named = catalog.withColumn(
        "__slug", F.when(base.rlike("^(nan|none|unnamed)$|^unnamed_"), "col").otherwise(base)
    )
    w = Window.partitionBy("table_name", "__slug").orderBy("ordinal", "column_name")
    numbered = named.withColumn("__n", F.row_number().over(w)).withColumn(
        "__candidate",
        F.when(F.col("__n") == 1, F.col("__slug")).otherwise(F.concat_ws("_", "__slug", "__n")),
    )
    natural = named.select("table_name", F.col("__slug").alias("__candidate"), F.lit(True).alias("__clash"))
    joined = numbered.join(natural.distinct(), ["table_name", "__candidate"], "left")
    return joined.select(
        *catalog.columns,
        F.when((F.col("__n") > 1) & F.col("__clash"), F.concat_ws("__", "__slug", "__n"))
        .otherwise(F.col("__candidate"))
        .alias("unique_name"),
    )


def geography_from_columns(catalog: DataFrame, levels=None) -> DataFrame:
    """Per table the finest geography its headers name, and the headers that name any."""
    levels = levels or vocab.HEADER_LEVELS
    named = catalog.select("table_name", slug("column_name").alias("__name")).distinct()
    flagged = named.select(
        "*", *[F.col("__name").rlike(p).alias(f"__{i}") for i, (_, p) in enumerate(levels)]
    )
    any_hit = F.greatest(*[F.col(f"__{i}") for i in range(len(levels))])
    flags = flagged.groupBy("table_name").agg(
        *[F.bool_or(f"__{i}").alias(f"__{i}") for i in range(len(levels))],
        F.array_join(F.array_sort(F.collect_set(F.when(any_hit, F.col("__name")))), ";").alias("key_columns"),
    )
    level = F.coalesce(*[F.when(F.col(f"__{i}"), n) for i, (n, _) in enumerate(levels)], F.lit("unknown"))
    return flags.select("table_name", level.alias("native_geography"), "key_columns")


# Column families of a wide area master, first match wins:
# (pattern, source table, field role, modelling use).
MASTER_ROLES = [
    (r"^(sa[234]|state)_(code|name)_2021$|^area_albers_sqkm$", "spine",
     "geography_identifier_or_context", "identifier_context_or_grouping"),
    (r"^seifa_", "seifa", "candidate_predictor_or_missingness_context",
     "candidate_predictor_after_screening"),
    (r"^remoteness_|^sa2_ra_category_count$", "remoteness",
     "candidate_predictor_or_geographic_context", "candidate_predictor_after_screening"),
    (r"^nsmhw__.*any_12_month_mental_disorder_modelled_sa2.*(estimate|proportion|percent|pct)",
     "modelled", "primary_outcome_candidate", "outcome"),
    (r"^nsmhw__.*any_12_month_mental_disorder_modelled_sa2", "modelled",
     "primary_outcome_source_related", "manual_review_required"),
    (r"^nsmhw__.*any_12_month_mental_disorder_by_severity", "modelled",
     "severity_related_outcome", "sensitivity_or_related_outcome"),
    (r"^nsmhw__.*(affective|anxiety|substance_use)_disorders", "modelled",
     "disorder_subtype_related_outcome", "target_leakage_exclusion_for_any_disorder_model"),
    (r"^nsmhw__.*comorbidity", "modelled", "comorbidity_related_outcome",
     "related_outcome_or_descriptive_context"),
    (r"^nsmhw__", "modelled", "modelled_estimate_unclassified", "manual_review_required"),
    (r"^source_.*_present_flag$", "integration_build", "source_presence_audit", "audit_only"),
]


def column_roles(catalog: DataFrame, rules=None) -> DataFrame:
    """Source, field role and modelling use of every column."""
    rules = rules or MASTER_ROLES
    review = "manual_review_required"
    name = F.lower("column_name")
    return catalog.select(
        "*",
        classify(name, [(r[1], r[0]) for r in rules], "unknown_or_manual_review").alias("source_table"),
        classify(name, [(r[2], r[0]) for r in rules], review).alias("field_role"),
        classify(name, [(r[3], r[0]) for r in rules], review).alias("modelling_use"),
    )


def name_parts(catalog: DataFrame, sep: str = "__") -> DataFrame:
    """Families and the sources seen in structured names ``family__source__measure``."""
    parts = F.split("column_name", sep)
    return (
        catalog.select(parts[0].alias("family"), F.try_element_at(parts, F.lit(2)).alias("source"))
        .filter("source is not null")
        .groupBy("family", "source")
        .agg(F.count("*").alias("column_count"))
    )
