"""Projections and column resolution (PRJ), detection over columns and values (CLS), ARR1."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealoom.checks.registry import (
    HEADERS, SQL_FIGURE, SQL_HEADERS, SQL_NUMBER, check, headers, iso, period_labels, printed, r, sql_slug, table,
)
from arealoom.operators import catalog as C
from arealoom.operators import profiling as P


@check(
    "prj1_project_required",
    "SELECT l_orderkey AS from_code, l_suppkey AS to_code, l_quantity AS ratio_from_to FROM lineitem",
)
def project_required(spark, sf):
    names = {"l_orderkey": "from_code", "l_suppkey": "to_code", "l_quantity": "ratio_from_to"}
    return C.project_required(table(spark, sf, "lineitem"), names)


@check(
    "prj2_standardise",
    "SELECT c_custkey AS code, c_name AS name, c_acctbal AS balance, c_nationkey, c_mktsegment FROM customer",
)
def standardise(spark, sf):
    aliases = {"code": ["CustKey", "C CUSTKEY"], "name": ["c-name"], "balance": ["amount", "c_acctbal"], "absent": ["zz"]}
    return C.standardise(table(spark, sf, "customer"), aliases)


@check(
    "prj2_resolve_aliases",
    f"""WITH {SQL_HEADERS}, a AS (SELECT *, CASE column_name WHEN 'LGA code' THEN 1 WHEN 'Jurisdiction' THEN 2 END AS region,
 CASE column_name WHEN 'Rate (%)' THEN 1 WHEN 'Total persons' THEN 2 END AS measure FROM headers)
 SELECT table_name, 'region' AS canonical, min_by(column_name, region) AS column_name FROM a WHERE region IS NOT NULL GROUP BY 1
 UNION ALL SELECT table_name, 'measure', min_by(column_name, measure) FROM a WHERE measure IS NOT NULL GROUP BY 1""",
)
def resolve_aliases(spark, sf):
    aliases = {"region": ["LGA_CODE", "jurisdiction"], "measure": ["rate", "total_persons"]}
    return C.resolve_aliases(headers(spark, sf), aliases)


@check(
    "prj3_resolve_columns",
    f"""WITH {SQL_HEADERS}, x AS (SELECT *, CASE column_name WHEN 'SA2 Code 2021' THEN 10 WHEN 'SA3_NAME' THEN 100 + ordinal
 WHEN 'LGA code' THEN NULL WHEN 'Total persons' THEN 20 END AS rank FROM headers)
 SELECT table_name, min_by(column_name, rank) AS column_name, CASE WHEN min(rank) < 100 THEN 'exact' ELSE 'contains' END
 AS match_kind FROM x WHERE rank IS NOT NULL GROUP BY 1""",
)
def resolve_columns(spark, sf):
    return C.resolve_columns(headers(spark, sf), ["sa2_code_2021", "Total Persons", "SA3 Name Full"])


@check(
    "prj4_find_columns",
    f"""WITH {SQL_HEADERS} SELECT table_name, min_by(column_name, (ordinal, column_name)) AS column_name FROM headers
 WHERE column_name IN ('SA2 Code 2021', 'SA3_NAME') GROUP BY 1""",
)
def find_columns(spark, sf):
    return C.find_columns(headers(spark, sf), must=["sa"], any_of=["code", "name"], exclude=["lga"])


@check(
    "prj5_resolve_features",
    f"""WITH {SQL_HEADERS}, x AS (SELECT table_name, column_name, 'code' AS feature, CASE column_name WHEN 'SA2 Code 2021'
 THEN 130 WHEN 'LGA code' THEN 105 END AS score FROM headers UNION ALL SELECT table_name, column_name, 'persons',
 CASE column_name WHEN 'Total persons' THEN 100 END FROM headers), y AS (SELECT * FROM x WHERE score IS NOT NULL),
 z AS (SELECT *, max(score) OVER (PARTITION BY table_name, feature) AS best FROM y)
 SELECT table_name, feature, min(column_name) FILTER (score = best) AS column_name, max(score) AS score,
 count(*) FILTER (score = best) > 1 AS ambiguous, count(*) AS candidates FROM z GROUP BY 1, 2""",
)
def resolve_features(spark, sf):
    features = {
        "code": [(C.MUST, "code"), (C.MUST, "sa2|lga"), (5, "code"), (25, "^sa2")],
        "persons": [(C.MUST, "total"), (C.MUST, "persons$"), (C.NEVER, "not_stated")],
    }
    return C.resolve_features(headers(spark, sf), features)


@check(
    "prj6_unique_columns",
    f"""WITH {SQL_HEADERS}, s AS (SELECT *, {sql_slug('column_name')} AS slug FROM headers), n AS (SELECT *, row_number() OVER
 (PARTITION BY table_name, slug ORDER BY ordinal) AS rn FROM s) SELECT table_name, CASE WHEN rn = 1 THEN slug
 ELSE slug || '_' || rn END AS unique_name FROM n""",
)
def unique_columns(spark, sf):
    return C.unique_columns(headers(spark, sf)).select("table_name", "unique_name")


@check(
    "prj7_prefix_columns",
    "SELECT p_partkey, p_brand AS parts__catalogue__p_brand, p_size AS parts__catalogue__p_size FROM part",
)
def prefix_columns(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    return C.prefix_columns(parts, "parts__catalogue", keep=["p_partkey"])


@check(
    "prj8_rename_by_suffix",
    """SELECT p_partkey, p_size AS nsmhw__a__proportion_95ci_lower, p_size + 1 AS nsmhw__a__proportion_95ci_upper,
 p_brand AS nsmhw__a__relative_root_mean_square_error_flag, p_retailprice AS nsmhw__a__relative_root_mean_square_error_pct
 FROM part""",
)
def rename_by_suffix(spark, sf):
    raw = table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").alias("nsmhw__a__95_confidence_interval_of_proportion"),
        (F.col("p_size") + 1).alias("nsmhw__a__unnamed_2"), F.col("p_brand").alias("nsmhw__a__unnamed"),
        F.col("p_retailprice").alias("nsmhw__a__relative_root_mean_square_error_a"),
    )
    return C.rename_by_suffix(raw, prefix="nsmhw__")


@check(
    "prj9_with_source_metadata",
    """SELECT 'sales' AS source_family, 'orders.parquet' AS source_path, 'orders' AS source_table, '2001' AS
 source_reference_period, o_orderkey, o_orderstatus FROM orders""",
)
def with_source_metadata(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return C.with_source_metadata(orders, "sales", "orders.parquet", "orders", "2001")


@check("prj10_drop_empty", "SELECT o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def drop_empty(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice"),
        F.lit(None).cast("string").alias("blank"),
    )
    return P.drop_empty(rows)


@check("prj11_select_prefix", "SELECT l_orderkey, l_suppkey, l_shipdate::DATE::VARCHAR AS l_shipdate FROM lineitem")
def select_prefix(spark, sf):
    out = C.select_prefix(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_s"], drop=["l_shipmode"])
    return out.withColumn("l_shipdate", iso("l_shipdate"))


# A name header alone (``SA3_NAME``) does not give a level.
_LEVELS = {"SA2 Code 2021": "sa2", "LGA code": "lga", "Jurisdiction": "state"}


@check(
    "cls3_geography_from_columns",
    f"""WITH {SQL_HEADERS}, f AS (SELECT table_name, {', '.join(f"bool_or(column_name = '{h}') AS {lv}" for h, lv in _LEVELS.items())},
 array_to_string(list_sort(list(DISTINCT {sql_slug('column_name')}) FILTER (column_name IN ('SA2 Code 2021',
 'LGA code', 'Jurisdiction'))), ';') AS key_columns FROM headers GROUP BY 1) SELECT table_name, CASE WHEN sa2 THEN 'sa2' WHEN lga THEN 'lga' WHEN state THEN 'state' ELSE 'unknown' END AS native_geography,
 coalesce(key_columns, '') AS key_columns FROM f""",
)
def geography_from_columns(spark, sf):
    return C.geography_from_columns(headers(spark, sf))


@check(
    "cls4_geography_from_values",
    """SELECT 'sa2' AS native_geography, count(*) AS score, 'area;district;note' AS key_columns FROM customer""",
)
def geography_from_values(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.concat(F.lit("1"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("area"),
        F.lpad((F.col("c_nationkey") + 10000).cast("string"), 5, "0").alias("district"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_custkey") % 2 == 0, "Northern PHN").otherwise("x").alias("note"),
        (F.col("c_custkey") % 2000).cast("string").alias("plain_count"),
        F.when(F.col("c_custkey") == 1, "Australia").otherwise("-").alias("remark"),
    )
    return P.geography_from_values(rows)


@check(
    "cls7_column_roles",
    f"""WITH {SQL_HEADERS}, h AS (SELECT table_name, CASE column_name {' '.join(
        f"WHEN '{text}' THEN '{new}'" for (_, text), new in zip(HEADERS, ["sa2_code_2021", "seifa_irsd_score", "remoteness_area",
        "nsmhw__anxiety_disorders__x", "source_seifa_present_flag", "other"]))} END AS c FROM headers)
 SELECT field_role, modelling_use, count(*) AS columns FROM (SELECT CASE c WHEN 'sa2_code_2021' THEN
 'geography_identifier_or_context' WHEN 'seifa_irsd_score' THEN 'candidate_predictor_or_missingness_context' WHEN
 'remoteness_area' THEN 'candidate_predictor_or_geographic_context' WHEN 'nsmhw__anxiety_disorders__x' THEN
 'disorder_subtype_related_outcome' WHEN 'source_seifa_present_flag' THEN 'source_presence_audit' ELSE
 'manual_review_required' END AS field_role, CASE c WHEN 'sa2_code_2021' THEN 'identifier_context_or_grouping' WHEN
 'seifa_irsd_score' THEN 'candidate_predictor_after_screening' WHEN 'remoteness_area' THEN
 'candidate_predictor_after_screening' WHEN 'nsmhw__anxiety_disorders__x' THEN
 'target_leakage_exclusion_for_any_disorder_model' WHEN 'source_seifa_present_flag' THEN 'audit_only' ELSE
 'manual_review_required' END AS modelling_use FROM h) GROUP BY 1, 2""",
)
def column_roles(spark, sf):
    from arealoom.functions import map_values

    new = ["sa2_code_2021", "seifa_irsd_score", "remoteness_area", "nsmhw__anxiety_disorders__x",
           "source_seifa_present_flag", "other"]
    renamed = headers(spark, sf).withColumn(
        "column_name", map_values("column_name", {text: n for (_, text), n in zip(HEADERS, new)})
    )
    return C.column_roles(renamed).groupBy("field_role", "modelling_use").agg(F.count("*").alias("columns"))


def _statistics(spark, sf):
    """A published table: period, code, name, count and rate, all text."""
    rows = printed(spark, sf).join(period_labels(spark, sf).select("o_orderkey", "label"), "o_orderkey")
    return rows.select(
        F.concat(F.lit("1"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("SA2Cd2016"),
        F.col("o_orderpriority").alias("SA2Nm2016"),
        F.col("label").alias("RprtDt"),
        F.col("figure").alias("ParticipantCount"),
        (F.col("o_orderkey") % 100).cast("string").alias("rate_pct"),
    )


@check(
    "cls8_measure_scores",
    f"""SELECT 'ParticipantCount' AS column_name, round(count(x) / count(*), 6) AS parse_rate, round(50 + 10.0 * count(x) /
 count(*), 5) AS score FROM (SELECT {SQL_FIGURE} AS f, {SQL_NUMBER} AS x FROM orders) UNION ALL SELECT 'rate_pct', 1.0, -10.0
 UNION ALL SELECT 'RprtDt', round(count(*) FILTER (o_orderkey % 12 IN (0, 1, 10)) / count(*), 6),
 round(10.0 * count(*) FILTER (o_orderkey % 12 IN (0, 1, 10)) / count(*), 5) FROM orders""",
)
def measure_scores(spark, sf):
    scores = P.measure_scores(_statistics(spark, sf), exclude=["SA2Cd2016", "SA2Nm2016"])
    return scores.select("column_name", r("parse_rate", 6).alias("parse_rate"), r("score", 5).alias("score"))


@check(
    "agg14_column_profile",
    f"""WITH f AS (SELECT {SQL_FIGURE} AS f, {SQL_NUMBER} AS x, o_orderkey, o_orderpriority AS p FROM orders), y AS (
 SELECT count(*) FILTER (o_orderkey % 12 IN (0, 1, 10)) / count(*) AS plain, count(*) FILTER (o_orderkey % 12 <> 11) / count(*) AS dated,
 count(x) / count(*) AS parsed, count(x) / count(f) AS share, count(f) FILTER (regexp_matches(f, '[A-Za-z]')) / count(f) AS lettered,
 count(*) AS n FROM f) SELECT detector, column_name, round(score, 5) AS score FROM (
 SELECT unnest(['measure', 'measure', 'measure', 'period', 'indicator', 'indicator', 'indicator', 'key', 'key', 'key', 'key', 'key'])
 AS detector, unnest(['ParticipantCount', 'rate_pct', 'RprtDt', 'RprtDt', 'ParticipantCount', 'rate_pct', 'SA2Cd2016', 'SA2Cd2016',
 'SA2Nm2016', 'RprtDt', 'rate_pct', 'ParticipantCount']) AS column_name, unnest([50 + 10.0 * parsed, -10.0, 10.0 * plain,
 100 + 10.0 * dated, share, 1.0, 1.0, 11.0, 0.0, 0.0, 0.0, 0.0])::DOUBLE AS score FROM y)""",
)
def column_profile(spark, sf):
    """The profiles of two halves, merged; scores of rows that other queries hold against SQL."""
    rows = _statistics(spark, sf)
    half = F.pmod(F.xxhash64("SA2Cd2016"), F.lit(2)).cast("string")
    profile = P.merge_profiles(P.column_profile(rows.withColumn("part", half), by="part"))
    scores = P.scores_from_profile(profile, "sa2", exclude=["SA2Cd2016", "SA2Nm2016"])
    return scores.filter("detector <> 'name'").withColumn("score", r("score", 5))


@check(
    "cls9_period_column_scores",
    """SELECT 'RprtDt' AS column_name, round(n, 6) AS parse_rate, round(100 + 10 * n, 5) AS score FROM (SELECT
 count(*) FILTER (o_orderkey % 12 <> 11) / count(*) AS n FROM orders)""",
)
def period_column_scores(spark, sf):
    scores = P.period_column_scores(_statistics(spark, sf))
    return scores.select("column_name", r("parse_rate", 6).alias("parse_rate"), r("score", 5).alias("score"))


@check(
    "cls10_key_column_scores",
    """SELECT unnest(['SA2Cd2016', 'SA2Nm2016', 'ParticipantCount', 'rate_pct']) AS column_name,
 unnest([1.0, 0.0, 0.0, 0.0])::DOUBLE AS shape_share, unnest([11.0, 0.0, 0.0, 0.0])::DOUBLE AS score
 FROM (SELECT count(*) FROM orders)""",
)
def key_column_scores(spark, sf):
    return P.key_column_scores(_statistics(spark, sf).drop("RprtDt"), "sa2")


@check(
    "cls13_alphabetic_shares",
    f"""SELECT unnest(['SA2Nm2016', 'SA2Cd2016', 'ParticipantCount']) AS column_name, unnest([1.0, 0.0, round(count(*) FILTER
 (regexp_matches(f, '[A-Za-z]')) / count(*), 6)]) AS text_share FROM (SELECT {SQL_FIGURE} AS f FROM orders)""",
)
def alphabetic_shares(spark, sf):
    rows = _statistics(spark, sf).select("SA2Cd2016", "SA2Nm2016", "ParticipantCount")
    assert P.detect_name_column(rows, "SA2Cd2016") == "SA2Nm2016"
    return P.alphabetic_shares(rows).withColumn("text_share", r("text_share", 6))


@check(
    "cls14_indicator_scores",
    f"""SELECT 'figure' AS column_name, round(count(x) / count(f), 6) AS numeric_share FROM (SELECT {SQL_FIGURE} AS f,
 {SQL_NUMBER} AS x FROM orders) UNION ALL SELECT 'o_totalprice', 1.0 UNION ALL SELECT 'o_orderkey', 1.0""",
)
def indicator_scores(spark, sf):
    rows = printed(spark, sf).select(
        "o_orderkey", F.col("o_custkey").alias("lga_code"), "o_orderpriority", "o_totalprice", "figure"
    )
    return P.indicator_scores(rows).withColumn("numeric_share", r("numeric_share", 6))


@check(
    "arr1_name_parts",
    """SELECT 'parts' AS family, lower(p_type) AS source, count(*) AS column_count FROM part JOIN lineitem ON l_partkey = p_partkey
 GROUP BY 1, 2""",
)
def name_parts(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_type", "p_name")
    catalog = table(spark, sf, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("__", F.lit("parts"), F.lower("p_type"), "p_name").alias("column_name")
    )
    return C.name_parts(catalog)


@check(
    "num3_parse_rates",
    f"""SELECT 'figure' AS column_name, count(*) AS row_count, count(f) AS non_missing, count(x) AS parsed_count
 FROM (SELECT {SQL_FIGURE} AS f, {SQL_NUMBER} AS x FROM orders)""",
)
def parse_rates(spark, sf):
    return P.parse_rates(printed(spark, sf), ["figure"]).drop("parsed_min", "parsed_max")
