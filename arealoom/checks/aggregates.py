"""Aggregations and reshape (AGG, plus the bridge aggregates)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealoom import functions as FN
from arealoom.checks.registry import (
    SQL_BRIDGE, SQL_FIGURE, SQL_INVENTORY, SQL_NUMBER, cells, check, inventory, iso, order_bridge,
    printed, r, table,
)
from arealoom.operators import aggregates as A
from arealoom.operators import bridges as B
from arealoom.operators import profiling as P
from arealoom.operators import reshape as R

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@check(
    "agg1_duplicate_keys",
    """SELECT coalesce(k, -1) AS k, count(*) AS row_count FROM (SELECT CASE WHEN l_quantity = 50 THEN NULL
 ELSE l_orderkey END AS k FROM lineitem) GROUP BY 1 HAVING count(*) > 1""",
)
def duplicate_keys(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.when(F.col("l_quantity") != 50, F.col("l_orderkey")).alias("k"))
    return A.duplicate_keys(lines, "k").na.fill(-1)


@check(
    "agg2_rollup_codes",
    f"""SELECT o_custkey, min_by(s, o_orderkey) FILTER (s IS NOT NULL) AS s, round(sum(x), 2) AS x, count(*) AS source_rows,
 count(x) AS published_rows, count(*) - count(x) AS suppressed_rows FROM (SELECT o_custkey, o_orderkey,
 CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS s, {SQL_NUMBER} AS x FROM orders) GROUP BY 1""",
)
def rollup_codes(spark, sf):
    rows = printed(spark, sf).select(
        "o_custkey", "o_orderkey",
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise(" ").alias("s"),
        FN.parse_measure("figure").alias("x"),
    )
    return A.rollup_codes(rows, "o_custkey", "s", "x", F.col("o_orderkey")).withColumn("x", r("x", 2))


@check(
    "agg3_ratio_allocation",
    f"""WITH {SQL_BRIDGE}, split AS (SELECT l_orderkey, count(*) > 1 AS split FROM bridge GROUP BY 1)
 SELECT l_suppkey, round(sum(x * ratio), 2) AS x, count(DISTINCT l_orderkey) AS contributing_codes,
 count(*) AS contributing_edges, count(*) FILTER (split) AS split_edges, round(min(ratio), 6) AS min_ratio,
 round(max(ratio), 6) AS max_ratio FROM bridge JOIN split USING (l_orderkey)
 JOIN (SELECT o_orderkey AS l_orderkey, {SQL_NUMBER} AS x FROM orders) USING (l_orderkey) GROUP BY 1""",
)
def ratio_allocation(spark, sf):
    values = printed(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), FN.parse_measure("figure").alias("x"))
    out = B.allocate(values, order_bridge(spark, sf), "l_orderkey", "l_suppkey", "ratio", ["x"])
    return out.withColumns({"x": r("x", 2), "min_ratio": r("min_ratio", 6), "max_ratio": r("max_ratio", 6)})


@check(
    "agg5_share_of_total",
    """SELECT l_partkey, l_returnflag, round(v, 2) AS v, n AS unit_count, round(v / sum(v) OVER (PARTITION BY l_partkey), 6)
 AS share FROM (SELECT l_partkey, l_returnflag, sum(l_extendedprice) AS v, count(*) AS n FROM lineitem GROUP BY 1, 2)""",
)
def share_of_total(spark, sf):
    out = B.share_of_total(
        table(spark, sf, "lineitem").withColumnRenamed("l_extendedprice", "v"), "l_partkey", "l_returnflag", "v"
    )
    return out.select("l_partkey", "l_returnflag", r("v", 2).alias("v"), "unit_count", r("share", 6).alias("share"))


@check(
    "agg6_ratio_sum_check",
    f"""WITH {SQL_BRIDGE} SELECT l_orderkey, round(sum(ratio), 6) AS ratio_sum, NOT (sum(ratio) BETWEEN 0.98 AND 1.02)
 AS outside_tolerance FROM bridge WHERE ratio > 0.1 GROUP BY 1""",
)
def ratio_sum_check(spark, sf):
    bridge = order_bridge(spark, sf).filter("ratio > 0.1")
    return B.ratio_sum_check(bridge, "l_orderkey", "ratio").withColumn("ratio_sum", r("ratio_sum", 6))


@check(
    "agg7_mapping_cardinality",
    """WITH p AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) SELECT (SELECT count(DISTINCT l_orderkey) FROM p)
 AS from_codes, (SELECT count(DISTINCT l_suppkey) FROM p) AS to_codes, (SELECT count(*) FROM (SELECT l_orderkey FROM p
 GROUP BY 1 HAVING count(*) > 1)) AS one_to_many, (SELECT count(*) FROM (SELECT l_suppkey FROM p GROUP BY 1
 HAVING count(*) > 1)) AS many_to_one""",
)
def mapping_cardinality(spark, sf):
    return B.mapping_cardinality(table(spark, sf, "lineitem"), "l_orderkey", "l_suppkey")


@check(
    "agg8_first_non_null",
    """SELECT o_custkey, coalesce(min_by(o_orderpriority, o_orderkey) FILTER (o_orderkey % 3 = 0), '') AS a,
 coalesce(min_by(o_orderstatus, o_orderkey) FILTER (o_orderkey % 4 = 0), '') AS b FROM orders GROUP BY 1""",
)
def first_non_null(spark, sf):
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.when(key % 3 == 0, F.col("o_orderpriority")).alias("a"),
        F.when(key % 4 == 0, F.col("o_orderstatus")).alias("b"),
    )
    return A.first_non_null(rows, "o_custkey", ["a", "b"], key).na.fill("")


@check(
    "agg9_distribution",
    """SELECT coalesce(p, 'null') AS p, count(*) AS row_count, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 3)
 AS row_pct FROM (SELECT nullif(o_orderpriority, '5-LOW') AS p FROM orders) GROUP BY 1""",
)
def distribution(spark, sf):
    rows = table(spark, sf, "orders").select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    return A.distribution(rows, "p").na.fill("null")


@check(
    "agg10_summarise_status",
    """SELECT source, lang, coalesce(q, 'unlabelled') AS status, count(doc_id) AS tables, CAST(sum(n_chars) AS BIGINT) AS rows,
 max(n_chars) AS columns_max FROM documents LEFT JOIN (SELECT doc_id, 'q' || quality AS q FROM labels) USING (doc_id)
 GROUP BY 1, 2, 3""",
)
def summarise_status(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("q"))
    audit = table(spark, sf, "documents").join(labels, "doc_id", "left").select(
        "source", "lang", F.coalesce("q", F.lit("unlabelled")).alias("status"), "doc_id", "n_chars"
    )
    return A.summarise_status(audit, ["source", "lang", "status"], "doc_id", "n_chars", "n_chars")


@check(
    "agg11_rollup_inventory",
    f"""WITH {SQL_INVENTORY} SELECT family, count(*) AS file_count, CAST(sum(size) AS BIGINT) AS total_size_bytes,
 round(sum(size) / 1048576.0, 6) AS total_size_mb, array_to_string(list_sort(list(DISTINCT file_extension)), ';')
 AS file_extension, array_to_string(list_sort(list(DISTINCT lang)), ';') AS lang FROM files GROUP BY 1""",
)
def rollup_inventory(spark, sf):
    return A.rollup_inventory(inventory(spark, sf), "family", "size", ["file_extension", "lang"])


@check(
    "agg12_allocation_audit",
    f"""WITH {SQL_BRIDGE}, v AS (SELECT o_orderkey AS l_orderkey, {SQL_NUMBER} AS x FROM orders),
 b AS (SELECT * FROM bridge WHERE ratio > 0.02), a AS (SELECT l_suppkey, sum(x * ratio) AS x FROM b JOIN v
 USING (l_orderkey) GROUP BY 1), t AS (SELECT (SELECT count(*) FROM v) AS source_codes, (SELECT count(*) FROM a)
 AS target_codes, (SELECT count(*) FROM v ANTI JOIN b USING (l_orderkey)) AS unmatched_codes, (SELECT sum(x) FROM v) AS s,
 (SELECT sum(x) FROM a) AS al, (SELECT coalesce(sum(x), 0) FROM v ANTI JOIN b USING (l_orderkey)) AS u)
 SELECT source_codes, target_codes, unmatched_codes, round(s, 0) AS source_total, round(al, 0) AS allocated_total,
 round(u, 0) AS unmatched_total, round(s - al, 0) AS total_difference, round(al * 100.0 / s, 3) AS retained_pct,
 CASE WHEN al * 100.0 / s >= 98 THEN 'pass' ELSE 'review' END AS status FROM t""",
)
def allocation_audit(spark, sf):
    values = printed(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), FN.parse_measure("figure").alias("x"))
    bridge = order_bridge(spark, sf, stored=True).filter("ratio > 0.02")
    allocated = B.allocate(values, bridge, "l_orderkey", "l_suppkey", "ratio", ["x"])
    audit = B.allocation_audit(values, allocated, bridge, "l_orderkey", ["x"])
    names = ["source_total", "allocated_total", "unmatched_total", "total_difference"]
    return audit.withColumns({**{n: r(n, 0) for n in names}, "retained_pct": r("retained_pct", 3)})


_ORDERS_WITH_NULLS = """(SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS total FROM orders)"""


def _gaps(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(key % 7 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(key % 3 != 0, F.col("o_totalprice")).alias("total"),
    )


@check(
    "agg13_missingness",
    f"""SELECT column_name, missing AS missing_count, round(missing * 100.0 / n, 3) AS missing_pct FROM (SELECT
 unnest(['o_orderkey', 'status', 'total']) AS column_name, unnest([count(*) - count(o_orderkey), count(*) - count(status),
 count(*) - count(total)]) AS missing, count(*) AS n FROM {_ORDERS_WITH_NULLS})""",
)
def missingness(spark, sf):
    return A.missingness(_gaps(spark, sf))


@check(
    "agg14_numeric_profile",
    f"""SELECT 'figure' AS column_name, count(*) AS row_count, count(f) AS non_missing, count(x) AS numeric_count,
 round(count(x) / count(f), 6) AS parse_rate, count(DISTINCT f) AS distinct_values, min(x) AS min_value,
 max(x) AS max_value, round(sum(x), 0) AS sum_value FROM (SELECT {SQL_FIGURE} AS f, {SQL_NUMBER} AS x FROM orders)
 UNION ALL SELECT 'o_custkey', count(*), count(*), count(*), 1.0, count(DISTINCT o_custkey), CAST(min(o_custkey) AS DOUBLE),
 CAST(max(o_custkey) AS DOUBLE), CAST(sum(o_custkey) AS DOUBLE) FROM orders""",
)
def numeric_profile(spark, sf):
    return P.numeric_profile(printed(spark, sf), ["figure", "o_custkey"]).withColumn("sum_value", r("sum_value", 0))


@check(
    "agg15_field_dictionary",
    """SELECT c AS column_name, count(*) AS row_count, count(v) AS non_missing, count(*) - count(v) AS missing,
 count(DISTINCT v) AS unique_values, count(v) FILTER (c IN ('p_size', 'p_retailprice')) AS numeric_like,
 array_to_string(list_sort(list(DISTINCT v) FILTER (v IS NOT NULL))[1:3], ' | ') AS sample_values, CASE c WHEN 'p_brand'
 THEN 'category' WHEN 'p_size' THEN 'measure' ELSE 'unclassified' END AS field_role FROM (SELECT unnest(['p_brand', 'p_size',
 'p_type']) AS c, unnest([p_brand, CAST(p_size AS VARCHAR), CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_type END]) AS v
 FROM part) GROUP BY 1""",
)
def field_dictionary(spark, sf):
    parts = table(spark, sf, "part").select(
        "p_brand", "p_size", F.when(F.col("p_partkey") % 9 != 0, F.col("p_type")).alias("p_type")
    )
    return P.field_dictionary(parts, [("category", "brand"), ("measure", "size|price")], k=3)


@check(
    "agg16_pivot_first",
    """SELECT o_custkey, """
    + ", ".join(
        f"coalesce(min_by(o_totalprice, o_orderkey) FILTER (o_orderpriority = '{p}'), -1) AS \"{p}\"" for p in PRIORITIES
    )
    + " FROM orders GROUP BY 1",
)
def pivot_first(spark, sf):
    orders = table(spark, sf, "orders")
    out = R.pivot_first(orders, "o_custkey", "o_orderpriority", "o_totalprice", PRIORITIES, F.col("o_orderkey"))
    return out.na.fill(-1.0)


_FLAGS = ["a__f", "a__o", "n__f", "n__o", "r__f", "r__o"]


@check(
    "agg17_pivot_sum",
    """SELECT l_suppkey, """
    + ", ".join(
        f"coalesce(sum(l_quantity) FILTER (lower(l_returnflag || '__' || l_linestatus) = '{f}'), 0.0) AS qty_{f.replace('__', '_')}"
        for f in _FLAGS
    )
    + " FROM lineitem GROUP BY 1",
)
def pivot_sum(spark, sf):
    names = [f.replace("__", "_") for f in _FLAGS]
    return R.pivot_sum(
        table(spark, sf, "lineitem"), "l_suppkey", ["l_returnflag", "l_linestatus"], "l_quantity", names, 0.0, "qty_"
    )


@check(
    "agg18_melt",
    """SELECT l_orderkey, l_linenumber, l_partkey, column_name, value FROM (SELECT l_orderkey, l_linenumber, l_partkey,
 unnest(['l_tax', 'l_discount']) AS column_name, unnest([nullif(l_tax, 0), l_discount]) AS value FROM lineitem)
 WHERE value IS NOT NULL""",
)
def melt(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return R.melt(lines, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_tax", "l_discount"])


@check(
    "agg19_select_measures",
    """SELECT user_id, round(coalesce(min_by(value, event_id) FILTER (event_type = 'click' AND k = '7'), -1), 2) AS clicks_7,
 coalesce(min_by(CASE WHEN event_id % 5 = 0 THEN 'n.p.' ELSE 'ok' END, event_id)
 FILTER (event_type = 'click' AND k = '7'), '') AS clicks_7_publication_status,
 coalesce(min_by(props, event_id) FILTER (event_type = 'view'), '') AS views_source_value,
 'not_found_in_extract' AS never_publication_status, coalesce(min_by(props, event_id) FILTER (event_type = 'view' AND
 event_id % 2 = 0), '') AS views_2020, coalesce(min_by(props, event_id) FILTER (event_type = 'view' AND event_id % 2 = 1), '') AS
 views_2021, 'not_found_in_extract' AS views_2022 FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
 GROUP BY 1""",
)
def select_measures(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", "event_id", "event_type", "value", "props", F.get_json_object("props", "$.k").alias("k"),
        F.when(F.col("event_id") % 5 == 0, "n.p.").otherwise("ok").alias("status"), (F.col("event_id") % 2 + 2020).alias("year"),
    )
    specs = {
        "clicks_7": {"event_type": "click", "k": "7"}, "views": {"event_type": "view"}, "never": {"event_type": "absent"},
    }
    out = R.select_measures(events, "user_id", specs, "value", "props", "status", F.col("event_id"))
    views = {"views": specs["views"]}
    yearly = R.select_measures(events, "user_id", views, "value", "props", "status", F.col("event_id"), "year", [2020, 2021, 2022])
    yearly = yearly.select(
        "user_id", *[F.coalesce(f"views_{y}_source_value", F.lit("")).alias(f"views_{y}") for y in (2020, 2021)],
        F.col("views_2022_publication_status").alias("views_2022"),
    )
    return out.join(yearly, "user_id").select(
        "user_id", "views_2020", "views_2021", "views_2022", r(F.coalesce("clicks_7", F.lit(-1.0)), 2).alias("clicks_7"),
        F.coalesce("clicks_7_publication_status", F.lit("")).alias("clicks_7_publication_status"),
        F.coalesce("views_source_value", F.lit("")).alias("views_source_value"), "never_publication_status",
    )


@check(
    "agg20_availability_flags",
    f"""SELECT o_orderkey, CAST(status IS NOT NULL AS INTEGER) + CAST(total IS NOT NULL AS INTEGER) AS qs_present_count,
 status IS NOT NULL OR total IS NOT NULL AS qs_any_available, status IS NOT NULL AND total IS NOT NULL AS qs_complete
 FROM {_ORDERS_WITH_NULLS}""",
)
def availability_flags(spark, sf):
    return A.availability_flags(_gaps(spark, sf), {"qs": ["status", "total"]}).drop("status", "total")


@check(
    "agg21_period_inventory",
    """SELECT CAST(d AS VARCHAR) AS period, count(*) AS row_count, d BETWEEN DATE '1998-01-01' AND DATE '1999-06-30'
 AS in_window, CAST(d - DATE '1998-12-31' AS INTEGER) AS days_from_target FROM (SELECT last_day(CAST(o_orderdate AS DATE))
 AS d FROM orders) GROUP BY d""",
)
def period_inventory(spark, sf):
    months = table(spark, sf, "orders").select(F.last_day(F.col("o_orderdate").cast("date")).alias("period"))
    out = A.period_inventory(months, "period", "1998-12-31", "1998-01-01", "1999-06-30")
    return out.withColumn("period", iso("period"))


@check(
    "agg22_duplicate_rows",
    """SELECT count(*) - count(DISTINCT (l_partkey, l_returnflag, l_linestatus, l_quantity)) AS duplicate_rows FROM lineitem""",
)
def duplicate_rows(spark, sf):
    return A.duplicate_rows(table(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus", "l_quantity"))


@check("agg23_distinct", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def distinct(spark, sf):
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@check(
    "agg24_coverage_summary",
    """SELECT count(*) AS regions, count(*) FILTER (event_type = 'view') AS extracted, count(*) FILTER (event_type = 'click')
 AS empty, count(*) FILTER (event_type = 'error') AS failed, CAST(sum(user_id) AS BIGINT) AS rows_extracted,
 round(count(*) FILTER (event_type = 'view') * 100.0 / count(*), 3) AS extracted_pct FROM events""",
)
def coverage_summary(spark, sf):
    log = table(spark, sf, "events").withColumn(
        "status", FN.map_values("event_type", {"view": "OK", "click": "empty", "error": "failed"}, "skipped")
    )
    return A.coverage_summary(log, "status", "user_id")


@check(
    "agg25_normalise_ratio",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN (SELECT median(l_quantity) FROM lineitem) > 1
 THEN l_quantity / 100.0 ELSE l_quantity END, 6) AS l_quantity, round(CASE WHEN (SELECT max(l_discount) FROM lineitem) > 1.5
 THEN l_discount / 100.0 ELSE l_discount END, 6) AS l_discount FROM lineitem""",
)
def normalise_ratio(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount"
    )
    out = B.normalise_ratio(B.normalise_ratio(lines, "l_quantity"), "l_discount", "max")
    return out.withColumns({"l_quantity": r("l_quantity", 6), "l_discount": r("l_discount", 6)})


@check(
    "agg26_column_labels",
    """SELECT p_brand AS file, CAST(p_partkey AS VARCHAR) AS sheet, col AS col_idx, CASE col
 WHEN 0 THEN CASE WHEN k > 0 THEN p_name || ' | ' ELSE '' END || 'Area | Area code | ' || lpad(CAST(p_partkey AS VARCHAR), 9, '0')
 WHEN 1 THEN 'Area name | ' || p_name WHEN 2 THEN p_type || ' | Count | ' || p_size ELSE 'Rate % | 12.5' END AS column_label
 FROM (SELECT *, p_partkey % 3 AS k, unnest([0, 1, 2, 3]) AS col FROM part)""",
)
def column_labels(spark, sf):
    from arealoom.operators.cells import column_labels as labels

    return labels(cells(spark, sf))


@check(
    "agg27_distinct_parents",
    """SELECT DISTINCT n_regionkey, n_nationkey, n_name FROM nation JOIN customer ON c_nationkey = n_nationkey""",
)
def distinct_parents(spark, sf):
    spine = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return A.distinct_parents(spine, ["n_regionkey", "n_nationkey", "n_name"])


@check(
    "ord3_sample_values",
    """SELECT c AS column_name, array_to_string(list_sort(list(DISTINCT v))[1:6], ' | ') AS sample_values FROM (SELECT
 unnest(['c_name', 'c_mktsegment', 'c_nationkey']) AS c, unnest([c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR)]) AS v
 FROM customer) GROUP BY 1""",
)
def sample_values(spark, sf):
    return P.sample_values(table(spark, sf, "customer"), ["c_name", "c_mktsegment", "c_nationkey"], 6)
