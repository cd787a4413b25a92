"""Contracts and audits (AUD), inventory decisions (CLS12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealoom.checks.registry import SQL_BRIDGE, SQL_INVENTORY, check, inventory, order_bridge, r, table
from arealoom.operators import audit as A
from arealoom.operators.audit import ContractError
from arealoom.operators import bridges as B


@check(
    "aud1_run_checks",
    """SELECT unnest(['rows', 'null_shipdates', 'negative_discounts', 'order_count', 'max_tax']) AS check_name,
 unnest([CAST(count(*) AS DOUBLE), 0, 0, CAST(count(DISTINCT l_orderkey) AS DOUBLE), max(l_tax)]) AS value,
 unnest(['pass', 'pass', 'pass', 'info', 'review']) AS status, unnest(['', '', '', '', 'tax above 5 %']) AS notes FROM lineitem""",
)
def run_checks(spark, sf):
    zero = lambda v: v == 0
    return A.run_checks(
        table(spark, sf, "lineitem"),
        [
            A.Check("rows", F.count("*"), lambda v: v > 0),
            A.Check("null_shipdates", F.count_if(F.col("l_shipdate").isNull()), zero),
            A.Check("negative_discounts", F.count_if(F.col("l_discount") < 0), zero),
            A.Check("order_count", F.count_distinct("l_orderkey")),
            A.Check("max_tax", F.max("l_tax"), lambda v: v <= 0.05, "review", "tax above 5 %"),
        ],
    )


@check(
    "aud1_publish_checked",
    """SELECT unnest(['rows', 'null_dates', 'price_sum', 'max_price', 'null_keys', 'repeated_keys']) AS check_name,
 unnest([CAST(count(*) AS DOUBLE), 0, round(sum(o_totalprice), 1), max(o_totalprice), 0, 0]) AS value, unnest(['pass', 'pass', 'info',
 'review', 'pass', 'pass']) AS status, unnest(['', '', '', 'price above 100', '', '']) AS notes FROM orders""",
)
def publish_checked(spark, sf):
    from arealoom.session import scratch_path
    from arealoom.sources.sinks import publish_checked as publish

    checks = [
        A.Check("rows", F.count("*"), lambda v: v > 0),
        A.Check("null_dates", F.count_if(F.col("o_orderdate").isNull()), lambda v: v == 0),
        A.Check("price_sum", F.sum("o_totalprice")),
        A.Check("max_price", F.max("o_totalprice"), lambda v: v <= 100, "review", "price above 100"),
    ]
    audit = publish(table(spark, sf, "orders"), scratch_path(spark, "published"), checks, "o_orderkey")
    return audit.withColumn("value", F.when(F.col("check_name") == "price_sum", F.round("value", 1)).otherwise(F.col("value")))


@check(
    "aud2_key_report",
    """SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n) FILTER (k IS NULL) AS BIGINT) AS null_key_rows,
 count(*) FILTER (k IS NOT NULL) AS distinct_keys, count(*) FILTER (k IS NOT NULL AND n > 1) AS duplicate_keys,
 CAST(sum(n) FILTER (k IS NOT NULL AND n > 1) AS BIGINT) AS duplicate_key_rows FROM (SELECT k, count(*) AS n FROM
 (SELECT CASE WHEN l_quantity <> 50 THEN l_orderkey END AS k FROM lineitem) GROUP BY k)""",
)
def key_report(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.when(F.col("l_quantity") != 50, F.col("l_orderkey")).alias("k"))
    return A.key_report(lines, "k")


@check(
    "aud3_dependency_violations",
    """SELECT p_name, count(DISTINCT p_brand) AS parent_count FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1""",
)
def dependency_violations(spark, sf):
    A.expect_fd(table(spark, sf, "nation"), "n_nationkey", "n_regionkey")
    return A.dependency_violations(table(spark, sf, "part"), "p_name", "p_brand")


@check(
    "aud4_join_audit",
    """SELECT count(*) AS rows_before, count(*) AS rows_after, CAST(6 AS BIGINT) AS columns_before,
 CAST(10 AS BIGINT) AS columns_after, 'pass' AS status FROM orders""",
)
def join_audit(spark, sf):
    from arealoom.operators.joins import contract_join

    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    after = contract_join(orders, table(spark, sf, "customer"), "c_custkey", validate="m:1")
    return A.join_audit(orders, after, "o_orderkey")


@check(
    "aud5_range_report",
    """SELECT unnest(['max_quantity', 'mean_discount', 'part_count']) AS check_name,
 unnest([max(l_quantity), round(avg(l_discount), 5), CAST(count(DISTINCT l_partkey) AS DOUBLE)]) AS value,
 unnest(['pass', 'pass', 'fail']) AS status, unnest(['1 to 50', '0.0 to 0.1', '0 to 10']) AS notes FROM lineitem""",
)
def range_report(spark, sf):
    lines = table(spark, sf, "lineitem")
    return A.range_report(
        lines,
        {
            "max_quantity": (F.max("l_quantity"), 1, 50),
            "mean_discount": (r(F.avg("l_discount"), 5), 0.0, 0.1),
            "part_count": (F.count_distinct("l_partkey"), 0, 10),
        },
    )


@check(
    "aud6_coverage",
    """WITH b AS (SELECT l_orderkey AS k, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1), t AS (SELECT count(*) AS u,
 count(k) AS m, count(*) FILTER (n > 1) AS s FROM orders LEFT JOIN b ON k = o_orderkey) SELECT u AS unique_codes,
 m AS matched_codes, u - m AS unmatched_codes, round(m * 100.0 / u, 3) AS coverage_pct, s AS codes_needing_allocation,
 CASE WHEN m = u THEN 'pass' WHEN m * 100.0 / u >= 95 THEN 'review' ELSE 'fail' END AS status FROM t""",
)
def coverage(spark, sf):
    return A.coverage(table(spark, sf, "orders"), "o_orderkey", table(spark, sf, "lineitem"), "l_orderkey", "l_suppkey")


@check(
    "aud7_audit_bridge",
    f"""WITH {SQL_BRIDGE}, b AS (SELECT * FROM bridge WHERE ratio > 0.1), f AS (SELECT l_orderkey, count(*) AS n,
 sum(ratio) AS s FROM b GROUP BY 1), t AS (SELECT l_suppkey, count(*) AS n FROM b GROUP BY 1)
 SELECT 'rows' AS check_name, CAST(count(*) AS DOUBLE) AS value, 'pass' AS status FROM b
 UNION ALL SELECT 'missing_from_codes', 0, 'pass' UNION ALL SELECT 'missing_to_codes', 0, 'pass'
 UNION ALL SELECT 'missing_ratios', 0, 'pass' UNION ALL SELECT 'ratios_outside_0_1', 0, 'pass'
 UNION ALL SELECT 'from_codes', count(*), 'info' FROM f UNION ALL SELECT 'one_to_many', count(*) FILTER (n > 1), 'info' FROM f
 UNION ALL SELECT 'ratio_sums_outside', count(*) FILTER (NOT s BETWEEN 0.98 AND 1.02), 'review' FROM f
 UNION ALL SELECT 'to_codes', count(*), 'info' FROM t UNION ALL SELECT 'many_to_one', count(*) FILTER (n > 1), 'info' FROM t""",
)
def audit_bridge(spark, sf):
    bridge = order_bridge(spark, sf).filter("ratio > 0.1")
    return B.audit_bridge(bridge, "l_orderkey", "l_suppkey", "ratio").drop("notes")


@check(
    "aud8_validate_register",
    """WITH t AS (SELECT o_orderkey // 2 AS id, count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS bad FROM orders GROUP BY 1)
 SELECT unnest(['rows', 'null_ids', 'duplicate_ids', 'values_not_allowed_o_orderstatus']) AS check_name,
 unnest([CAST(sum(n) AS DOUBLE), 0.0, CAST(count(*) FILTER (n > 1) AS DOUBLE), CAST(sum(bad) AS DOUBLE)]) AS value,
 unnest(['info', 'pass', 'fail', 'fail']) AS status FROM t""",
)
def validate_register(spark, sf):
    register = table(spark, sf, "orders").withColumn("id", F.floor(F.col("o_orderkey") / 2))
    return A.validate_register(register, "id", {"o_orderstatus": ["O", "F"]}).drop("notes")


@check(
    "aud9_gate",
    """SELECT l_suppkey, count(*) AS n, CASE WHEN (SELECT count(*) FROM lineitem WHERE l_quantity > 10) > 0
 THEN 'failed checks: [''small_quantities'']' ELSE 'open' END AS second_gate FROM lineitem GROUP BY 1""",
)
def gate(spark, sf):
    """Rows come out because the first gate opens; the second one closes, and its message is a column."""
    lines = table(spark, sf, "lineitem")
    A.gate(A.run_checks(lines, [A.Check("rows", F.count("*"), lambda v: v > 0)]))
    second = "open"
    try:
        A.gate(A.run_checks(lines, [A.Check("small_quantities", F.count_if(F.col("l_quantity") > 10), lambda v: v == 0)]))
    except ContractError as error:
        second = str(error)
    return lines.groupBy("l_suppkey").agg(F.count("*").alias("n")).withColumn("second_gate", F.lit(second))


@check(
    "aud10_column_change_audit",
    """SELECT unnest(['o_orderkey', 'o_orderstatus', 'o_totalprice', 'o_custkey', '']) AS old_column,
 unnest(['o_orderkey', 'status', 'total', '', 'year']) AS new_column,
 unnest(['kept', 'renamed', 'renamed', 'dropped', 'created']) AS change,
 unnest([0, count(*) FILTER (o_orderstatus = 'P'), 0, -1, 0]) AS missing_count FROM orders""",
)
def column_change_audit(spark, sf):
    before = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    after = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.col("o_totalprice").alias("total"),
        F.year("o_orderdate").alias("year"),
    )
    out = A.column_change_audit(before, after, {"o_orderstatus": "status", "o_totalprice": "total"})
    return out.na.fill(-1, ["missing_count"])


@check(
    "aud11_explain_unmatched",
    """SELECT p_partkey, coalesce(n, 0) AS n_download, coalesce(q, 0) AS q_parse FROM part LEFT JOIN (SELECT l_partkey,
 count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a ON a.l_partkey = p_partkey LEFT JOIN (SELECT l_partkey,
 max(l_quantity) AS q FROM lineitem GROUP BY 1) b ON b.l_partkey = p_partkey WHERE p_partkey NOT IN (SELECT l_partkey
 FROM lineitem WHERE l_quantity > 45)""",
)
def explain_unmatched(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    logs = {
        "download": lines.filter("l_returnflag = 'A'").groupBy("p_partkey").agg(F.count("*").alias("n")),
        "parse": lines.groupBy("p_partkey").agg(F.max("l_quantity").alias("q")),
    }
    parts = table(spark, sf, "part").select("p_partkey")
    return A.explain_unmatched(parts, lines.filter("l_quantity > 45"), "p_partkey", logs).na.fill(0)


@check(
    "aud15_allocation_gate",
    """WITH t AS (SELECT l_returnflag, 100.0 * sum(l_quantity) FILTER (l_discount < 0.095) / sum(l_quantity) AS p,
 count(DISTINCT l_suppkey) FILTER (l_discount >= 0.095 AND l_returnflag = 'A') AS unmatched_codes FROM lineitem GROUP BY 1)
 SELECT l_returnflag, round(p, 4) AS retained_pct, unmatched_codes, CASE WHEN unmatched_codes > 0 THEN 'fail' WHEN p < 90
 THEN 'review' ELSE 'pass' END AS status FROM t""",
)
def allocation_gate(spark, sf):
    kept, quantity = F.col("l_discount") < 0.095, F.col("l_quantity")
    lost = F.when(~kept & (F.col("l_returnflag") == "A"), F.col("l_suppkey"))
    totals = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        r(F.sum(F.when(kept, quantity)) * 100.0 / F.sum(quantity)).alias("retained_pct"),
        F.count_distinct(lost).alias("unmatched_codes"),
    )
    return A.allocation_gate(totals, 90.0, fail_unmatched=True)


@check(
    "cls12_recommend",
    f"""WITH {SQL_INVENTORY} SELECT doc_id, CASE WHEN n > 1 THEN 'review_duplicate_keep_one_active_copy' WHEN contains(path,
 'capture') THEN 'archive_browser_capture_debris' WHEN file_extension = '.tmp' THEN 'delete_or_archive_partial_download'
 WHEN file_extension = '.png' THEN 'archive_non_data_binary' WHEN file_extension = '.html' THEN 'keep_source_page_snapshot'
 WHEN file_extension IN ('.xlsx', '.csv') THEN 'keep_pending_schema_inspection' WHEN file_extension = '.zip' THEN
 'keep_or_extract_after_member_review' WHEN lang = 'de' THEN 'manual_review_unknown_file' ELSE 'keep' END AS recommendation
 FROM (SELECT *, count(*) OVER (PARTITION BY sha256) AS n FROM files)""",
)
def recommend(spark, sf):
    from arealoom.operators.inventory import recommend as advise

    files = inventory(spark, sf).drop("text")
    copies = files.groupBy("sha256").agg(F.count("*").alias("group_size"))
    hint = F.when(F.col("lang") == "de", "unknown").otherwise(F.col("family"))
    return advise(files.join(copies, "sha256").withColumn("hint", hint)).select("doc_id", "recommendation")
