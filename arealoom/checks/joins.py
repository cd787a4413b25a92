"""Joins and set operators (JN, SET)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealoom.checks.registry import (
    SQL_BRIDGE, SQL_INVENTORY, check, inventory, order_bridge, r, table,
)
from arealoom.operators import joins as J
from arealoom.operators import windows as W


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@check(
    "jn1_contract_join",
    """SELECT c_custkey, c_name, coalesce(round(total, 2), -1) AS total, coalesce(orders, 0) AS orders, total IS NOT NULL AS
 has_orders FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS orders FROM orders GROUP BY 1) o
 ON o_custkey = c_custkey""",
)
def contract_join(spark, sf):
    per = _orders(spark, sf).groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        r(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("orders")
    )
    spine = table(spark, sf, "customer").select("c_custkey", "c_name")
    joined = J.contract_join(spine, per, "c_custkey", validate="1:1", flag="has_orders")
    return joined.na.fill({"total": -1.0, "orders": 0})


@check(
    "jn2_many_to_one",
    """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
 LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def many_to_one(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    out = J.contract_join(customers, nations, "n_nationkey", validate="m:1")
    out = J.contract_join(out, table(spark, sf, "region"), "r_regionkey", validate="m:1")
    return out.select("c_custkey", "n_name", "r_name")


@check(
    "jn3_many_to_many",
    f"""WITH {SQL_BRIDGE} SELECT coalesce(l_suppkey, -1) AS l_suppkey, count(*) AS edges,
 coalesce(round(sum(o_totalprice * ratio), 1), -1) AS allocated FROM orders LEFT JOIN bridge ON l_orderkey = o_orderkey
 GROUP BY 1""",
)
def many_to_many(spark, sf):
    bridge = order_bridge(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    joined = J.contract_join(_orders(spark, sf), bridge, "o_orderkey", validate="m:n")
    total = r(F.sum(F.col("o_totalprice") * F.col("ratio")), 1)
    out = joined.groupBy("l_suppkey").agg(F.count("*").alias("edges"), total.alias("allocated"))
    return out.na.fill(-1)


@check(
    "jn4_join_with_indicator",
    """SELECT merge_status, count(*) AS n FROM (SELECT CASE WHEN l_orderkey IS NULL THEN 'left_only' ELSE 'both' END
 AS merge_status FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey) GROUP BY 1""",
)
def join_with_indicator(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    joined = J.join_with_indicator(_orders(spark, sf), lines, "o_orderkey")
    return joined.groupBy("merge_status").agg(F.count("*").alias("n"))


@check(
    "jn5_unmatched",
    """SELECT o_orderkey, 'no lines' AS reason FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem
 WHERE l_orderkey = o_orderkey)""",
)
def unmatched(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.unmatched(_orders(spark, sf), lines, "o_orderkey", "no lines").select("o_orderkey", "reason")


@check(
    "jn6_in_spine",
    """SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders
 WHERE o_orderpriority = '1-URGENT') GROUP BY 1""",
)
def in_spine(spark, sf):
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    kept = J.in_spine(table(spark, sf, "lineitem"), urgent, "l_orderkey")
    return kept.groupBy("l_suppkey").agg(F.count("*").alias("n"))


@check(
    "jn7_compose_bridge",
    """SELECT n_regionkey, s_nationkey, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey
 GROUP BY 1, 2""",
)
def compose_bridge(spark, sf):
    fine_a = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("unit"), "s_suppkey", "s_nationkey")
    fine_b = table(spark, sf, "nation").select(F.col("n_nationkey").alias("unit"), "n_regionkey")
    return J.compose_bridge(fine_a, fine_b, "unit").groupBy("n_regionkey", "s_nationkey").agg(
        F.count("*").alias("suppliers")
    )


@check(
    "jn8_merge_wide",
    """SELECT coalesce(a.k, b.k, c.k) AS k, coalesce(returned, 0) AS returned, coalesce(spring, 0) AS spring,
 coalesce(cheap, 0) AS cheap FROM
 (SELECT l_suppkey AS k, count(*) AS returned FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49 GROUP BY 1) a
 FULL JOIN (SELECT l_suppkey AS k, count(*) AS spring FROM lineitem WHERE month(l_shipdate) = 4 AND l_quantity < 2
 GROUP BY 1) b ON a.k = b.k FULL JOIN (SELECT l_suppkey AS k, count(*) AS cheap FROM lineitem
 WHERE l_extendedprice < 1200 GROUP BY 1) c ON coalesce(a.k, b.k) = c.k""",
)
def merge_wide(spark, sf):
    lines = table(spark, sf, "lineitem")

    def per(cond, name):
        return lines.filter(cond).groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias(name))

    wide = J.merge_wide(
        [
            per("l_returnflag = 'R' and l_quantity > 49", "returned"),
            per("month(l_shipdate) = 4 and l_quantity < 2", "spring"),
            per("l_extendedprice < 1200", "cheap"),
        ],
        "k",
    )
    return wide.na.fill(0)


@check(
    "jn9_fallback_join",
    """WITH codes AS (SELECT '1' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code9, c_custkey, c_nationkey FROM customer),
 short AS (SELECT substring(code9, 1, 1) || right(code9, 4) AS code5, min(code9) AS lo, max(code9) AS hi,
 min(c_nationkey) AS nation FROM codes GROUP BY 1),
 src AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 1 THEN '1' ||
 right(lpad(CAST(o_custkey AS VARCHAR), 8, '0'), 4) END AS code FROM orders)
 SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'exact_key' WHEN o_orderkey % 3 = 2 THEN 'unmatched'
 WHEN lo <> hi THEN 'ambiguous_derived_key' ELSE 'derived_key' END AS join_method,
 coalesce(CASE WHEN o_orderkey % 3 = 0 THEN c_nationkey WHEN o_orderkey % 3 = 1 AND lo = hi THEN nation END, -1) AS nation
 FROM src JOIN codes ON c_custkey = o_custkey LEFT JOIN short ON code5 = code""",
)
def fallback_join(spark, sf):
    from arealoom.functions import short_code

    full = F.concat(F.lit("1"), F.lpad(F.col("c_custkey").cast("string"), 8, "0"))
    right = table(spark, sf, "customer").select(
        full.alias("full"), short_code(full).alias("short"), "c_nationkey"
    )
    cust = F.lpad(F.col("o_custkey").cast("string"), 8, "0")
    code = (
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("1"), cust))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("1"), F.right(cust, F.lit(4))))
        .otherwise("X")
    )
    left = table(spark, sf, "orders").select("o_orderkey", code.alias("code"))
    joined = J.fallback_join(left, right, ("code", "full"), ("code", "short"))
    return joined.select(
        "o_orderkey", "join_method", F.coalesce("c_nationkey", F.lit(-1)).alias("nation")
    )


@check(
    "jn10_collision_policy",
    """SELECT o_orderkey, o_custkey AS c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS note,
 c_name AS note_customer FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def collision_policy(spark, sf):
    left = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(
        table(spark, sf, "customer").select(
            "c_custkey", F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit").alias("note")
        ),
        "c_custkey",
    )
    right = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("note"))
    return J.contract_join(
        left, right, "c_custkey", validate="m:1", collision="rename_right", suffixes=("", "_customer")
    )


@check(
    "jn11_overlap_suffixes",
    """SELECT k, a.n AS n_download, b.n AS n_parse FROM (SELECT l_suppkey AS k, count(*) AS n FROM lineitem
 WHERE l_linestatus = 'O' GROUP BY 1) a JOIN (SELECT l_suppkey AS k, count(*) AS n FROM lineitem
 WHERE l_linestatus = 'F' GROUP BY 1) b USING (k)""",
)
def overlap_suffixes(spark, sf):
    lines = table(spark, sf, "lineitem")

    def per(status):
        return lines.filter(F.col("l_linestatus") == status).groupBy(F.col("l_suppkey").alias("k")).agg(
            F.count("*").alias("n")
        )

    return J.contract_join(
        per("O"), per("F"), "k", "inner", collision="suffix", suffixes=("_download", "_parse"), check=False
    )


@check(
    "jn12_reconcile_paths",
    f"""WITH {SQL_INVENTORY}, inv AS (SELECT path, doc_id % 7 <> 0 AS active, lower(file_name) AS nm FROM files
 WHERE lang <> 'fr'), moves AS (SELECT lower('raw/old/' || doc_id) AS src, min(path) AS dst FROM files
 WHERE lang <> 'fr' GROUP BY 1), reg AS (SELECT doc_id, CASE CAST(doc_id % 4 AS INTEGER)
 WHEN 0 THEN path WHEN 1 THEN 'raw/old/' || doc_id WHEN 2 THEN 'lost/' || file_name ELSE 'gone/x' || doc_id END AS path
 FROM files), by_name AS (SELECT nm, count(*) FILTER (active) AS na, count(*) FILTER (NOT active) AS nx,
 min(path) FILTER (active) AS fa, min(path) FILTER (NOT active) AS fx FROM inv GROUP BY 1)
 SELECT doc_id, coalesce(i.path, dst, fa, fx, reg.path) AS new_path, CASE WHEN i.path IS NOT NULL THEN 'path_still_valid'
 WHEN dst IS NOT NULL THEN 'reconciled_from_move_plan' WHEN na = 1 THEN 'unique_active_name' WHEN na > 1 THEN
 'first_of_several_active_names' WHEN nx = 1 THEN 'unique_archive_name' WHEN nx > 1 THEN
 'first_of_several_archive_names' ELSE 'missing' END AS path_status FROM reg LEFT JOIN inv i ON i.path = reg.path
 LEFT JOIN moves ON src = lower(reg.path) LEFT JOIN by_name ON by_name.nm = lower(regexp_extract(reg.path, '[^/]*$'))""",
)
def reconcile_paths(spark, sf):
    files, key = inventory(spark, sf), F.col("doc_id")
    inv = files.filter("lang <> 'fr'").select("path", (key % 7 != 0).alias("active"))
    moves = files.select(
        F.concat(F.lit("RAW/old/"), key.cast("string")).alias("source_path"), F.col("path").alias("destination_path")
    )
    register = files.select(
        "doc_id",
        F.when(key % 4 == 0, F.col("path"))
        .when(key % 4 == 1, F.concat(F.lit("raw/old/"), key.cast("string")))
        .when(key % 4 == 2, F.concat(F.lit("lost/"), F.col("file_name")))
        .otherwise(F.concat(F.lit("gone/x"), key.cast("string")))
        .alias("path"),
    )
    return J.reconcile_paths(register, inv, moves).select("doc_id", "new_path", "path_status")


@check(
    "jn13_lookup_manifest",
    f"""WITH {SQL_INVENTORY} SELECT doc_id, CASE WHEN lang = 'de' THEN '' ELSE lang END AS lang FROM files""",
)
def lookup_manifest(spark, sf):
    files, key = inventory(spark, sf), F.col("doc_id")
    manifest = files.filter("lang <> 'de'").select(
        F.when(key % 2 == 0, F.upper("path")).otherwise(F.concat(F.lit("elsewhere/"), F.col("file_name"))).alias("local_path"),
        "lang", F.col("doc_id").alias("row_no"),
    )
    out = J.lookup_manifest(files.select("doc_id", "path"), manifest, "path", "local_path", "lang", "row_no")
    return out.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"))


@check(
    "jn14_lookup_any",
    f"""WITH {SQL_INVENTORY}, reg AS (SELECT doc_id AS row_no, path, file_name, family FROM files SEMI JOIN labels USING (doc_id)),
 pth AS (SELECT path, min(row_no) AS m FROM reg GROUP BY 1), nme AS (SELECT file_name, min(row_no) AS m FROM reg GROUP BY 1),
 fam AS (SELECT family, min(row_no) AS m FROM reg GROUP BY 1) SELECT doc_id, coalesce(least(pth.m, nme.m, fam.m), -1)
 AS row_no FROM files LEFT JOIN pth USING (path) LEFT JOIN nme USING (file_name) LEFT JOIN fam USING (family)""",
)
def lookup_any(spark, sf):
    files = inventory(spark, sf).select("doc_id", "path", "file_name", "family")
    register = J.in_spine(files, table(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").alias("row_no"), F.col("path").alias("p"), F.col("file_name").alias("n"), F.col("family").alias("f")
    )
    keys = [(F.col("path"), F.col("p")), (F.col("file_name"), F.col("n")), (F.col("family"), F.col("f"))]
    out = J.lookup_any(files, register, keys, "row_no", ["row_no"])
    return out.select("doc_id", F.coalesce("row_no", F.lit(-1)).alias("row_no"))


@check(
    "jn14_lookup_ending",
    f"""WITH {SQL_INVENTORY}, reg AS (SELECT doc_id AS row_no, path FROM files SEMI JOIN labels USING (doc_id)), asked AS (
 SELECT doc_id, right(file_name, 6 + CAST(doc_id % 4 AS INTEGER)) AS tail FROM files), hits AS (
 SELECT a.tail, min(row_no) AS row_no FROM (SELECT DISTINCT tail FROM asked) a JOIN reg ON ends_with(reg.path, a.tail) GROUP BY 1)
 SELECT doc_id, coalesce(row_no, -1) AS row_no FROM asked LEFT JOIN hits USING (tail)""",
)
def lookup_ending(spark, sf):
    files = inventory(spark, sf)
    register = J.in_spine(files, table(spark, sf, "labels"), "doc_id").select(F.col("doc_id").alias("row_no"), F.col("path").alias("p"))
    tail = F.right("file_name", (6 + F.col("doc_id") % 4).cast("int"))
    out = J.lookup_any(files.select("doc_id", tail.alias("tail")), register, [], "row_no", ["row_no"], suffixes=[("tail", "p")])
    return out.select("doc_id", F.coalesce("row_no", F.lit(-1)).alias("row_no"))


@check(
    "jn15_discover_keys",
    """WITH vals AS (SELECT DISTINCT column_name, value FROM (SELECT 'c_nationkey' AS column_name,
 CAST(c_nationkey AS VARCHAR) AS value FROM customer UNION ALL SELECT 'c_custkey', CAST(c_custkey AS VARCHAR) FROM customer
 UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM customer)), tgt AS (SELECT 'nation' AS target,
 CAST(n_nationkey AS VARCHAR) AS value FROM nation UNION ALL SELECT 'region', CAST(r_regionkey AS VARCHAR) FROM region
 UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR) FROM supplier)
 SELECT column_name, target, count(DISTINCT v.value) AS unique_values,
 count(DISTINCT CASE WHEN v.value = tgt.value THEN v.value END) AS matched_values,
 round(count(DISTINCT CASE WHEN v.value = tgt.value THEN v.value END) / count(DISTINCT v.value), 4) AS match_rate,
 round(count(DISTINCT CASE WHEN v.value = tgt.value THEN v.value END) / count(DISTINCT tgt.value), 4) AS coverage
 FROM vals v, tgt GROUP BY 1, 2""",
)
def discover_keys(spark, sf):
    targets = {
        "nation": table(spark, sf, "nation").select("n_nationkey"),
        "region": table(spark, sf, "region").select("r_regionkey"),
        "supplier": table(spark, sf, "supplier").select("s_suppkey"),
    }
    found = J.discover_keys(table(spark, sf, "customer"), targets, ["c_nationkey", "c_custkey", "c_mktsegment"])
    return found.select(
        "column_name", "target", "unique_values", "matched_values", r("match_rate").alias("match_rate"),
        r("coverage").alias("coverage"),
    )


@check(
    "jn16_flag_membership",
    """SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS pending FROM customer""",
)
def flag_membership(spark, sf):
    pending = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return J.flag_membership(table(spark, sf, "customer").select("c_custkey"), pending, "c_custkey", "pending")


@check(
    "set1_union_all",
    """SELECT name, nation, coalesce(balance, 0) AS balance, segment FROM (SELECT c_name AS name, c_nationkey AS nation,
 c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL
 FROM supplier UNION ALL SELECT n_name, n_nationkey, NULL, NULL FROM nation)""",
)
def union_all(spark, sf):
    a = table(spark, sf, "customer").selectExpr(
        "c_name as name", "c_nationkey as nation", "c_acctbal as balance", "c_mktsegment as segment"
    )
    b = table(spark, sf, "supplier").selectExpr("s_acctbal as balance", "s_name as name", "s_nationkey as nation")
    c = table(spark, sf, "nation").selectExpr("n_nationkey as nation", "n_name as name")
    return W.union_all([a, b, c]).na.fill(0.0, ["balance"])


_A = "l_partkey as k"


@check(
    "set2_matched_keys",
    """SELECT k FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity = 1 INTERSECT
 SELECT l_partkey FROM lineitem WHERE l_quantity = 50)""",
)
def matched_keys(spark, sf):
    lines = table(spark, sf, "lineitem")
    return W.matched_keys(lines.filter("l_quantity = 1").selectExpr(_A), lines.filter("l_quantity = 50").selectExpr(_A))


@check(
    "set3_missing_keys",
    """SELECT k FROM (SELECT l_partkey AS k FROM lineitem WHERE l_quantity = 1 EXCEPT
 SELECT l_partkey FROM lineitem WHERE l_quantity = 50)""",
)
def missing_keys(spark, sf):
    lines = table(spark, sf, "lineitem")
    return W.missing_keys(lines.filter("l_quantity = 1").selectExpr(_A), lines.filter("l_quantity = 50").selectExpr(_A))


@check(
    "set4_all_keys",
    """SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation""",
)
def all_keys(spark, sf):
    frames = [
        table(spark, sf, t).selectExpr(f"{c} as k")
        for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))
    ]
    return W.all_keys(frames, "k")


@check(
    "set5_merge_records",
    """SELECT k, repeat('a;', CAST(na AS INTEGER)) || 'b' AS record_origin, name FROM (SELECT c_nationkey AS k,
 count(*) FILTER (c_acctbal < 0) AS na, coalesce(min_by(c_mktsegment, c_custkey) FILTER (c_acctbal < 0
 AND c_custkey % 3 = 0), any_value(n_name)) AS name FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)""",
)
def merge_records(spark, sf):
    a = table(spark, sf, "customer").filter("c_acctbal < 0").select(
        F.col("c_nationkey").alias("k"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).otherwise(" ").alias("name"),
        F.col("c_custkey").alias("row_no"),
    )
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey"))
    b = J.in_spine(table(spark, sf, "nation"), customers, "n_nationkey").select(
        F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("row_no")
    )
    return W.merge_records([("a", a), ("b", b)], "k", ["name"], "row_no")
