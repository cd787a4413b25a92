"""Composite plans (PIP)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealoom import functions as FN
from arealoom.checks.registry import (
    SQL_BRIDGE, SQL_NUMBER, check, iso, order_bridge, printed, r, table,
)
from arealoom.operators.catalog import MUST, NEVER
from arealoom.plans import bridges as PB
from arealoom.plans import master as PM
from arealoom.plans import reallocate as PR
from arealoom.plans import sources as PS
from arealoom.plans import spine as SP
from arealoom.plans import staging as ST
from arealoom.session import scratch_path

_WINDOW = dict(target="1998-12-31", start="1998-01-01", end="1999-06-30")


def _area(c):
    """A nine-digit area code from a key."""
    return F.concat(F.lit("1"), F.lpad(F.col(c).cast("string"), 8, "0"))


@check(
    "pip1_build_spine",
    """SELECT '1' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS sa2_code, CAST(c_nationkey AS VARCHAR) AS sa3_code,
 n_regionkey::VARCHAR AS sa4_code, c_name AS sa2_name, n_name AS sa3_name FROM customer JOIN nation ON n_nationkey =
 c_nationkey WHERE c_custkey % 20 <> 0""",
)
def build_spine(spark, sf):
    code = F.when(F.col("c_custkey") % 20 == 0, "total").otherwise(F.concat(F.lit(" "), _area("c_custkey"), F.lit(".0")))
    raw = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        code.alias("SA2_MAIN"), F.col("c_nationkey").alias("sa3_code"), F.col("n_regionkey").alias("sa4_code"),
        F.concat("c_name", F.lit(" ")).alias("sa2_name"), F.col("n_name").alias("sa3_name"),
    )
    twice = raw.unionByName(raw)
    return SP.build_spine(
        twice, ["sa2_code", "sa3_code", "sa4_code"], ["sa2_name", "sa3_name"], {"sa2_code": ["sa2 code", "sa2main"]}
    )


@check(
    "pip2_enrich_spine",
    f"""WITH {SQL_BRIDGE}, s AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY ratio DESC, l_suppkey) AS rn
 FROM bridge), p AS (SELECT l_orderkey, min(l_partkey) AS part FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
 SELECT o_orderkey, coalesce(l_suppkey, -1) AS supplier_code, l_suppkey IS NOT NULL AS source_supplier_present_flag,
 coalesce(part, -1) AS part_code, part IS NOT NULL AS source_part_present_flag FROM orders LEFT JOIN (SELECT * FROM s WHERE
 rn = 1) b ON b.l_orderkey = o_orderkey LEFT JOIN p ON p.l_orderkey = o_orderkey""",
)
def enrich_spine(spark, sf):
    spine = table(spark, sf, "orders").select("o_orderkey")
    suppliers = order_bridge(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    parts = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey"
    )
    out = SP.enrich_spine(
        spine, "o_orderkey", {"supplier": (suppliers, "l_suppkey", "ratio"), "part": (parts, "l_partkey", None)}
    )
    return out.select(
        "o_orderkey", F.coalesce("supplier_code", F.lit(-1)).alias("supplier_code"), "source_supplier_present_flag",
        F.coalesce("part_code", F.lit(-1)).alias("part_code"), "source_part_present_flag",
    )


@check(
    "pip3_build_bridge",
    f"""WITH {SQL_BRIDGE} SELECT CAST(l_orderkey AS VARCHAR) AS from_code, CAST(l_suppkey AS VARCHAR) AS to_code,
 round(ratio, 6) AS ratio_from_to, 'official' AS bridge_type, count(*) OVER (PARTITION BY l_orderkey) > 1 AS
 allocation_required FROM bridge""",
)
def build_bridge(spark, sf):
    published = order_bridge(spark, sf).select(
        F.col("l_orderkey").cast("string").alias("MAIN_2016"), F.col("l_suppkey").cast("string").alias("MAIN_2021"),
        F.col("ratio").cast("string").alias("RATIO"),
    )
    out = PB.build_bridge(
        published, {"MAIN_2016": "from_code", "MAIN_2021": "to_code", "RATIO": "ratio_from_to"},
        "from_code", "to_code", "ratio_from_to", {"bridge_type": "official"},
        {"rows": (F.count("*"), 1, 1e15), "targets": (F.count_distinct("to_code"), 1, 1e12)},
    )
    return out.withColumn("ratio_from_to", r("ratio_from_to", 6))


_SQL_AREA = """f AS (SELECT l_partkey, l_suppkey, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1, 2), u AS (SELECT
 s_nationkey AS a, p_brand AS b, sum(v) AS v, count(*) AS n FROM f JOIN supplier ON s_suppkey = l_suppkey JOIN part ON
 p_partkey = l_partkey GROUP BY 1, 2), s AS (SELECT *, v / sum(v) OVER (PARTITION BY a) AS share, row_number() OVER (PARTITION BY
 a ORDER BY v DESC, b) AS rn FROM u)"""

_UNIT = ["l_partkey", "l_suppkey"]


def _units(spark, sf):
    """Fine units: parts of a supplier, with their sales as the area."""
    lines = table(spark, sf, "lineitem")
    to_a = lines.groupBy(*_UNIT).agg(F.sum("l_extendedprice").alias("v")).join(
        table(spark, sf, "supplier"), F.col("s_suppkey") == F.col("l_suppkey")
    ).select(*_UNIT, F.col("s_nationkey").alias("a"), "v")
    to_b = lines.select(*_UNIT).distinct().join(
        table(spark, sf, "part"), F.col("p_partkey") == F.col("l_partkey")
    ).select(*_UNIT, F.col("p_brand").alias("b"))
    return to_a, to_b


@check("pip4_build_area_bridge", f"WITH {_SQL_AREA} SELECT a, b, round(v, 2) AS v, n AS unit_count, round(share, 6) AS share,"
       " rn = 1 AS dominant FROM s")
def build_area_bridge(spark, sf):
    to_a, to_b = _units(spark, sf)
    full, best = PB.build_area_bridge(to_a, to_b, _UNIT, "a", "b", "v")
    marked = full.join(best.select("a", "b", F.lit(True).alias("dominant")), ["a", "b"], "left")
    return marked.select(
        "a", "b", r("v", 2).alias("v"), "unit_count", r("share", 6).alias("share"),
        F.coalesce("dominant", F.lit(False)).alias("dominant"),
    )


@check(
    "pip5_build_ratio_bridge",
    f"""WITH {SQL_BRIDGE} SELECT k, CAST(l_suppkey AS VARCHAR) AS code, round(ratio, 6) AS ratio, multi AS multi_region FROM (SELECT
 '1' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS k, *, count(*) OVER (PARTITION BY l_orderkey) > 1 AS multi, row_number()
 OVER (PARTITION BY l_orderkey ORDER BY ratio DESC, CAST(l_suppkey AS VARCHAR)) AS rn FROM bridge) WHERE rn = 1""",
)
def build_ratio_bridge(spark, sf):
    published = order_bridge(spark, sf, stored=True).select(
        _area("l_orderkey").alias("k"), F.col("l_suppkey").alias("code"), (F.col("ratio") * 100).alias("pct")
    )
    _, best = PB.build_ratio_bridge(published, "k", "code", "pct")
    return best.select("k", "code", r("ratio", 6).alias("ratio"), "multi_region")


@check(
    "pip6_dominant_category",
    """WITH u AS (SELECT l_partkey AS a, o_orderpriority AS c, sum(l_quantity) AS w, count(*) AS n FROM lineitem JOIN orders ON
 o_orderkey = l_orderkey GROUP BY 1, 2), s AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY w DESC, n DESC, c) AS rn,
 w / sum(w) OVER (PARTITION BY a) AS share FROM u) SELECT p_partkey AS a, coalesce(c, '') AS c, round(coalesce(share, 0), 6) AS
 share, coalesce(CAST(c[1:1] AS INTEGER), 0) AS c_ordinal, c IS NOT NULL AS category_present FROM part LEFT JOIN (SELECT * FROM s
 WHERE rn = 1) ON a = p_partkey""",
)
def dominant_category(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("unit"), F.col("l_partkey").alias("a"), F.col("l_quantity").alias("w")
    )
    priorities = table(spark, sf, "orders").select(F.col("o_orderkey").alias("unit"), F.col("o_orderpriority").alias("c"))
    ordinals = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}
    spine = table(spark, sf, "part").select(F.col("p_partkey").alias("a"))
    out = PB.dominant_category(lines, priorities, "unit", "a", "c", "w", spine, ordinals)
    return out.select(
        "a", F.coalesce("c", F.lit("")).alias("c"), r(F.coalesce("share", F.lit(0.0)), 6).alias("share"),
        F.coalesce("c_ordinal", F.lit(0)).alias("c_ordinal"), "category_present",
    )


_SQL_REALLOCATED = f"""{SQL_BRIDGE}, src AS (SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS d, {SQL_NUMBER} AS x
 FROM orders), sel AS (SELECT d FROM src WHERE d BETWEEN DATE '1998-01-01' AND DATE '1999-06-30' GROUP BY d
 ORDER BY abs(d - DATE '1998-12-31'), d DESC LIMIT 1), v AS (SELECT o_orderkey AS l_orderkey, x FROM src WHERE d =
 (SELECT d FROM sel)), a AS (SELECT l_suppkey, sum(x * ratio) AS x, count(DISTINCT l_orderkey) AS codes, count(*) AS edges
 FROM bridge JOIN v USING (l_orderkey) GROUP BY 1)"""


def _reallocation(spark, sf):
    source = printed(spark, sf).select(
        "o_orderkey", "o_orderpriority", F.last_day(F.col("o_orderdate").cast("date")).alias("d"),
        FN.parse_measure("figure").alias("x"),
    )
    spine = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return PR.reallocate_counts(
        source, order_bridge(spark, sf), spine, code="o_orderkey", name="o_orderpriority", value="x", period="d",
        order=F.col("o_orderkey"), from_col="l_orderkey", to_col="l_suppkey", ratio="ratio", prefix="poc", **_WINDOW,
    )


@check(
    "pip7_reallocate_counts",
    f"""WITH {_SQL_REALLOCATED} SELECT s_suppkey AS l_suppkey, s_name, round(coalesce(x, -1), 1) AS poc_x, coalesce(codes, 0) AS
 poc_contributing_codes, coalesce(edges, 0) AS poc_contributing_edges, codes IS NOT NULL AS source_poc_present_flag
 FROM supplier LEFT JOIN a ON a.l_suppkey = s_suppkey""",
)
def reallocate_counts(spark, sf):
    master = _reallocation(spark, sf).master
    return master.select(
        "l_suppkey", "s_name", r(F.coalesce("poc_x", F.lit(-1.0)), 1).alias("poc_x"),
        *[F.coalesce(f"poc_contributing_{c}", F.lit(0)).alias(f"poc_contributing_{c}") for c in ("codes", "edges")],
        "source_poc_present_flag",
    )


@check(
    "pip7_control_totals",
    f"""WITH {_SQL_REALLOCATED} SELECT (SELECT count(*) FROM v) AS source_codes, (SELECT count(*) FROM a) AS target_codes, (SELECT
 count(*) FROM v ANTI JOIN bridge USING (l_orderkey)) AS unmatched_codes, round((SELECT sum(x) FROM v), 0) AS source_total,
 round((SELECT sum(x) FROM a), 0) AS allocated_total, CASE WHEN (SELECT sum(x) FROM a) * 100.0 / (SELECT sum(x) FROM v) >= 98
 THEN 'pass' ELSE 'review' END AS status""",
)
def control_totals(spark, sf):
    audit = _reallocation(spark, sf).audit
    return audit.select(
        "source_codes", "target_codes", "unmatched_codes", r("source_total", 0).alias("source_total"),
        r("allocated_total", 0).alias("allocated_total"), "status",
    )


@check(
    "pip8_allocate_wide",
    f"""WITH {SQL_BRIDGE}, b AS (SELECT '1' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS code9, * FROM bridge), amb AS (SELECT
 '1' || right(code9, 4) AS code5, min(code9) AS lo FROM b GROUP BY 1 HAVING min(code9) = max(code9)),
 w AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN '1' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') ELSE '1' ||
 right(lpad(CAST(o_orderkey AS VARCHAR), 8, '0'), 4) END AS code, sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN
 o_totalprice END) AS age_pension, sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice END) AS jobseeker FROM orders
 GROUP BY 1), j AS (SELECT w.*, l_suppkey, ratio, 'e' AS how FROM w JOIN b ON code9 = code UNION ALL SELECT w.*, l_suppkey,
 ratio, 'd' FROM w ANTI JOIN b ON code9 = code JOIN amb ON code5 = right(code, 5) JOIN b ON code9 = lo)
 SELECT l_suppkey, coalesce(round(sum(age_pension * ratio), 1), -1) AS age_pension, coalesce(round(sum(jobseeker * ratio), 1), -1) AS
 jobseeker, count(*) FILTER (how = 'e') AS exact_edges, count(*) FILTER (how = 'd') AS derived_edges FROM j GROUP BY 1""",
)
def allocate_wide(spark, sf):
    from arealoom.functions import vocab

    code = F.when(F.col("o_orderkey") % 2 == 0, _area("o_orderkey")).otherwise(FN.short_code(_area("o_orderkey")))
    kinds = {"Age Pension (single)": "1-URGENT", "age pension, couple": "2-HIGH", "JobSeeker": "3-MEDIUM", "Other": "5-LOW"}
    wide = table(spark, sf, "orders").select(
        code.alias("code"),
        *[F.when(F.col("o_orderpriority") == p, F.col("o_totalprice")).cast("string").alias(n) for n, p in kinds.items()],
    )
    concepts = PR.wide_to_concepts(wide, "code", vocab.PAYMENT_CONCEPTS)
    bridge = order_bridge(spark, sf, stored=True).withColumn("code9", _area("l_orderkey"))
    out = PR.allocate_wide(
        concepts, bridge, key="code", derived_key=F.right("code", F.lit(5)), from_col="code9",
        bridge_derived=FN.short_code("code9"), to_col="l_suppkey", ratio="ratio", measures=["age_pension", "jobseeker"],
    )
    return out.withColumns({m: F.coalesce(r(m, 1), F.lit(-1.0)) for m in ("age_pension", "jobseeker")})


def _masters(spark, sf):
    spine = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("seifa_orders"), r(F.max("o_totalprice"), 2).alias("remoteness_max")
    )
    rich = table(spark, sf, "customer").filter("c_acctbal > 5000").select("c_custkey", F.col("c_acctbal").alias("wealth"))
    return PM.assemble_master(spine, "c_custkey", {"orders": per, "wealth": rich})


@check(
    "pip9_assemble_master",
    """SELECT c_custkey, c_nationkey, coalesce(n, 0) AS seifa_orders, coalesce(m, -1) AS remoteness_max, n IS NOT NULL AS
 source_orders_present_flag, CASE WHEN c_acctbal > 5000 THEN c_acctbal ELSE -1 END AS wealth, c_acctbal > 5000 AS
 source_wealth_present_flag FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS m FROM orders GROUP BY 1)
 ON o_custkey = c_custkey""",
)
def assemble_master(spark, sf):
    return _masters(spark, sf).na.fill({"seifa_orders": 0, "remoteness_max": -1.0, "wealth": -1.0})


@check(
    "pip9_master_dictionary",
    """SELECT unnest(['seifa_orders', 'source_orders_present_flag', 'wealth']) AS column_name, unnest([
 'candidate_predictor_or_missingness_context', 'source_presence_audit', 'manual_review_required']) AS field_role, unnest([
 count(*) FILTER (c_custkey NOT IN (SELECT o_custkey FROM orders)), 0, count(*) FILTER (c_acctbal <= 5000)]) AS missing_count
 FROM customer""",
)
def master_dictionary(spark, sf):
    out = PM.master_dictionary(_masters(spark, sf)).select("column_name", "field_role", "missing_count")
    return out.filter(F.col("column_name").isin("seifa_orders", "source_orders_present_flag", "wealth"))


@check(
    "pip10_derive_features",
    f"""SELECT o_orderkey, coalesce({SQL_NUMBER}, -1) AS rent, o_totalprice AS mortgage, CAST({SQL_NUMBER} IS NOT NULL AS INTEGER) + 1
 AS features_present_count, {SQL_NUMBER} IS NOT NULL AS features_complete FROM orders""",
)
def derive_features(spark, sf):
    master = printed(spark, sf).select(
        "o_orderkey", F.col("figure").alias("census_qs_housing_rent_median_rent_count"),
        F.lit("9").alias("census_qs_housing_rent_median_rent_not_stated_count"),
        F.col("o_totalprice").cast("string").alias("census_qs_dwellings_mortgage_count"),
    )
    rules = {
        "rent": [(MUST, "housing"), (MUST, "median_rent"), (MUST, "count$")],
        "mortgage": [(MUST, "mortgage"), (MUST, "dwellings|housing"), (NEVER, "rent")],
    }
    features, _ = PM.derive_features(master, ["o_orderkey"], rules)
    return features.select(
        "o_orderkey", F.coalesce("rent", F.lit(-1.0)).alias("rent"), "mortgage", "features_present_count", "features_complete"
    )


@check(
    "pip11_activity_context",
    """WITH w AS (SELECT user_id, min_by(CASE WHEN event_id % 6 = 0 THEN 'n.p.' ELSE CAST(value AS VARCHAR) END, event_id) FILTER
 (event_type = 'click') AS c, min_by(CASE WHEN event_id % 6 = 0 THEN 'n.p.' ELSE CAST(value AS VARCHAR) END, event_id) FILTER
 (event_type = 'purchase') AS p FROM events GROUP BY 1) SELECT c_custkey, coalesce(TRY_CAST(c AS DOUBLE), -1) AS clicks,
 coalesce(CASE WHEN c = 'n.p.' THEN 'not_published' WHEN c IS NOT NULL THEN 'published_numeric' END, '') AS
 clicks_publication_status, coalesce(TRY_CAST(p AS DOUBLE), -1) AS purchases, user_id IS NOT NULL AS has_activity_extract
 FROM customer LEFT JOIN w ON user_id = c_custkey // 4""",
)
def activity_context(spark, sf):
    raw = F.when(F.col("event_id") % 6 == 0, "n.p.").otherwise(F.col("value").cast("string"))
    long = table(spark, sf, "events").select("user_id", "event_id", "event_type", raw.alias("raw"))
    master = table(spark, sf, "customer").select("c_custkey", F.floor(F.col("c_custkey") / 4).alias("user_id"))
    specs = {"clicks": {"event_type": "click"}, "purchases": {"event_type": "purchase"}}
    out = PM.activity_context(long, "user_id", specs, "raw", F.col("event_id"), master)
    return out.select(
        "c_custkey", F.coalesce("clicks", F.lit(-1.0)).alias("clicks"),
        F.coalesce("clicks_publication_status", F.lit("")).alias("clicks_publication_status"),
        F.coalesce("purchases", F.lit(-1.0)).alias("purchases"), "has_activity_extract",
    )


@check(
    "pip12_extract_indicators",
    """SELECT CAST(c_custkey AS VARCHAR) AS join_key, c_acctbal AS customers__balance, coalesce(min_by(o_totalprice, o_orderkey), -1)
 AS sales__total FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def extract_indicators(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("row_no"), F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("region"),
        F.col("c_acctbal").cast("string").alias("balance"), "c_mktsegment",
    )
    sales = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_no"), F.col("o_custkey").alias("district"), F.col("o_totalprice").alias("total"),
        "o_orderstatus",
    )
    other = table(spark, sf, "part").select(F.col("p_partkey").alias("row_no"), "p_brand", "p_retailprice")
    targets = {"customer": table(spark, sf, "customer").select("c_custkey")}
    wide, _ = PS.extract_indicators({"customers": customers, "sales": sales, "other": other}, targets, "customer", "row_no")
    return wide.select("join_key", "customers__balance", F.coalesce("sales__total", F.lit(-1.0)).alias("sales__total"))


@check(
    "pip13_stage_native",
    """SELECT 'spine' AS family, 'sa2' AS native_geography, 'staged' AS status, count(*) AS rows, 2 AS columns_max FROM customer
 UNION ALL SELECT 'profiles', 'sa3', 'staged', count(*), 2 FROM customer UNION ALL SELECT 'profiles', 'sa2', 'staged', count(*), 2
 FROM customer UNION ALL SELECT 'other', 'unknown', 'staged', count(*), 2 FROM events""",
)
def stage_native(spark, sf):
    out = scratch_path(spark, "stage")
    customers = table(spark, sf, "customer")
    spine = customers.select(_area("c_custkey").alias("SA2_CODE_2021"), "c_name")
    spine.write.option("header", True).csv(f"{out}/raw/spine")
    customers.select(
        F.lpad((F.col("c_nationkey") + 10000).cast("string"), 5, "0").alias("region"), "c_acctbal"
    ).write.option("header", True).csv(f"{out}/raw/profiles")
    # the same header with codes of another level, in Windows-1252 and with another delimiter
    customers.select(_area("c_custkey").alias("region"), F.concat("c_name", F.lit(" \x96 é")).alias("c_acctbal")).write.option(
        "header", True
    ).option("encoding", "ISO-8859-1").option("sep", ";").csv(f"{out}/raw/profiles/fine")
    table(spark, sf, "events").select("event_type", "value").write.option("header", True).csv(f"{out}/raw/other")
    table(spark, sf, "nation").select("n_name").write.text(f"{out}/raw/readme")
    families = [("spine", "/raw/spine/"), ("profiles", "/raw/profiles/"), ("other", "/raw/other/")]
    audit = ST.stage_native(spark, f"{out}/raw", f"{out}/native", families)
    return ST.staging_summary(audit.filter("rows > 0")).drop("tables")


@check(
    "pip14_select_sources",
    """WITH f AS (SELECT doc_id, source, n_chars, CASE CAST(doc_id % 4 AS INTEGER) WHEN 0 THEN 'joinable_now_sa2' WHEN 1 THEN
 'joinable_now_sa3' WHEN 2 THEN 'context_only_unbridged' ELSE 'manual_review' END AS ready, CASE WHEN doc_id % 3 < 2 THEN
 last_day(DATE '2020-01-01' + CAST(doc_id % 40 AS INTEGER) * INTERVAL 1 MONTH) END AS d FROM documents), s AS (SELECT *,
 row_number() OVER (PARTITION BY source, doc_id % 4 < 2 ORDER BY d NULLS LAST, ready, 'table_' || doc_id, n_chars, doc_id) AS rn FROM f)
 SELECT doc_id, ready AS join_readiness, coalesce(CAST(CAST(d AS DATE) AS VARCHAR), '') AS period_min, CASE WHEN d IS NOT NULL THEN
 'filename_or_link_text' ELSE 'not_detected' END AS period_basis, CASE WHEN doc_id % 4 < 2 AND rn = 1 THEN 'selected' ELSE
 'not_selected' END AS selection_status FROM s""",
)
def select_sources(spark, sf):
    key = F.col("doc_id")
    words = F.array(*[F.lit(w) for w in ("by sa2", "by sa3", "by lga", "other")])
    month = F.add_months(F.lit("2020-01-01").cast("date"), (key % 40).cast("int"))
    label = F.when(key % 3 < 2, F.date_format(month, "MMMM yyyy")).otherwise("undated")
    inv = table(spark, sf, "documents").select(
        "doc_id", "n_chars", F.concat(F.lit("table_"), key.cast("string")).alias("file_name"),
        F.concat_ws(" ", "source", F.element_at(words, (key % 4 + 1).cast("int")), label).alias("link_text"),
        F.lit("").alias("columns"),
    )
    families = [(f"src{i}", rf"^src{i}\b") for i in range(20)]
    described = PS.describe_sources(inv, "link_text", "columns", families)
    out = PS.select_sources(described, "doc_id", "file_name", "n_chars")
    return out.select(
        "doc_id", "join_readiness", F.coalesce(iso("period_min"), F.lit("")).alias("period_min"), "period_basis",
        "selection_status",
    )


@check(
    "pip15_validate_candidates",
    """WITH c AS (SELECT p_partkey, p_brand, p_name, CASE WHEN contains(p_name, 'ring') THEN 4 ELSE 0 END + CASE WHEN contains(p_name,
 'red') THEN 2 ELSE 0 END AS priority FROM part), k AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY contains(p_name,
 'contents'), priority DESC, p_partkey) AS rn FROM c), m AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS u,
 count(DISTINCT CASE WHEN s_nationkey < 13 THEN l_suppkey END) AS h FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1)
 SELECT p_partkey, priority, coalesce(round(h / u, 6), 0) AS match_rate, CASE WHEN h / u >= 0.95 THEN 'safe_' || p_brand WHEN h > 0
 THEN 'review_key_match_before_join' ELSE 'hold_context_only_no_validated_key_match' END AS recommended_action FROM k LEFT JOIN m
 ON l_partkey = p_partkey WHERE rn <= 8""",
)
def validate_candidates(spark, sf):
    values = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
    keys = table(spark, sf, "supplier").filter("s_nationkey < 13").select("s_suppkey")
    out = PS.validate_candidates(
        table(spark, sf, "part"), "p_brand", "p_name", [("ring", 4), ("red", 2)], "p_partkey", values, keys
    )
    return out.select("p_partkey", "priority", r("match_rate", 6).alias("match_rate"), "recommended_action")


@check(
    "pip16_checkpoint_without",
    """SELECT c_custkey, c_mktsegment, false AS source_housing_present_flag, 'manual_source_required' AS source_housing_status
 FROM customer""",
)
def checkpoint_without(spark, sf):
    master = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return PM.checkpoint_without(master, "housing", "manual_source_required")
