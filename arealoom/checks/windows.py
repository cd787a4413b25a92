"""Windows, ordering and filters (WIN, ORD, FLT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealoom import functions as FN
from arealoom.checks.registry import SQL_BRIDGE, SQL_INVENTORY, check, inventory, iso, order_bridge, r, table
from arealoom.operators import bridges as B
from arealoom.operators import filters as FL
from arealoom.operators import period as P
from arealoom.operators import windows as W


@check(
    "win1_dominant",
    f"""WITH {SQL_BRIDGE} SELECT l_orderkey, l_suppkey, round(ratio, 6) AS ratio, multi_region,
 'dominant_by_weight' AS assignment_method FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
 ORDER BY ratio DESC, l_suppkey) AS rn, count(*) OVER (PARTITION BY l_orderkey) > 1 AS multi_region FROM bridge) WHERE rn = 1""",
)
def dominant(spark, sf):
    best = B.dominant(order_bridge(spark, sf), "l_orderkey", "l_suppkey", "ratio")
    return best.withColumn("ratio", r("ratio", 6))


@check(
    "win2_flag_split",
    """SELECT l_orderkey, l_suppkey, count(*) OVER (PARTITION BY l_orderkey) > 1 AS allocation_required
 FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)""",
)
def flag_split(spark, sf):
    edges = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    return B.flag_split(edges, "l_orderkey", "l_suppkey")


@check(
    "win3_dedupe_first",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY
 l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedupe_first(spark, sf):
    order = [F.col("l_shipdate").asc(), F.col("l_partkey").asc(), F.col("l_suppkey").asc()]
    out = W.dedupe_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@check(
    "win4_select_best",
    """SELECT doc_id, CASE WHEN ok AND rn = 1 THEN 'selected' ELSE 'not_selected' END AS selection_status FROM (SELECT doc_id,
 lang <> 'de' AS ok, row_number() OVER (PARTITION BY source, lang <> 'de' ORDER BY q NULLS LAST, n_chars DESC, doc_id) AS rn
 FROM documents LEFT JOIN (SELECT doc_id, quality AS q FROM labels) USING (doc_id))""",
)
def select_best(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("q"))
    docs = table(spark, sf, "documents").drop("text").join(labels, "doc_id", "left")
    order = [F.col("q").asc_nulls_last(), F.desc("n_chars"), F.asc("doc_id")]
    out = W.select_best(docs, "source", order, "doc_id", F.col("lang") != "de")
    return out.select("doc_id", "selection_status")


@check(
    "win5_best_candidate",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
 ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def best_candidate(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return W.best_candidate(orders, "o_custkey", "o_totalprice", "o_orderkey")


_WINDOW = dict(target="1998-12-15", start="1998-01-01", end="1999-06-30")


@check(
    "win6_select_period",
    """WITH m AS (SELECT *, last_day(CAST(o_orderdate AS DATE)) AS d FROM orders),
 best AS (SELECT d FROM m WHERE d BETWEEN DATE '1998-01-01' AND DATE '1999-06-30'
 ORDER BY abs(d - DATE '1998-12-15'), d DESC LIMIT 1)
 SELECT o_orderkey, CAST(d AS VARCHAR) AS period FROM m WHERE d = (SELECT d FROM best)""",
)
def select_period(spark, sf):
    months = table(spark, sf, "orders").select(
        "o_orderkey", F.last_day(F.col("o_orderdate").cast("date")).alias("d")
    )
    return P.select_period(months, "d", policy="target_window", **_WINDOW).select("o_orderkey", iso("d").alias("period"))


@check(
    "win6_choose_period",
    """WITH m AS (SELECT DISTINCT last_day(CAST(o_orderdate AS DATE)) AS d FROM orders),
 c AS (SELECT 'target_window' AS policy, (SELECT d FROM m WHERE d BETWEEN DATE '1998-01-01' AND DATE '1999-06-30' ORDER BY
 abs(d - DATE '1998-12-15'), d DESC LIMIT 1) AS d, 'closest_to_target_inside_window' AS alignment_basis UNION ALL
 SELECT 'latest_within_window', (SELECT max(d) FROM m WHERE d BETWEEN DATE '1998-01-01' AND DATE '1999-06-30'),
 'latest_available_inside_target_window' UNION ALL SELECT 'closest_to_target_any', (SELECT d FROM m ORDER BY
 abs(d - DATE '1998-12-15'), d DESC LIMIT 1), 'closest_to_target_any' UNION ALL SELECT 'earliest', (SELECT min(d) FROM m),
 'earliest_available' UNION ALL SELECT 'latest', (SELECT max(d) FROM m), 'latest_available')
 SELECT policy, CAST(d AS VARCHAR) AS selected_period, alignment_basis, d BETWEEN DATE '1998-01-01' AND DATE '1999-06-30'
 AS in_target_window, CAST(d - DATE '1998-12-15' AS INTEGER) AS days_from_target FROM c""",
)
def choose_period(spark, sf):
    months = table(spark, sf, "orders").select(
        F.last_day(F.col("o_orderdate").cast("date")).alias("d")
    )
    rows = [
        P.choose_period(months, "d", policy, **_WINDOW).select(F.lit(policy).alias("policy"), "*") for policy in P.POLICIES
    ]
    return W.union_all(rows).withColumn("selected_period", iso("selected_period"))


@check(
    "win7_ffill",
    """SELECT user_id, event_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS v FROM (SELECT user_id, event_id,
 CASE WHEN event_id % 4 = 0 THEN event_type || event_id END AS v FROM events)""",
)
def ffill(spark, sf):
    label = F.concat("event_type", F.col("event_id").cast("string"))
    events = table(spark, sf, "events").select(
        "user_id", "event_id", F.when(F.col("event_id") % 4 == 0, label).alias("v")
    )
    return W.ffill(events, "user_id", "event_id", ["v"], block=512).na.fill("")


@check(
    "win8_carry_context",
    """WITH t AS (SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN 'h2' WHEN 'purchase' THEN 'h3' ELSE 'p' END
 AS tag, 't' || event_id AS txt FROM events), s AS (SELECT *, count(*) FILTER (tag = 'h2') OVER (PARTITION BY user_id
 ORDER BY event_id) AS section FROM t) SELECT user_id, event_id, coalesce(last_value(CASE WHEN tag = 'h2' THEN txt END
 IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS h2,
 coalesce(last_value(CASE WHEN tag = 'h3' THEN txt END IGNORE NULLS) OVER (PARTITION BY user_id, section ORDER BY event_id
 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS h3 FROM s""",
)
def carry_context(spark, sf):
    tokens = table(spark, sf, "events").select(
        "user_id", "event_id", FN.map_values("event_type", {"signup": "h2", "purchase": "h3"}, "p").alias("tag"),
        F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("txt"),
    )
    out = W.carry_context(tokens, "user_id", "event_id", "tag", "txt", ("h2", "h3"))
    return out.select("user_id", "event_id", "h2", "h3")


@check(
    "win9_top_n",
    """SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY lang = 'fr', n_chars DESC, doc_id)
 AS rn FROM documents) WHERE rn <= 5""",
)
def top_n(spark, sf):
    docs = table(spark, sf, "documents").drop("text")
    out = W.top_n_demoted(docs, "source", F.col("lang") == "fr", [F.desc("n_chars"), F.asc("doc_id")], 5)
    return out.select("source", "doc_id")


@check(
    "win10_diverse_top_n",
    """WITH f AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) = 1 AS first_one
 FROM documents) SELECT doc_id, first_one AS group_first FROM f ORDER BY first_one DESC, n_chars DESC, doc_id LIMIT 120""",
)
def diverse_top_n(spark, sf):
    docs = table(spark, sf, "documents").drop("text")
    out = W.diverse_top_n(docs, ["source", "lang"], [F.desc("n_chars"), F.asc("doc_id")], 120, "doc_id")
    return out.select("doc_id", "group_first")


@check(
    "win11_latest_per_group",
    """SELECT o_orderkey, grp AS name_group, CASE WHEN grp = '' THEN 'not_grouped' WHEN rn = 1 THEN 'keep_latest'
 ELSE 'archive_older' END AS retention FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY o_orderdate DESC,
 o_orderkey DESC) AS rn FROM (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE 'note_' || o_custkey END AS grp FROM orders))""",
)
def latest_per_group(spark, sf):
    name = F.when(F.col("o_orderkey") % 10 == 0, "loose.md").otherwise(
        F.concat(F.lit("note_"), F.col("o_custkey").cast("string"), F.lit("_2026.md"))
    )
    notes = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", name.alias("file_name"))
    out = W.latest_per_group(notes, "file_name", r"^(note_\d+)_\d+\.md$", "o_orderdate", "o_orderkey")
    return out.select("o_orderkey", "name_group", "retention")


@check(
    "win12_duplicate_groups",
    f"""WITH {SQL_INVENTORY}, s AS (SELECT *, count(*) OVER (PARTITION BY sha256) AS group_size, row_number() OVER (PARTITION BY
 sha256 ORDER BY CASE WHEN contains(path, 'archive') OR contains(path, 'capture') THEN 100 ELSE 0 END, length(path),
 lower(path)) AS rn FROM files) SELECT doc_id, group_size, dense_rank() OVER (ORDER BY sha256) AS duplicate_group_id,
 CASE WHEN rn = 1 THEN 'keep_active_copy' ELSE 'archive_duplicate_copy' END AS suggested_action FROM s WHERE group_size > 1""",
)
def duplicate_groups(spark, sf):
    files = inventory(spark, sf).select("doc_id", "path", "sha256")
    penalty = F.when(F.col("path").rlike("archive|capture"), 100).otherwise(0)
    out = W.duplicate_groups(files, "sha256", "path", penalty)
    return out.select("doc_id", "group_size", "duplicate_group_id", "suggested_action")


@check(
    "ord1_sort_nulls_last",
    """SELECT o_orderkey, row_number() OVER (ORDER BY p NULLS LAST, o_totalprice DESC NULLS LAST,
 o_orderkey) AS place FROM (SELECT *, nullif(o_orderpriority, '1-URGENT') AS p FROM orders)""",
)
def sort_nulls_last(spark, sf):
    rows = table(spark, sf, "orders").withColumn("p", F.nullif("o_orderpriority", F.lit("1-URGENT")))
    rows = rows.select("o_orderkey", "p", "o_totalprice")
    return W.numbered_sort(rows, "p", "-o_totalprice", "o_orderkey").select("place", "o_orderkey")


@check("ord2_head", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY l_extendedprice DESC,"
       " l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 500")
def head(spark, sf):
    lines = table(spark, sf, "lineitem")
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return W.head(lines, 500, [F.desc("l_extendedprice"), *[F.asc(c) for c in ids]]).select(*ids)


@check("flt1_filter_code", "SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN 100 AND 9999")
def filter_code(spark, sf):
    codes = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("code"))
    return FL.filter_code(codes, "code", "3,4").select("o_orderkey")


@check("flt2_exclude_pattern", "SELECT p_partkey FROM part WHERE NOT regexp_matches(p_name, 'ring|^old ')")
def exclude_pattern(spark, sf):
    return FL.exclude_pattern(table(spark, sf, "part"), "p_name", "ring|^old ").select("p_partkey")


@check(
    "flt3_filter_spec",
    """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND (o_orderkey % 3 = 0 OR o_orderkey % 5 = 0)""",
)
def filter_spec(spark, sf):
    key = F.col("o_orderkey")
    practitioner = F.when(key % 3 == 0, " ").when(key % 5 != 0, "GP")
    rows = table(spark, sf, "orders").withColumn("practitioner", practitioner)
    return FL.filter_spec(rows, {"o_orderstatus": "F", "practitioner": ""}).select("o_orderkey")


@check(
    "flt4_filter_year_level",
    """SELECT o_orderkey, 'a' AS kind FROM orders WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'F' UNION ALL
 SELECT o_orderkey, 'b' FROM orders WHERE o_orderstatus = 'O'""",
)
def filter_year_level(spark, sf):
    level = F.when(F.col("o_orderstatus") == "F", "Statistical Area Level 2").when(F.col("o_orderstatus") == "O", "SA3")
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.year("o_orderdate").cast("string"), F.lit(" census")).alias("year"),
        F.coalesce(level, F.lit("State")).alias("level"),
    )
    a = FL.filter_year_level(rows, "year", 1997, "level", r"\bsa2\b|area level 2")
    b = FL.filter_year_level(rows, "year", 2021, "level", r"\bsa3\b")
    return a.select("o_orderkey", F.lit("a").alias("kind")).unionByName(b.select("o_orderkey", F.lit("b").alias("kind")))


@check(
    "flt5_apply_hold_rules",
    f"""WITH {SQL_INVENTORY} SELECT doc_id, CASE WHEN file_extension = '.pdf' THEN 'held_report_context' WHEN file_extension =
 '.html' THEN 'held_source_page_snapshot' WHEN file_extension NOT IN ('.csv', '.xlsx', '.xls', '.zip') THEN
 'held_unsupported_extension' WHEN family = 'src3' THEN 'held_raw_foundation_source' ELSE 'process' END AS stage_status FROM files""",
)
def apply_hold_rules(spark, sf):
    from arealoom.operators.inventory import apply_hold_rules as held

    return held(inventory(spark, sf), foundation=["src3"]).select("doc_id", "stage_status")


@check(
    "flt6_rows_containing",
    """SELECT doc_id FROM documents WHERE regexp_matches(lower(text), 'pathetic|license')
 OR regexp_matches(lower(source), 'src1$')""",
)
def rows_containing(spark, sf):
    docs = table(spark, sf, "documents")
    return FL.rows_containing(docs, "pathetic|license|^src1$", columns=["text", "source"]).select("doc_id")


@check(
    "flt7_allocatable",
    f"""WITH {SQL_BRIDGE} SELECT l_orderkey, l_suppkey FROM bridge WHERE l_orderkey % 6 NOT IN (0, 1, 2) AND l_suppkey % 10 <> 0""",
)
def allocatable(spark, sf):
    key = F.col("l_orderkey")
    ratio = F.when(key % 6 == 0, 0.0).when(key % 6 == 1, float("nan")).when(key % 6 != 2, F.col("ratio"))
    edges = order_bridge(spark, sf).select(
        "l_orderkey", F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey")).alias("l_suppkey"), ratio.alias("ratio")
    )
    return B.allocatable(edges, "l_orderkey", "l_suppkey", "ratio").select("l_orderkey", "l_suppkey")


@check("flt8_filter_status", "SELECT event_id FROM events WHERE event_type = 'purchase'")
def filter_status(spark, sf):
    log = table(spark, sf, "events").withColumn("event_type", F.concat(F.lit(" "), F.upper("event_type")))
    return FL.filter_status(log, "event_type", "purchase").select("event_id")


@check(
    "flt9_filter_names",
    """SELECT p_partkey FROM part WHERE (regexp_matches(p_name, 'gear|bolt') OR p_name = 'red widget')
 AND NOT regexp_matches(p_name, 'cold|small')""",
)
def filter_names(spark, sf):
    return FL.filter_names(table(spark, sf, "part"), "p_name", "gear|bolt", ["Red Widget"], "cold|small").select("p_partkey")
