"""Scalar functions (STR, NUM, DAT, CLS on text, ARR, JSN, HSH)."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealoom import functions as A
from arealoom.checks.registry import (
    SQL_DAY, SQL_FIGURE, SQL_INVENTORY, SQL_NUMBER, SQL_PERIOD, check, inventory, iso, period_labels,
    printed, r, sql_slug, table,
)
from arealoom.functions import vocab


@check(
    "str1_norm_code",
    """SELECT o_orderkey,
 CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS compact,
 CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE regexp_replace(o_orderpriority, '[^A-Z0-9]+', '', 'g') END AS alnum,
 CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE regexp_replace(o_orderpriority, '[^0-9]+', '', 'g') END AS digits
 FROM orders""",
)
def norm_code(spark, sf):
    null = F.when(F.col("o_orderkey") % 9 == 0, " NaN ")
    code = null.otherwise(F.concat(F.lit("﻿ "), F.col("o_orderkey").cast("string"), F.lit(".0 ")))
    label = null.otherwise(F.col("o_orderpriority"))
    return table(spark, sf, "orders").select(
        "o_orderkey", A.norm_code(code).alias("compact"), A.norm_code(label, "alnum").alias("alnum"),
        A.norm_code(label, "digits").alias("digits"),
    )


@check(
    "str2_slug",
    f"""SELECT p_partkey, {sql_slug("' ' || p_name || ' & ' || p_brand || ' (x)'")} AS name_and,
 {sql_slug("p_type || ' % of $' || p_name", 24, 'symbols')} AS name_symbols,
 {sql_slug("p_brand || ' (' || p_type || ') %'", 60, 'bare')} AS name_bare FROM part""",
)
def slug(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        A.slug(F.concat(F.lit(" "), "p_name", F.lit(" & "), "p_brand", F.lit(" (x)"))).alias("name_and"),
        A.slug(F.concat("p_type", F.lit(" % of $"), "p_name"), 24, "symbols").alias("name_symbols"),
        A.slug(F.concat("p_brand", F.lit(" ("), "p_type", F.lit(") %")), 60, "bare").alias("name_bare"),
    )


@check("str3_alnum_key", "SELECT c_custkey, lower(regexp_replace(c_name, '[^A-Za-z0-9]+', '', 'g')) AS k FROM customer")
def alnum_key(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", A.alnum_key("c_name").alias("k"))


@check(
    "str4_name_key",
    """SELECT c_custkey, CASE CAST(c_custkey % 3 AS INTEGER) WHEN 0 THEN lower(c_mktsegment)
 WHEN 1 THEN lower(c_mktsegment) || ' and ' || c_nationkey ELSE lower(c_mktsegment) END AS k FROM customer""",
)
def name_key(spark, sf):
    place = (
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("City of "), "c_mktsegment", F.lit(" (C)")))
        .when(F.col("c_custkey") % 3 == 1, F.concat_ws(" ", "c_mktsegment", F.lit("&"), "c_nationkey", F.lit("PHN")))
        .otherwise(F.concat("c_mktsegment", F.lit("  Regional Council.")))
    )
    return table(spark, sf, "customer").select("c_custkey", A.name_key(place).alias("k"))


@check(
    "str5_clean_text",
    """SELECT conv_id, turn, CASE WHEN lower(t) IN ('', 'nan', 'none', 'null') THEN NULL ELSE t END AS t
 FROM (SELECT conv_id, turn, regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '^ | $', '', 'g') AS t
 FROM conversations)""",
)
def clean_text(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", A.clean_text("text").alias("t"))


@check(
    "str6_extract_code",
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'none listed'
 ELSE lpad(CAST(100 + c_custkey % 90000 AS VARCHAR), 5, '0') END AS code FROM customer""",
)
def extract_code(spark, sf):
    text = F.when(F.col("c_custkey") % 4 == 0, "none listed").otherwise(
        F.concat(F.lit("LGA "), (F.col("c_custkey") % 90000 + 100).cast("string"), F.lit(" x9"))
    )
    return table(spark, sf, "customer").select("c_custkey", A.extract_code(text, width=5).alias("code"))


@check(
    "str7_short_code",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE '1' ||
 right(lpad(CAST(o_orderkey AS VARCHAR), 8, '0'), 4) END AS code FROM orders""",
)
def short_code(spark, sf):
    full = F.concat(F.lit("1"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"))
    text = F.when(F.col("o_orderkey") % 8 == 0, "1234").otherwise(full)
    return table(spark, sf, "orders").select("o_orderkey", A.short_code(text).alias("code"))


@check(
    "str8_key_tokens",
    """SELECT c_custkey, replace(s, ' ', '') || '|' || array_to_string(list_distinct_in_order, '|') AS tokens,
 CAST(1 + len(list_distinct_in_order) AS INTEGER) AS token_count FROM (SELECT c_custkey, s,
 list_filter(regexp_extract_all(s, '\\d+'), lambda x: length(x) IN (4, 5)) AS list_distinct_in_order
 FROM (SELECT c_custkey, 'LGA ' || (10000 + c_custkey % 80000) || ' was ' || (1000 + c_custkey % 8000)
 || ' id ' || (c_custkey + 100000000) AS s FROM customer))""",
)
def key_tokens(spark, sf):
    key = F.col("c_custkey")
    text = F.concat(
        F.lit("LGA "), (key % 80000 + 10000).cast("string"), F.lit(" was "), (key % 8000 + 1000).cast("string"),
        F.lit(" id "), (key + 100000000).cast("string"),
    )
    tokens = A.key_tokens(text, "LGA")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.array_join(tokens, "|").alias("tokens"),
        F.size(tokens).alias("token_count"),
    )


@check(
    "str9_norm_year",
    "SELECT o_orderkey, year(o_orderdate) || '-' || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0')"
    " AS fy FROM orders",
)
def norm_year(spark, sf):
    year = F.year("o_orderdate")
    dash = F.when(F.col("o_orderkey") % 2 == 0, "–").otherwise("—")
    label = F.concat(F.lit(" "), year.cast("string"), dash, F.lpad(((year + 1) % 100).cast("string"), 2, "0"))
    return table(spark, sf, "orders").select("o_orderkey", A.norm_year(label).alias("fy"))


@check("str10_short_label", "SELECT c_custkey, c_mktsegment AS label FROM customer")
def short_label(spark, sf):
    suffix = F.when(F.col("c_custkey") % 2 == 0, " of Australia").otherwise(" Australia")
    return table(spark, sf, "customer").select(
        "c_custkey", A.short_label(F.concat("c_mktsegment", suffix)).alias("label")
    )


@check(
    "str11_strip_tags",
    """SELECT page_id, regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(
 regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
 '&#39;', ''''), '&apos;', ''''), '&amp;', '&'), '[\\s\\x{00A0}]+', ' ', 'g'), '^ | $', '', 'g') AS body FROM pages""",
)
def strip_tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", A.strip_tags("html").alias("body"))


@check(
    "str12_path_parts",
    f"""WITH {SQL_INVENTORY} SELECT doc_id, file_name, file_extension,
 CASE WHEN doc_id % 7 = 0 THEN '_archive' WHEN doc_id % 5 = 0 THEN 'capture' ELSE source END AS top_folder,
 substring(path, 5) AS relative_path FROM files""",
)
def path_parts(spark, sf):
    parts = A.path_parts(F.replace(F.col("path"), F.lit("/"), F.lit("\\")), root="raw")
    return inventory(spark, sf).select("doc_id", *[c.alias(n) for n, c in parts.items()])


@check(
    "str13_count_links",
    """SELECT doc_id, CAST(len(regexp_extract_all(text, '(?i)https?://[^\\s"''<>]+')) AS INTEGER) AS links,
 CAST(len(list_distinct(regexp_extract_all(text, '(?i)https?://[^\\s"''<>]+'))) AS INTEGER) AS distinct_links
 FROM documents""",
)
def count_links(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", A.count_links("text", False).alias("links"), A.count_links("text").alias("distinct_links")
    )


@check(
    "str14_column_letters",
    """SELECT p_partkey, CASE WHEN n <= 26 THEN chr(CAST(64 + n AS INTEGER))
 WHEN n <= 702 THEN chr(CAST(65 + (n - 27) // 26 AS INTEGER)) || chr(CAST(65 + (n - 27) % 26 AS INTEGER))
 ELSE chr(CAST(65 + (n - 703) // 676 AS INTEGER)) || chr(CAST(65 + ((n - 703) // 26) % 26 AS INTEGER))
 || chr(CAST(65 + (n - 703) % 26 AS INTEGER)) END AS letters
 FROM (SELECT p_partkey, p_partkey % 16384 + 1 AS n FROM part)""",
)
def column_letters(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", A.column_letters(F.col("p_partkey") % 16384 + 1).alias("letters")
    )


@check("num1_parse_measure", f"SELECT o_orderkey, {SQL_NUMBER} AS number FROM orders")
def parse_measure(spark, sf):
    return printed(spark, sf).select("o_orderkey", A.parse_measure("figure").alias("number"))


@check(
    "num2_publication_status",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'not_published'
 WHEN o_orderkey % 13 = 0 THEN 'published_non_numeric' WHEN o_orderkey % 17 = 0 THEN 'not_available'
 WHEN o_orderkey % 19 = 0 THEN 'published_numeric' WHEN o_orderkey % 23 = 0 THEN 'published_non_numeric'
 ELSE 'published_numeric' END AS status FROM orders""",
)
def publication_status(spark, sf):
    return printed(spark, sf).select("o_orderkey", A.publication_status("figure").alias("status"))


@check(
    "num4_parse_bool",
    """SELECT o_orderkey, CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 4 THEN 'missing'
 WHEN 0 THEN 'yes' WHEN 2 THEN 'yes' ELSE 'no' END AS flag FROM orders""",
)
def parse_bool(spark, sf):
    text = F.element_at(
        F.array(*[F.lit(t) for t in (" True", "false ", "1", "0", "maybe")]), (F.col("o_orderkey") % 5 + 1).cast("int")
    )
    flag = A.parse_bool(text)
    return table(spark, sf, "orders").select(
        "o_orderkey", F.when(flag, "yes").when(~flag, "no").otherwise("missing").alias("flag")
    )


@check(
    "num5_map_values",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
 WHEN '3-MEDIUM' THEN 2 ELSE 9 END AS ordinal FROM orders""",
)
def map_values(spark, sf):
    order = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}
    return table(spark, sf, "orders").select("o_orderkey", A.map_values("o_orderpriority", order, 9).alias("ordinal"))


@check(
    "num6_pct",
    """SELECT l_suppkey, round(100.0 * sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity), 3)
 AS returned_pct FROM lineitem GROUP BY l_suppkey""",
)
def pct(spark, sf):
    returned = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0))
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        A.pct(returned, F.sum("l_quantity"), 3).alias("returned_pct")
    )


@check("num7_size_mb", "SELECT doc_id, round(n_chars / 1048576.0, 6) AS size_mb FROM documents")
def size_mb(spark, sf):
    return table(spark, sf, "documents").select("doc_id", A.size_mb("n_chars").alias("size_mb"))


@check("dat1_parse_period", f"SELECT o_orderkey, CAST({SQL_PERIOD} AS VARCHAR) AS period FROM orders")
def parse_period(spark, sf):
    return period_labels(spark, sf).select("o_orderkey", iso(A.parse_period("label")).alias("period"))


@check("dat1_parsed_once", f"SELECT o_orderkey, CAST({SQL_PERIOD} AS VARCHAR) AS period FROM orders")
def parse_period_once(spark, sf):
    """The same labels, each distinct one parsed once."""
    from arealoom.operators.profiling import parsed_once

    return parsed_once(period_labels(spark, sf), "label", "day").select("o_orderkey", iso(F.col("day")).alias("period"))


@check(
    "dat2_extract_periods",
    f"""SELECT o_orderkey, CAST(least(last_day(d), last_day(CAST(d + INTERVAL 7 MONTH AS DATE)), d) AS VARCHAR)
 AS period_min, CAST(greatest(last_day(d), last_day(CAST(d + INTERVAL 7 MONTH AS DATE)), d) AS VARCHAR) AS period_max,
 CAST(CASE WHEN d = last_day(d) THEN 2 ELSE 3 END AS INTEGER) AS period_count
 FROM (SELECT o_orderkey, {SQL_DAY} AS d FROM orders)""",
)
def extract_periods(spark, sf):
    text = F.concat(
        F.lit("Extract "), F.date_format("day", "yyyyMM"), F.lit("_01, revised "), F.date_format("day", "yyyy-MM-dd"),
        F.lit("; next as at "), F.date_format(F.add_months("day", 7), "MMMM yyyy"), F.lit(", table 101021007"),
    )
    span = A.period_span(text)
    return period_labels(spark, sf).select(
        "o_orderkey", iso(span["period_min"]).alias("period_min"), iso(span["period_max"]).alias("period_max"),
        span["period_count"].alias("period_count"),
    )


@check(
    "dat3_period_from_name",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END"
    " AS period FROM orders",
)
def period_from_name(spark, sf):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    name = (
        F.when(key % 3 == 0, F.concat(F.lit("t__"), F.date_format(day, "yyyy-MM-dd"), F.lit("__v2.csv")))
        .when(key % 3 == 1, F.concat(F.lit("t_"), F.date_format(day, "yyyyMMdd"), F.lit(".csv")))
        .otherwise("table.csv")
    )
    return table(spark, sf, "orders").select("o_orderkey", iso(A.period_from_name(name)).alias("period"))


@check(
    "dat4_coalesce_period",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'content' WHEN o_orderkey % 3 = 1 THEN
 'filename_or_link_text' ELSE 'not_detected' END AS period_basis,
 CASE WHEN o_orderkey % 3 < 2 THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS VARCHAR) END
 AS period_min FROM orders""",
)
def coalesce_period(spark, sf):
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    none = F.lit(None).cast("date")
    content = F.when(key % 3 == 0, day)
    text = F.when(key % 3 == 1, F.date_add(day, 1)).when(key % 3 == 0, F.date_add(day, 9))
    out = A.coalesce_period(none, content, text, none)
    return table(spark, sf, "orders").select(
        "o_orderkey", out["period_basis"].alias("period_basis"), iso(out["period_min"]).alias("period_min")
    )


@check(
    "dat5_alignment",
    """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) > DATE '1998-06-30' THEN 'time_misaligned_context_layer'
 ELSE 'near_or_within_target_review_required' END AS alignment FROM orders""",
)
def alignment(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", A.alignment(F.col("o_orderdate").cast("date"), "1998-06-30").alias("alignment")
    )


@check(
    "cls1_classify",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'age_pension'
 WHEN o_orderpriority = '2-HIGH' THEN 'jobseeker' WHEN o_orderpriority = '3-MEDIUM' THEN
 'pensioner_concession_card' ELSE 'other' END AS concept FROM orders""",
)
def classify(spark, sf):
    words = {"1-URGENT": "Age-Pension (total)", "2-HIGH": "NewStart/JobSeeker", "3-MEDIUM": "Pension concession card"}
    text = A.map_values("o_orderpriority", words, "Carers, other")
    return table(spark, sf, "orders").select(
        "o_orderkey", A.classify(A.match_text(text), vocab.PAYMENT_CONCEPTS, "other").alias("concept")
    )


@check(
    "cls2_labels",
    """SELECT doc_id, CASE WHEN hits = '' THEN 'unknown' ELSE hits END AS labels FROM (SELECT doc_id, concat_ws(';',
 CASE WHEN regexp_matches(lower(text), '\\bthe\\b') THEN 'THE' END, CASE WHEN contains(lower(text), 'der') THEN 'DER' END,
 CASE WHEN regexp_matches(lower(text), '[0-9]{4}') THEN 'YEAR' END) AS hits FROM documents)""",
)
def labels(spark, sf):
    rules = [("THE", r"\bthe\b"), ("DER", "der"), ("YEAR", "[0-9]{4}")]
    return table(spark, sf, "documents").select("doc_id", A.labels("text", rules).alias("labels"))


@check(
    "cls5_signals",
    """SELECT o_orderkey, o_orderkey % 4 = 0 AS has_sa2_signal, o_orderkey % 4 = 1 AS has_lga_signal,
 o_orderkey % 4 = 2 AS has_payment_signal, o_orderkey % 4 = 0 AS has_participant_signal FROM orders""",
)
def signals(spark, sf):
    text = F.element_at(
        F.array(*[F.lit(t) for t in ("Participants by SA2", "Local-Government Area", "Payments", "Other sa20")]),
        (F.col("o_orderkey") % 4 + 1).cast("int"),
    )
    found = A.signals(text)
    names = ["has_sa2_signal", "has_lga_signal", "has_payment_signal", "has_participant_signal"]
    return table(spark, sf, "orders").select("o_orderkey", *[found[n].alias(n) for n in names])


@check(
    "cls6_join_readiness",
    """SELECT o_orderkey, CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 0 THEN 'joinable_now_sa2' WHEN 1 THEN
 'joinable_now_sa3' WHEN 2 THEN 'context_only_unbridged' WHEN 3 THEN 'context_only_state' ELSE 'manual_review' END
 AS join_readiness, CASE WHEN o_orderkey % 5 < 2 THEN 'eligible_for_sensitivity_layer' WHEN o_orderkey % 5 < 4 THEN
 'hold_for_descriptive_context' ELSE 'exclude_until_manual_review' END AS use_rule FROM orders""",
)
def join_readiness(spark, sf):
    text = F.element_at(
        F.array(*[F.lit(t) for t in ("sa2 and state", "statistical area 3", "phn state", "by state", "notes")]),
        (F.col("o_orderkey") % 5 + 1).cast("int"),
    )
    out = A.join_readiness(A.signals(text))
    return table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in out.items()])


@check(
    "cls11_score_terms",
    """SELECT doc_id, CASE WHEN contains(lower(text), 'the') THEN 5 ELSE 0 END
 + CASE WHEN contains(lower(text), 'tion') THEN 3 ELSE 0 END - CASE WHEN contains(lower(text), 'http') THEN 4 ELSE 0 END
 AS score FROM documents""",
)
def score_terms(spark, sf):
    weights = [("the", 5), ("tion", 3), ("http", -4)]
    return table(spark, sf, "documents").select("doc_id", A.score_terms("text", weights).alias("score"))


@check(
    "cls15_canonical_header",
    """SELECT o_orderkey, CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 0 THEN 'sa2_code_2021' WHEN 1 THEN
 'seifa_irsd_score' WHEN 2 THEN 'seifa_irsd_rank_australia' WHEN 3 THEN 'seifa_irsd_decile_state' END AS header
 FROM orders""",
)
def canonical_header(spark, sf):
    text = F.element_at(
        F.array(*[F.lit(t) for t in ("SA2 9-digit Code", "IRSD | Score", "Ranking in Australia | Rank",
                                     "Within State | Decile", "Usual population")]),
        (F.col("o_orderkey") % 5 + 1).cast("int"),
    )
    return table(spark, sf, "orders").select("o_orderkey", A.canonical_header(text, "irsd").alias("header"))


@check(
    "arr2_distinct_list",
    """SELECT p_partkey, CASE WHEN p_brand = p_type THEN p_brand ELSE p_brand || '|' || p_type END AS words FROM part""",
)
def distinct_list(spark, sf):
    words = F.array("p_brand", F.lit(None).cast("string"), "p_type", "p_brand")
    return table(spark, sf, "part").select("p_partkey", F.array_join(A.distinct_list(words), "|").alias("words"))


@check(
    "jsn1_to_json_notes",
    """SELECT n_nationkey, '{"name":"' || n_name || '","region":' || n_regionkey || ',"suppliers":' || count(s_suppkey)
 || '}' AS notes FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey, n_name, n_regionkey""",
)
def to_json_notes(spark, sf):
    joined = table(spark, sf, "nation").join(
        table(spark, sf, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    counted = joined.groupBy("n_nationkey", "n_name", "n_regionkey").agg(F.count("s_suppkey").alias("n"))
    return counted.select(
        "n_nationkey", A.to_json_notes(name="n_name", region="n_regionkey", suppliers="n").alias("notes")
    )


@check(
    "hsh1_content_hash",
    "SELECT doc_id, sha256(text) AS sha256 FROM documents",
)
def content_hash(spark, sf):
    from arealoom.sources.files import content_hash as hashed

    files = table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    return hashed(files).select("doc_id", "sha256")


@check(
    "num3_promote_numeric",
    f"SELECT o_orderkey, {SQL_FIGURE} AS figure, o_totalprice AS total, o_orderstatus AS status FROM orders",
)
def promote_numeric(spark, sf):
    from arealoom.operators.profiling import promote_numeric as promote

    text = printed(spark, sf).select(
        "o_orderkey", "figure", F.col("o_totalprice").cast("string").alias("total"),
        F.col("o_orderstatus").alias("status"),
    )
    return promote(text, 0.9, keep_text=["o_orderkey"])


@check(
    "agg4_sum_null_safe",
    f"""SELECT o_custkey, sum(x) AS total, coalesce(sum(x), 0.0) AS total_or_zero FROM (SELECT o_custkey,
 round({SQL_NUMBER}) AS x FROM orders) GROUP BY o_custkey""",
)
def sum_null_safe(spark, sf):
    parsed = printed(spark, sf).withColumn("x", r(A.parse_measure("figure"), 0))
    return parsed.groupBy("o_custkey").agg(
        A.sum_null_safe("x").alias("total"), A.sum_null_safe("x", True).alias("total_or_zero")
    )
