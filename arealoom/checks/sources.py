"""Sources and sinks (SRC, SNK), file audits (AUD12–AUD14).

Each query writes tables derived from the given ones to the scratch folder and reads them back.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from arealoom.checks.registry import SQL_INVENTORY, cells, check, inventory, table
from arealoom.operators import cells as CE
from arealoom.operators.inventory import choose_source as best_source
from arealoom.session import dealt, scratch_path
from arealoom.sources import files as FI
from arealoom.sources import pages as PG
from arealoom.sources import sinks as SK
from arealoom.sources import tables as T
from arealoom.sources.records import slices


def _codes(spark, sf):
    code = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    return table(spark, sf, "orders").select(code.alias("order_code"), F.col("o_orderpriority").alias("priority"))


_SQL_CODES = "SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS order_code, o_orderpriority AS priority FROM orders"


@check(
    "src1_read_csv_text",
    """SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS order_code, o_orderpriority || CASE WHEN o_orderkey % 5 = 0
 THEN ' "a"' || chr(10) || 'b' ELSE '' END AS priority FROM orders""",
)
def read_csv_text(spark, sf):
    """Every fifth cell holds a line break and quotes."""
    out = scratch_path(spark, "csv")
    codes = _codes(spark, sf)
    broken = F.when(F.col("order_code").cast("long") % 5 == 0, F.concat("priority", F.lit(' "a"\nb'))).otherwise(F.col("priority"))
    named = codes.select("order_code", broken).toDF("﻿order_code ", " priority")
    named.write.option("header", True).option("escape", '"').csv(out)
    return T.read_csv_text(spark, out)


@check(
    "src2_read_csv_any_encoding",
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'région – ' || source AS place FROM documents",
)
def read_csv_any_encoding(spark, sf):
    """Even documents are written as UTF-8, odd ones as Windows-1252 (the dash is byte 96), with the columns
    the other way round."""
    out = scratch_path(spark, "encodings")
    docs = table(spark, sf, "documents")
    for i, (encoding, dash) in enumerate([("UTF-8", "–"), ("ISO-8859-1", "\x96")]):
        place = F.concat(F.lit(f"région {dash} "), "source").alias("place")
        part = docs.filter(F.col("doc_id") % 2 == i).select(*(["doc_id", place] if i == 0 else [place, "doc_id"]))
        part.write.option("header", True).option("encoding", encoding).csv(f"{out}/{i}")
    return T.read_csv_any_encoding(spark, [f"{out}/0", f"{out}/1"])


@check(
    "src3_detect_delimiter",
    """SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS order_code, o_orderpriority || ',,;;||' AS priority FROM orders""",
)
def detect_delimiter(spark, sf):
    """Each delimiter also stands inside quotes, more often than outside."""
    out = scratch_path(spark, "delimiters")
    codes = _codes(spark, sf).withColumn("priority", F.concat("priority", F.lit(",,;;||")))
    for i, sep in enumerate(T.DELIMITERS):
        part = codes.filter(F.col("order_code").cast("long") % 4 == i).select(*(codes.columns if i % 2 else codes.columns[::-1]))
        part.write.option("header", True).option("sep", sep).option("quoteAll", True).csv(f"{out}/{i}")
    return T.read_csv_sniffed(spark, [f"{out}/{i}" for i in range(4)])


@check("src4_read_table", _SQL_CODES)
def read_table(spark, sf):
    out = scratch_path(spark, "pairs")
    codes = _codes(spark, sf)
    even = F.col("order_code").cast("long") % 2 == 0
    codes.filter(even).write.parquet(f"{out}/a.parquet")
    codes.filter(~even).write.option("header", True).csv(f"{out}/b.csv")
    return T.read_table(spark, f"{out}/a").unionByName(T.read_table(spark, f"{out}/b"))


def _json_files(spark, sf, out):
    def arrays(batches):
        for batch in batches:
            yield pd.DataFrame({"value": [batch.to_json(orient="records")]})

    def objects(batches):
        for batch in batches:
            yield pd.DataFrame({"value": [batch.set_index("order_code").to_json(orient="index")]})

    for name, fn in (("lists", arrays), ("objects", objects)):
        _codes(spark, sf).mapInPandas(fn, "value string").write.option("maxRecordsPerFile", 1).text(f"{out}/{name}")


@check("src5_read_json_records", _SQL_CODES)
def read_json_records(spark, sf):
    out = scratch_path(spark, "json")
    _json_files(spark, sf, out)
    return T.read_json_records(spark, f"{out}/lists")


@check("src5_json_keys", "SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS key FROM orders")
def json_keys(spark, sf):
    out = scratch_path(spark, "json")
    _json_files(spark, sf, out)
    return T.json_keys(spark, f"{out}/objects").select("key")


@check(
    "src6_file_inventory",
    """SELECT lang, CAST(sum(33) AS BIGINT) AS size, true AS named, 'live' AS folder FROM documents GROUP BY 1""",
)
def file_inventory(spark, sf):
    """Each document is a line of 32 characters; sizes by language, names and folders of the live files."""
    out = scratch_path(spark, "tree")
    docs = table(spark, sf, "documents").select(F.md5(F.col("doc_id").cast("string")).alias("value"), "lang")
    docs.write.partitionBy("lang").text(f"{out}/live")
    docs.write.partitionBy("lang").text(f"{out}/archive")
    docs.write.partitionBy("lang").parquet(f"{out}/other")
    listed = FI.file_inventory(spark, out, [".txt"])
    return listed.groupBy(F.regexp_extract("path", "lang=([^/]+)", 1).alias("lang")).agg(
        F.sum("size").alias("size"),
        F.bool_and(F.col("file_name").rlike(r"^part-.*\.txt$")).alias("named"),
        F.max(F.regexp_extract("path", "/([^/]+)/lang=", 1)).alias("folder"),
    )


def _archives(spark, sf):
    """One zip per document: its text, and a table about it."""

    def pack(batches):
        for batch in slices(batches):
            paths, contents = [], []
            for doc, text, lang in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lang")), strict=True):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("about/Table.CSV", f"doc_id,lang\n{doc},{lang}\n")
                    archive.writestr("text.bin", text.encode("utf-8"))
                paths.append(f"doc_{doc}.zip")
                contents.append(buffer.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return docs.mapInArrow(pack, "path string, content binary")


@check(
    "src7_zip_members",
    """SELECT 'doc_' || doc_id || '.zip' AS path, 'text.bin' AS member, '.bin' AS member_extension,
 CAST(octet_length(CAST(encode(text) AS BLOB)) AS BIGINT) AS size, 'not_tabular' AS member_status FROM documents UNION ALL
 SELECT 'doc_' || doc_id || '.zip', 'about/Table.CSV', '.csv', CAST(14 + length(CAST(doc_id AS VARCHAR)) + length(lang) AS
 BIGINT), 'extracted' FROM documents""",
)
def zip_members(spark, sf):
    return FI.zip_members(_archives(spark, sf), with_content=False).drop("compressed_size")


@check(
    "src7_member_lines",
    "SELECT 'doc_' || doc_id || '.zip' AS path, 1 AS line, doc_id || ',' || lang AS value FROM documents",
)
def member_lines(spark, sf):
    lines = FI.member_lines(FI.zip_members(_archives(spark, sf)))
    return lines.filter("line > 0").select("path", "line", "value")


def _measure_pages(spark, sf):
    """One statistics page per part, headings and a table. Parts are dealt over tasks before the pages are made."""
    cell = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    html = cell(
        "<html><body><h1>Part ", F.col("p_name"), "</h1><h2>Sales &amp; stock</h2><h3>", F.col("p_type"),
        "</h3><p>intro</p><table><tr><th>Label</th><th>Count</th><th>%</th><th>State</th></tr><tr><td>Size</td><td>",
        F.col("p_size").cast("string"), "</td><td>12.5</td><td>99</td></tr><tr><td>Retail price</td><td>$",
        F.format_string("%,.2f", "p_retailprice"), "</td><td>n.p.</td><td>1</td></tr><tr><td>Notes</td><td>1</td><td>2</td>"
        "</tr></table><h2>Other</h2><table><tr><td>only one column</td></tr></table></body></html>",
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    return dealt(parts, "p_partkey", 5_000).select("p_partkey", html.alias("html"))


@check(
    "src8_html_tables_to_long",
    """SELECT p_partkey, 'census_qs_sales_and_stock_' || lower(p_type) || '_label_' || v AS variable_name, value, 'Part ' || p_name
 AS area_name, p_type AS topic, label AS row_label FROM (SELECT *, unnest(['size_count', 'size_pct', 'retail_price_count']) AS v,
 unnest(['Size', 'Size', 'Retail price']) AS label, unnest([CAST(p_size AS DOUBLE), 12.5, p_retailprice]) AS value FROM part)""",
)
def html_tables_to_long(spark, sf):
    out = PG.html_tables_to_long(_measure_pages(spark, sf), "p_partkey", "html")
    return out.select("p_partkey", "variable_name", "value", "area_name", "topic", "row_label")


@check(
    "src9_extract_links",
    """WITH a AS (SELECT page_id, unnest(regexp_extract_all(html,
 '(?is)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 0)) AS anchor FROM pages)
 SELECT page_id, regexp_extract(anchor, 'href\\s*=\\s*["'']([^"'']*)["'']', 1) AS href, regexp_replace(replace(replace(
 replace(replace(replace(regexp_replace(regexp_extract(anchor, '(?is)<a\\s[^>]*>(.*?)</a>', 1), '<[^>]+>', ' ', 'g'),
 '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '^\\s+|\\s+$', '', 'g') AS label FROM a""",
)
def extract_links(spark, sf):
    return PG.extract_links(table(spark, sf, "pages"), "page_id", "html").select("page_id", "href", "label")


@check(
    "src10_detect_header_row",
    """SELECT p_brand AS file, CAST(p_partkey AS VARCHAR) AS sheet, CAST(p_partkey % 3 + 1 AS INTEGER) AS header_row,
 34 AS score FROM part""",
)
def detect_header_row(spark, sf):
    return CE.detect_header_row(cells(spark, sf)).withColumn("score", F.col("score").cast("int"))


@check(
    "src11_combine_headers",
    """SELECT p_brand AS file, CAST(p_partkey AS VARCHAR) AS sheet, col AS col_idx, CASE WHEN p_partkey % 3 > 0 THEN p_name ||
 ' | ' ELSE '' END || CASE col WHEN 0 THEN 'Area | Area code' WHEN 1 THEN 'Area | Area name' WHEN 2 THEN p_type || ' | Count'
 ELSE p_type || ' | Rate %' END AS header FROM (SELECT *, unnest([0, 1, 2, 3]) AS col FROM part)""",
)
def combine_headers(spark, sf):
    grid = cells(spark, sf)
    return CE.combine_headers(grid, CE.detect_header_row(grid))


@check(
    "src12_choose_table",
    """SELECT o_custkey, o_orderkey, s AS score FROM (SELECT o_custkey, o_orderkey, o_totalprice / 1000.0 AS s, row_number()
 OVER (PARTITION BY o_custkey ORDER BY o_totalprice / 1000.0 DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1 AND s >= 120""",
)
def choose_table(spark, sf):
    candidates = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", (F.col("o_totalprice") / 1000.0).alias("score")
    )
    return CE.choose_table(candidates, "o_custkey", "score", ["o_orderkey"])


@check(
    "src13_choose_source",
    """SELECT source, lang, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY score DESC, doc_id)
 AS rn FROM (SELECT *, CASE WHEN contains(lower(text), 'tion') THEN 15 ELSE 0 END + CASE WHEN contains(lower(text), 'the')
 THEN 10 ELSE 0 END + CASE WHEN contains(lower(text), 'eau') THEN 12 ELSE 0 END AS score FROM documents) WHERE score >= 20)
 WHERE rn = 1""",
)
def choose_source(spark, sf):
    docs = table(spark, sf, "documents")
    out = best_source(docs, ["source", "lang"], "text", [("tion", 15), ("the", 10), ("eau", 12)], ["doc_id"])
    return out.select("source", "lang", "doc_id", "score")


@check(
    "src14_sniff_type",
    """SELECT doc_id, CASE CAST(doc_id % 5 AS INTEGER) WHEN 0 THEN '.zip_or_xlsx' WHEN 1 THEN '.pdf' WHEN 2 THEN '.html'
 WHEN 3 THEN '.csv' ELSE 'unknown' END AS sniffed_type FROM documents""",
)
def sniff_type(spark, sf):
    start = F.element_at(
        F.array(*[F.lit(s) for s in ("PK\x03\x04", "%PDF-1.7", " \n<html>", "a,b", "~")]), (F.col("doc_id") % 5 + 1).cast("int")
    )
    path = F.concat(F.lit("raw.d/file"), F.when(F.col("doc_id") % 5 == 3, ".CSV").otherwise(""))
    files = table(spark, sf, "documents").select(
        "doc_id", path.alias("path"), F.encode(F.concat(start, "text"), "UTF-8").alias("content")
    )
    return FI.sniff_type(files).select("doc_id", "sniffed_type")


@check(
    "hsh1_same_content",
    f"""WITH {SQL_INVENTORY} SELECT doc_id, sha256 FROM files WHERE size IN (SELECT size FROM files GROUP BY 1 HAVING
 count(*) > 1)""",
)
def same_content(spark, sf):
    files = inventory(spark, sf).withColumn("content", F.encode("text", "UTF-8")).drop("sha256")
    return FI.same_content(files).select("doc_id", "sha256")


@check("snk1_write_pair", "SELECT fmt, order_code, priority FROM (" + _SQL_CODES + "), (SELECT unnest(['csv', 'parquet']) AS fmt)")
def write_pair(spark, sf):
    base = scratch_path(spark, "pair")
    written = SK.write_pair(_codes(spark, sf), base)
    as_csv = T.read_csv_text(spark, base + ".csv")
    return written.select(F.lit("parquet").alias("fmt"), "*").unionByName(as_csv.select(F.lit("csv").alias("fmt"), "*"))


_ROUTED = "CASE WHEN event_type = 'error' THEN 'unknown_review' ELSE event_type END"


def _native(spark, sf):
    base = scratch_path(spark, "native")
    level = F.when(F.col("event_type") != "error", F.col("event_type"))
    SK.write_by_geography(table(spark, sf, "events").withColumn("native_geography", level), base)
    return base


@check("snk2_write_by_geography", f"SELECT event_id, {_ROUTED} AS native_geography FROM events")
def write_by_geography(spark, sf):
    return spark.read.parquet(_native(spark, sf)).select("event_id", "native_geography")


@check(
    "snk3_conform",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, '' AS missing_one, CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM customer",
)
def conform(spark, sf):
    from arealoom.operators.catalog import conform as declared

    out = declared(
        table(spark, sf, "customer"), {"c_custkey": "string", "missing_one": "string", "c_acctbal": "double"}
    )
    return out.na.fill("")


@check("snk4_stage_existing", "SELECT 'orders' AS source_table, 'sales' AS source_family, count(*) AS n FROM orders")
def stage_existing(spark, sf):
    out = scratch_path(spark, "stage")
    candidates = {"orders": [f"{out}/absent", f"{sf}/orders"], "gone": [f"{out}/absent"]}
    log = SK.stage_existing(spark, candidates, "sales", "state", out)
    assert [row[2] for row in log] == ["staged", "not_found"]
    staged = spark.read.parquet(out)
    return staged.groupBy("source_table", "source_family").agg(F.count("*").alias("n"))


@check(
    "aud12_file_diagnostic",
    """SELECT c AS column_name, count(*) AS row_count, count(DISTINCT v) AS distinct_values,
 array_to_string(list_sort(list(DISTINCT v))[1:4], ' | ') AS sample_values FROM (SELECT unnest(['o_orderstatus',
 'o_orderpriority']) AS c, unnest([o_orderstatus, o_orderpriority]) AS v FROM orders) GROUP BY 1""",
)
def file_diagnostic(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return T.file_diagnostic(orders, ["o_orderstatus", "o_orderpriority"], 4).drop("path")


@check(
    "aud13_freeze",
    f"""WITH {SQL_INVENTORY}, r AS (SELECT DISTINCT family FROM files WHERE family NOT IN ('src1', 'src2')) SELECT family,
 count(*) AS file_count, CAST(sum(size) AS BIGINT) AS total_size_bytes, count(*) AS hashed_files, CASE WHEN family IN
 ('src1', 'src2') THEN 'files_without_register' ELSE 'ready' END AS freeze_status FROM files GROUP BY 1""",
)
def freeze(spark, sf):
    files = inventory(spark, sf).drop("text")
    register = files.filter("family not in ('src1', 'src2')").select("family")
    out = FI.freeze(files, register, "family")
    return out.select("family", "file_count", "total_size_bytes", "hashed_files", "freeze_status")


@check("aud14_table_index", f"SELECT {_ROUTED} AS native_geography, count(*) AS table_rows, true AS has_files FROM events GROUP BY 1")
def table_index(spark, sf):
    index = SK.table_index(spark, _native(spark, sf))
    return index.select("native_geography", "table_rows", (F.col("size") > 0).alias("has_files"))


@check("stm1_stage_arrivals", "SELECT DISTINCT event_id, event_type FROM events")
def stage_arrivals(spark, sf):
    """Two batches of extracts arrive; the second run stages only the second."""
    from arealoom.streaming.resume import stage_arrivals as stage
    from arealoom.streaming.resume import staged_rows

    out = scratch_path(spark, "arrivals")
    events = table(spark, sf, "events").select("event_id", "event_type")
    for i in range(2):
        events.filter(F.col("event_id") % 2 == i).write.mode("append").parquet(f"{out}/source")
        stage(spark, f"{out}/source", f"{out}/target", f"{out}/progress", "event_id long, event_type string")
    return staged_rows(spark, f"{out}/target")
