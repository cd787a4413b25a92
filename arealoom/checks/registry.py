"""Registry and the derived tables that several queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealoom.session import dealt, materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = " ".join(sql.split())
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def iso(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("date").cast("string")


def r(c, digits: int = 4) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# --- SQL fragments ---------------------------------------------------------------------------


def sql_slug(x: str, max_len: int = 140, variant: str = "and", empty: str = "unnamed") -> str:
    t = f"lower(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'))"
    if variant == "bare":
        t = f"regexp_replace({t}, '\\([^)]*\\)', ' ', 'g')"
    if variant != "plain":
        t = f"replace({t}, '&', ' and ')"
    if variant in ("symbols", "bare"):
        t = f"replace(replace({t}, '%', ' pct '), '$', ' dollar ')"
    t = f"regexp_replace(regexp_replace({t}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"
    t = f"(CASE WHEN {t} = '' THEN '{empty}' ELSE {t} END)"
    return f"regexp_replace(substring({t}, 1, {max_len}), '_+$', '')"


# --- published figures: order totals as a statistical office would print them -----------------


def printed(spark: SparkSession, sf: str) -> DataFrame:
    """orders with a text figure that is suppressed, banded, blank or formatted by turns."""
    key = F.col("o_orderkey")
    text = F.col("o_totalprice").cast("string")
    figure = (
        F.when(key % 11 == 0, "n.p.")
        .when(key % 13 == 0, "<5")
        .when(key % 17 == 0, " ")
        .when(key % 19 == 0, F.concat(F.lit(" $1,"), F.lpad((key % 1000).cast("string"), 3, "0")))
        .when(key % 23 == 0, "about 5")
        .otherwise(text)
    )
    return table(spark, sf, "orders").withColumn("figure", figure)


SQL_FIGURE = """(CASE WHEN o_orderkey % 11 = 0 THEN 'n.p.' WHEN o_orderkey % 13 = 0 THEN '<5'
 WHEN o_orderkey % 17 = 0 THEN ' ' WHEN o_orderkey % 19 = 0
 THEN ' $1,' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
 WHEN o_orderkey % 23 = 0 THEN 'about 5' ELSE CAST(o_totalprice AS VARCHAR) END)"""

SQL_NUMBER = """(CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN NULL
 WHEN o_orderkey % 19 = 0 THEN 1000.0 + o_orderkey % 1000
 WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_totalprice END)"""


# --- a weighted bridge: orders to suppliers by quantity ---------------------------------------


def order_bridge(spark: SparkSession, sf: str, stored: bool = False) -> DataFrame:
    """Edges order → supplier with the supplier's share of the order's quantity. ``stored`` writes
    them first, as a published correspondence that is read several times."""
    from arealoom.operators.bridges import share_of_total

    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    edges = share_of_total(lines, "l_orderkey", "l_suppkey", "l_quantity").select(
        "l_orderkey", "l_suppkey", F.col("share").alias("ratio")
    )
    return materialise(edges, "edges") if stored else edges


SQL_BRIDGE = """bridge AS (SELECT l_orderkey, l_suppkey,
 sum(l_quantity) / sum(sum(l_quantity)) OVER (PARTITION BY l_orderkey) AS ratio
 FROM lineitem GROUP BY l_orderkey, l_suppkey)"""


# --- a column catalog: every order is a table, its lines are the columns -----------------------

# Header text per part type.
HEADERS = [
    ("STANDARD", "SA2 Code 2021"), ("MEDIUM", "SA3_NAME"), ("PROMO", "LGA code"),
    ("LARGE", "Jurisdiction"), ("SMALL", "Total persons"), ("ECONOMY", "Rate (%)"),
]


def headers(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    name = F.lit(None).cast("string")
    for kind, text in HEADERS:
        name = F.when(F.col("p_type") == kind, text).otherwise(name)
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").cast("string").alias("table_name"),
        F.col("l_linenumber").alias("ordinal"),
        name.alias("column_name"),
    )


SQL_HEADERS = (
    "headers AS (SELECT CAST(l_orderkey AS VARCHAR) AS table_name, l_linenumber AS ordinal, CASE p_type "
    + " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in HEADERS)
    + " END AS column_name FROM lineitem JOIN part ON l_partkey = p_partkey)"
)


# --- a cell grid: every part is a sheet ------------------------------------------------------


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """Sheets with 0 to 2 title rows, a merged heading row, a header row and two data rows.

    Parts are dealt over tasks before their cells, about twenty of each, are made."""
    k, row, col = F.col("p_partkey") % 3, F.col("row_idx"), F.col("col_idx")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    grid = (
        dealt(parts, "p_partkey", 10_000)
        .select("*", F.explode(F.sequence(F.lit(0), (k + 3).cast("int"))).alias("row_idx"))
        .select("*", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("col_idx"))
    )
    header = F.element_at(F.array(*[F.lit(h) for h in ("Area code", "Area name", "Count", "Rate %")]), col + 1)
    data = F.element_at(
        F.array(
            F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.col("p_name"),
            F.col("p_size").cast("string"), F.lit("12.5"),
        ),
        col + 1,
    )
    value = (
        F.when(row < k, F.when(col == 0, F.col("p_name")))
        .when(row == k, F.when(col == 0, "Area").when(col == 2, F.col("p_type")))
        .when(row == k + 1, header)
        .otherwise(data)
    )
    return grid.select(
        F.col("p_brand").alias("file"), F.col("p_partkey").cast("string").alias("sheet"), "row_idx", "col_idx",
        value.alias("value"),
    )


# --- period labels -----------------------------------------------------------------------------


def period_labels(spark: SparkSession, sf: str) -> DataFrame:
    """orders with their date, moved to 2001–2007, written in one of twelve layouts."""
    day = F.add_months(F.col("o_orderdate").cast("date"), 72)
    q = F.quarter(day)
    fy = F.year(day) + F.when(F.month(day) >= 7, 1).otherwise(0)
    fy_q = F.when(F.month(day) >= 7, q - 2).otherwise(q + 2)
    two = lambda c: F.lpad((c % 100).cast("string"), 2, "0")
    layouts = [
        F.date_format(day, "yyyyMMdd"),
        F.date_format(day, "yyyyMM"),
        F.date_format(day, "yyyy_MM"),
        F.concat(F.year(day).cast("string"), F.lit("-Q"), q.cast("string")),
        F.concat(F.lit("Q"), fy_q.cast("string"), F.lit(" FY"), two(fy - 1), F.lit("/"), two(fy)),
        F.date_format(day, "MMM-yyyy"),
        F.date_format(day, "MM/yyyy"),
        F.concat(F.lit("Data as at "), F.date_format(day, "d MMMM yyyy")),
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "dd/MM/yyyy"),
        F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string"),
        F.lit("n.p."),
    ]
    label, turn = F, F.col("o_orderkey") % 12
    for i, layout in enumerate(layouts):
        label = label.when(turn == i, layout)
    return table(spark, sf, "orders").select("o_orderkey", day.alias("day"), label.alias("label"))


SQL_DAY = "CAST(CAST(o_orderdate AS DATE) + INTERVAL 72 MONTH AS DATE)"
SQL_PERIOD = f"""(CASE CAST(o_orderkey % 12 AS INTEGER) WHEN 0 THEN {SQL_DAY}
 WHEN 1 THEN last_day({SQL_DAY}) WHEN 2 THEN last_day({SQL_DAY})
 WHEN 3 THEN last_day(CAST(date_trunc('quarter', {SQL_DAY}) + INTERVAL 2 MONTH AS DATE))
 WHEN 4 THEN last_day(CAST(date_trunc('quarter', {SQL_DAY}) + INTERVAL 2 MONTH AS DATE))
 WHEN 5 THEN last_day({SQL_DAY}) WHEN 6 THEN last_day({SQL_DAY}) WHEN 11 THEN NULL ELSE {SQL_DAY} END)"""


# --- a file inventory: every document is a file --------------------------------------------------

# Extension by turn.
EXTENSIONS = [".csv", ".pdf", ".html", ".xlsx", ".zip", ".txt", ".tmp", ".png"]


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    ext = F.element_at(F.array(*[F.lit(e) for e in EXTENSIONS]), (F.col("doc_id") % 8 + 1).cast("int"))
    name = F.concat(F.lit("Table_"), F.col("doc_id").cast("string"), ext)
    folder = F.when(F.col("doc_id") % 7 == 0, "raw/_archive").when(F.col("doc_id") % 5 == 0, "raw/capture")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.concat_ws("/", F.coalesce(folder, F.lit("raw")), "source", name).alias("path"),
        name.alias("file_name"),
        ext.alias("file_extension"),
        F.octet_length("text").cast("long").alias("size"),
        F.sha2("text", 256).alias("sha256"),
        F.col("source").alias("family"),
        "lang",
        "text",
    )


SQL_INVENTORY = (
    "files AS (SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'raw/_archive' WHEN doc_id % 5 = 0 THEN 'raw/capture'"
    " ELSE 'raw' END || '/' || source || '/' || file_name AS path FROM (SELECT doc_id, source, lang, text,"
    " 'Table_' || doc_id || ext AS file_name, ext AS file_extension,"
    " CAST(octet_length(CAST(encode(text) AS BLOB)) AS BIGINT) AS size, sha256(text) AS sha256, source AS family"
    " FROM (SELECT *, CASE CAST(doc_id % 8 AS INTEGER) "
    + " ".join(f"WHEN {i} THEN '{e}'" for i, e in enumerate(EXTENSIONS))
    + " END AS ext FROM documents)))"
)
