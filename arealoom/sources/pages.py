"""Web pages: links and measure tables.

Tables inside HTML need a parser, so that one step runs in Python, page by page, inside
``mapInPandas``; numbers, names and filters around it are column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealoom.functions.measures import parse_measure
from arealoom.functions.text import key_slug, strip_tags, trim_all

_ANCHOR = r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"

# What makes a link a download.
DOWNLOAD = r"(?i)\.(csv|xlsx?|zip|json|pdf)($|[?#])|download|attachment|export"


def extract_links(pages: DataFrame, key: str, html: str, only: str | None = None) -> DataFrame:
    """One row per anchor: target, plain label, and whether it looks like a download."""
    anchors = F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(0))
    links = pages.select(key, F.posexplode(anchors).alias("position", "anchor")).select(
        key,
        "position",
        trim_all(F.regexp_extract("anchor", _ANCHOR, 1)).alias("href"),
        strip_tags(F.regexp_extract("anchor", _ANCHOR, 2)).alias("label"),
    )
    download = F.col("href").rlike(DOWNLOAD) | F.col("label").rlike(DOWNLOAD)
    out = links.withColumn("is_download", download)
    return out if only is None else out.filter(F.col("href").rlike(only))


def html_tokens(html: str) -> list[tuple[str, int, int, str]]:
    """(tag, table, row, text) of headings, and of table cells, in document order."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return reader.tokens


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tokens: list[tuple[str, int, int, str]] = []
        self._open: str | None = None
        self._text: list[str] = []
        self._tables = self._depth = self._row = 0

    def _flush(self):
        if self._open:
            text = " ".join("".join(self._text).split())
            place = (self._tables, self._row) if self._open == "cell" else (0, 0)
            self.tokens.append((self._open, *place, text))
        self._open, self._text = None, []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self._flush()
            self._depth += 1
            if self._depth == 1:
                self._tables, self._row = self._tables + 1, 0
        elif tag == "tr" and self._depth == 1:
            self._flush()
            self._row += 1
        elif tag in ("td", "th") and self._depth == 1:
            self._flush()
            self._open = "cell"
        elif tag in ("h1", "h2", "h3", "h4"):
            self._flush()
            self._open = tag
        elif self._open:
            self._text.append(" ")

    def handle_endtag(self, tag):
        if tag == "table":
            self._flush()
            self._depth = max(0, self._depth - 1)
        elif tag in ("td", "th", "tr", "h1", "h2", "h3", "h4"):
            self._flush()

    def handle_data(self, data):
        if self._open:
            self._text.append(data)


_TOKEN_SCHEMA = "position int, tag string, table_no int, row_no int, text string"


def tokens_of(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Heading and cell tokens of every page, in document order."""
    schema = f"`{key}` {pages.schema[key].dataType.simpleString()}, {_TOKEN_SCHEMA}"

    return pages.select(key, html).mapInPandas(
        _per_page(key, html, lambda text: [(i, *t) for i, t in enumerate(html_tokens(text))], _names(_TOKEN_SCHEMA)),
        schema,
    )


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _per_page(key: str, html: str, parse, names: list[str], chunk: int = 20_000):
    """Apply ``parse`` to every page; records of many small pages share an output batch."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: list[tuple] = []
            for page, text in zip(batch[key], batch[html]):
                rows.extend((page, *record) for record in parse(text or ""))
                if len(rows) >= chunk:
                    yield pd.DataFrame(rows, columns=[key, *names])
                    rows = []
            yield pd.DataFrame(rows, columns=[key, *names])

    return read


_ROW_SCHEMA = (
    "area_name string, h2 string, h3 string, h4 string, table_no int, row_no int, label_header string, "
    "row_label string, local_value string, local_pct string"
)


def _rows(tokens: list[tuple[str, int, int, str]]) -> list[tuple]:
    """Data rows of each table with the headings above it; the first column is the label, the
    first column without and the first with ``%`` in its header are the local figures."""
    title, heads, rows, columns = "", {"h2": "", "h3": "", "h4": ""}, [], None
    grid: dict[tuple[int, int], list[str]] = {}
    context: dict[int, tuple[str, str, str]] = {}
    for tag, table, row, text in tokens:
        if tag == "cell":
            grid.setdefault((table, row), []).append(text)
            context.setdefault(table, (heads["h2"], heads["h3"], heads["h4"]))
        elif tag == "h1":
            title = title or text
        else:
            heads[tag] = text
            for lower in ("h3", "h4"):
                if lower > tag:
                    heads[lower] = ""
    current = None
    for (table, row), cells in grid.items():
        if table != current:
            current, columns = table, cells
            continue
        value = next((i for i, c in enumerate(columns) if i and "%" not in c), None)
        share = next((i for i, c in enumerate(columns) if i and "%" in c), None)
        if value is None:
            continue

        def at(i):
            return cells[i] if i is not None and i < len(cells) else None

        rows.append((title, *context[table], table, row, columns[0], cells[0], at(value), at(share)))
    return rows


def page_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Labelled local figures of every table row, as text. Pages are independent: no shuffle."""
    schema = f"`{key}` {pages.schema[key].dataType.simpleString()}, {_ROW_SCHEMA}"
    return pages.select(key, html).mapInPandas(
        _per_page(key, html, lambda text: _rows(html_tokens(text)), _names(_ROW_SCHEMA)), schema
    )


# Row labels that are notes, not data.
_NOTES = ["note", "notes", "more_information_on"]


def html_tables_to_long(
    pages: DataFrame, key: str, html: str, prefix: str = "census_qs"
) -> DataFrame:
    """Pages to long measures: variable name from headings and row label, value, section, topic."""
    rows = page_rows(pages, key, html)
    label = key_slug("row_label", 55, "bare", "")
    parts = [key_slug(c, 35, "bare", "") for c in ("h2", "h3", "h4", "label_header")]
    context = F.array_join(F.filter(F.array(*parts), lambda p: p != ""), "_")
    context = F.when(context == "", F.concat(F.lit("table_"), F.col("table_no"))).otherwise(context)
    base: Column = key_slug(F.concat_ws("_", F.lit(prefix), context, label), 180, "bare")
    kept = rows.filter(
        (F.trim("row_label") != "") & ~F.lower("row_label").isin("nan", "null") & ~label.isin(_NOTES)
    )
    figures = F.array(
        F.struct(F.lit("_count").alias("s"), parse_measure("local_value").alias("value"), F.lit("count_or_value").alias("measure_type")),
        F.struct(F.lit("_pct").alias("s"), parse_measure("local_pct").alias("value"), F.lit("percent").alias("measure_type")),
    )
    return (
        kept.select("*", base.alias("__base"), F.inline(figures))
        .filter("value is not null")
        .select(
            key,
            F.concat("__base", "s").alias("variable_name"),
            "value",
            "area_name",
            F.col("h2").alias("section"),
            F.when(F.col("h3") != "", F.col("h3")).otherwise(F.col("h4")).alias("topic"),
            "row_label",
            "measure_type",
            "table_no",
            "row_no",
        )
    )
