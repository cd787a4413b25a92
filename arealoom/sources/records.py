"""Records that go over several lines, read split by split: delimited text with line ends in quoted
cells, and JSON files that hold one list.

Delimited text: a line end stands inside a quoted cell exactly where an odd number of quotes comes before it. So each
split only needs to know whether a cell is open where it begins: the parities of the quotes in the
splits before it, added up. Within a split lines are put together to records as they come. Only the
pieces that a border of splits cuts, two of a split at most, meet in a shuffle.

JSON: a string holds no bare line end, so the brackets of a line outside of its strings count alike
whatever stands before it, and the depth at which a split begins is a sum over the splits before it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Encodings in which a line end and a quote are the bytes that they are in ASCII.
SPLITTABLE = ("utf-8", "iso-8859-1", "windows-1252", "us-ascii")
_PIECES = "path string, block long, place long, head boolean, closed boolean, record string"


def slices(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut to pieces of about ``size`` bytes: a batch has as many rows whether they are short or long,
    and what is made of a piece is gone before the next."""
    for batch in batches:
        step = max(1, batch.num_rows * size // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value")
    )


def open_splits(spark: SparkSession, path) -> DataFrame:
    """The splits (``path``, ``block``) that begin inside a quoted cell, and whether any line end of the
    files stands in one (``inner``); splits without either are left out."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    facts = _lines(spark, path).groupBy("path", "block").agg(
        F.sum(quotes).alias("n"), F.bool_or(quotes % 2 == 1).alias("inner")
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = facts.withColumn("begins_open", F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1)
    return opened.filter("inner OR begins_open").select("path", "block", "inner", "begins_open")


def _pieces(lines: DataFrame, begins_open: set[tuple[str, int]]) -> DataFrame:
    """Lines of every split put together to records; ``head`` marks the rest of a record of an earlier
    split, ``closed`` that it ends here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, place, head, odd = None, [], 0, False, False
        for batch in slices(batches):
            out: list[tuple] = []
            counts = pc.count_substring(batch.column("value"), '"').to_pylist()
            rows = zip(batch.column("path").to_pylist(), batch.column("block").to_pylist(), batch.column("value").to_pylist(), counts, strict=True)
            for path, block, value, count in rows:
                if (path, block) != split:
                    if held:
                        out.append((*split, place, head, False, "\n".join(held)))
                    split, held, place = (path, block), [], 0
                    head = odd = split in begins_open
                held.append(value)
                odd ^= count % 2 == 1
                if not odd:
                    out.append((path, block, place, head, True, "\n".join(held)))
                    held, place, head = [], place + 1, False
            yield _table(out)
        if held:
            yield _table([(*split, place, head, False, "\n".join(held))])

    return lines.mapInArrow(run, _PIECES)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in _PIECES.split(", ")])


def _glued(pieces: DataFrame, between: str = "\n") -> DataFrame:
    """Whole records of pieces, those that borders of splits cut put together."""
    whole = pieces.filter("closed AND NOT head").select("path", "block", "place", "record")
    cut = pieces.filter("head OR NOT closed")
    order = Window.partitionBy("path").orderBy("block", "place")
    cut = cut.withColumn("first", F.sum(F.when(F.col("head"), 0).otherwise(1)).over(order))
    joined = cut.groupBy("path", "first").agg(
        F.min(F.struct("block", "place")).alias("at"), F.array_sort(F.collect_list(F.struct("block", "place", "record"))).alias("parts")
    )
    glued = joined.select("path", "at.block", "at.place", F.array_join(F.transform("parts", lambda p: p["record"]), between).alias("record"))
    return whole.unionByName(glued)


def quoted_records(spark: SparkSession, path, encoding: str = "UTF-8") -> DataFrame:
    """``path``, ``block`` and ``place`` (the order of records in a file), the text of every ``record``
    without its line end, and whether that was two signs (``crlf``). Empty records are left out.

    Of each split the driver learns one number, whether it begins in a quoted cell, as it plans every
    split anyway. A quote that is never closed makes the rest of its file one record."""
    open_ = {(r.path, r.block) for r in open_splits(spark, path).filter("begins_open").select("path", "block").collect()}
    lines = _lines(spark, path)
    raw = F.col("value").cast("binary")
    text = F.make_valid_utf8("value") if encoding.lower() == "utf-8" else F.decode(raw, encoding)
    pieces = _pieces(lines.withColumn("value", text), open_)
    records = _glued(pieces)
    crlf = F.endswith("record", F.lit("\r"))
    ended = records.select("path", "block", "place", crlf.alias("crlf"), F.regexp_replace("record", "\r$", "").alias("record"))
    return ended.filter("record <> ''")


_STRING = r'"[^"\\]*(?:\\.[^"\\]*)*"'
_TOKENS = re.compile(_STRING + r"|[\[\]{}]")


def list_items(spark: SparkSession, path) -> DataFrame:
    """``path``, ``block`` and ``place`` (the order of items in a file) and the text of every ``record``: the
    objects and lists that are items of the one list in each JSON file, or the one object in it. Line ends between tokens
    become spaces (also in what Spark keeps as raw JSON text). A file without line ends is one task's work, as nothing in it can be split.

    Of each split the driver learns one number, the depth at which it begins."""
    bare = F.regexp_replace("value", _STRING, "")
    signs = lambda chars: F.length(bare) - F.length(F.translate(bare, chars, ""))
    lines = _lines(spark, path).withColumn("value", F.regexp_replace("value", "\r$", ""))
    first = F.substring(F.regexp_replace("value", r"^\s+", ""), 1, 1)
    facts = lines.withColumn("at", F.monotonically_increasing_id()).groupBy("path", "block").agg(
        F.sum(signs("[{") - signs("]}")).alias("n"), F.min_by(F.nullif(first, F.lit("")), F.when(first != "", F.col("at"))).alias("first")
    )
    before = Window.partitionBy("path").orderBy("block")
    upto = before.rowsBetween(Window.unboundedPreceding, -1)
    depths = facts.select(
        "path",
        "block",
        F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("depth"),
        # an object alone in its file is its one item
        F.when(F.first("first", ignorenulls=True).over(before.rowsBetween(Window.unboundedPreceding, 0)) == "{", 0).otherwise(1).alias("base"),
    ).filter("depth <> 0 OR base = 0")
    begins = {(r.path, r.block): (r.depth, r.base) for r in depths.collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, place, head, depth, base = None, [], 0, False, 0, 1
        for batch in slices(batches):
            out: list[tuple] = []
            for path, block, value in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "value")), strict=True):
                if (path, block) != split:
                    if held:
                        out.append((*split, place, head, False, " ".join(held)))
                    split, held, place = (path, block), [], 0
                    depth, base = begins.get(split, (0, 1))
                    head = depth > base
                start = 0
                for token in _TOKENS.finditer(value):
                    sign = token.group()
                    if sign in "[{":
                        depth += 1
                        if depth == base + 1:
                            start = token.start()
                    elif sign in "]}":
                        depth -= 1
                        if depth == base:
                            held.append(value[start : token.end()])
                            out.append((path, block, place, head, True, " ".join(held)))
                            held, place, head = [], place + 1, False
                if depth > base:
                    held.append(value[start:])
            yield _table(out)
        if held:
            yield _table([(*split, place, head, False, " ".join(held))])

    return _glued(lines.mapInArrow(run, _PIECES), " ")
