"""Delimited text, Parquet and JSON readers.

Path columns come URI-encoded from Spark; they are decoded before they are read again.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealoom.operators.catalog import clean_header
from arealoom.session import col_name, scratch_path
from arealoom.sources.records import SPLITTABLE, list_items, quoted_records


def read_csv_text(
    spark: SparkSession, path, sep: str = ",", encoding: str = "UTF-8", multi_line: bool | None = None
) -> DataFrame:
    """Every column as text, so leading zeros survive; headers without BOM or stray whitespace.

    A quoted cell may hold line breaks (``multi_line``; unless given it is decided by one aggregate over
    the lines: only where some line has an odd number of quotes). Such files are read split by split
    too, by the parity of the quotes before each split."""
    if multi_line is None:
        lines = spark.read.text(path)
        multi_line = bool(lines.agg(F.bool_or(_open_quote(F.col("value"))).alias("m")).first()["m"])
    if multi_line and encoding.lower() in SPLITTABLE:
        df = _parsed_records(spark, path, sep, encoding).drop(SOURCE)
    else:
        df = _csv(spark, path, sep, encoding, multi_line)
    return df.toDF(*[clean_header(c) for c in df.columns])


#: Column for the file that a row comes from.
SOURCE = "__source_path"


def _csv(spark: SparkSession, path, sep: str, encoding: str, multi_line: bool) -> DataFrame:
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def _parsed_records(spark: SparkSession, path, sep: str, encoding: str) -> DataFrame:
    """The cells of every record but the first of each file, under the names that Spark reads from the
    first file, and the file."""
    names = _csv(spark, path, sep, encoding, True).columns
    records = quoted_records(spark, path, encoding)
    first = records.groupBy("path").agg(F.min(F.struct("block", "place", "crlf")).alias("header"))
    rows = records.join(first, "path").filter(F.struct("block", "place") > F.struct("header.block", "header.place"))
    # the line end of the file reads as one sign inside of cells too
    same_end = F.when(F.col("header.crlf"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    rows = rows.withColumn("record", same_end)
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    cells = rows.select(F.from_csv("record", schema, {"sep": sep, "quote": '"', "escape": '"'}).alias("r"), F.col("path").alias(SOURCE))
    return cells.select(*[F.col(f"r.c{i}") for i in range(len(names))], SOURCE).toDF(*names, SOURCE)


def _open_quote(line: Column) -> Column:
    """Whether a quote that opens on a line is not closed on it."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


# Delimiters tried, in order of preference.
DELIMITERS = [",", "\t", ";", "|"]


def file_layouts(spark: SparkSession, path) -> DataFrame:
    """How each file is to be read, from one pass over split text: ``encoding`` (UTF-8, else Windows-1252,
    else Latin-1 where a byte is undefined in Windows-1252), ``delimiter`` (outside quotes on most lines,
    then the most frequent one), ``multi_line`` (a quoted cell goes over a line end), ``header_id`` (a
    hash of the first line) and ``lines`` that are not empty. No file is ever one value."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("position"),
        "value",
    )
    valid = F.is_valid_utf8("value")
    undefined = F.hex(F.col("value").cast("binary")).rlike("^(..)*(81|8D|8F|90|9D)")
    bare = F.regexp_replace("value", '"[^"]*("|$)', "")
    counted = [F.length(bare) - F.length(F.replace(bare, F.lit(d), F.lit(""))) for d in DELIMITERS]
    facts = lines.groupBy("path").agg(
        F.bool_and(valid).alias("utf8"),
        F.coalesce(F.bool_or(F.when(~valid, undefined)), F.lit(False)).alias("undefined"),
        F.bool_or(_open_quote(F.col("value"))).alias("multi_line"),
        F.min_by(F.sha2(F.col("value").cast("binary"), 256), F.struct("start", "position")).alias("header_id"),
        F.count_if(F.col("value").cast("binary") != F.lit(b"")).alias("lines"),
        *[F.count_if(n > 0).alias(f"l{i}") for i, n in enumerate(counted)],
        *[F.sum(n).alias(f"n{i}") for i, n in enumerate(counted)],
    )
    ranked = F.array(
        *[
            F.struct(F.col(f"l{i}").alias("l"), F.col(f"n{i}").alias("n"), F.lit(-i).alias("p"), F.lit(d).alias("d"))
            for i, d in enumerate(DELIMITERS)
        ]
    )
    encoding = F.when(F.col("utf8"), "UTF-8").when(~F.col("undefined"), "windows-1252").otherwise("ISO-8859-1")
    return facts.select(
        "path", encoding.alias("encoding"), F.array_max(ranked)["d"].alias("delimiter"), "multi_line", "header_id", "lines"
    )


def file_encodings(spark: SparkSession, path) -> DataFrame:
    """Encoding of each file."""
    return file_layouts(spark, path).select("path", "encoding")


def detect_delimiter(spark: SparkSession, path) -> DataFrame:
    """Delimiter of each file."""
    return file_layouts(spark, path).select("path", "delimiter")


# Windows-1252 is Latin-1 but for the bytes 80 to 9F, of which five are undefined.
_C1 = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
_C1_FROM = "".join(c for c, w in _C1 if w)
_C1_TO = "".join(w for _, w in _C1 if w)


def from_windows_1252(df: DataFrame) -> DataFrame:
    """Text that was read as Latin-1, header included, as Windows-1252."""
    fixed = df.select(*[F.translate(F.col(col_name(c)), _C1_FROM, _C1_TO).alias(c) for c in df.columns])
    return fixed.toDF(*[c.translate(str.maketrans(_C1_FROM, _C1_TO)) for c in df.columns])


def read_group(
    spark: SparkSession, paths: list[str], sep: str, encoding: str, multi_line: bool, with_source: bool = False
) -> DataFrame:
    """Files of one layout and header as one table; with the file of each row as ``SOURCE`` if asked."""
    windows = encoding == "windows-1252"
    known = "ISO-8859-1" if windows else encoding
    if multi_line and known.lower() in SPLITTABLE:
        part = _parsed_records(spark, sorted(paths), sep, known)
    else:
        part = _csv(spark, sorted(paths), sep, known, multi_line)
        part = part.withColumn(SOURCE, F.col("_metadata.file_path"))
    part = part.toDF(*[clean_header(c) for c in part.columns])
    if windows:
        part = from_windows_1252(part)
    return part if with_source else part.drop(SOURCE)


def layout_groups(layouts: DataFrame, sep: str | None = None) -> dict[tuple, list[str]]:
    """Files that one scan can read: (delimiter, encoding, multi-line, header) -> paths. Of each file the
    driver sees the path, which it lists for any scan anyway, and its layout; no data."""
    groups: dict[tuple, list[str]] = {}
    for row in layouts.select("path", "delimiter", "encoding", "multi_line", "header_id").collect():
        key = (sep or row["delimiter"], row["encoding"], row["multi_line"], row["header_id"])
        groups.setdefault(key, []).append(unquote(row["path"]))
    return dict(sorted(groups.items()))


def read_delimited(spark: SparkSession, path, sep: str | None = None) -> DataFrame:
    """Read files of mixed encodings, delimiters and headers as one table: one scan for each layout and
    header found, united by column name."""
    out = None
    for (delimiter, encoding, multi_line, _), paths in layout_groups(file_layouts(spark, path), sep).items():
        part = read_group(spark, paths, delimiter, encoding, multi_line)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_csv_any_encoding(spark: SparkSession, path, sep: str = ",") -> DataFrame:
    """Read files of mixed encodings as one table."""
    return read_delimited(spark, path, sep)


def read_csv_sniffed(spark: SparkSession, path) -> DataFrame:
    """Read files of mixed delimiters as one table."""
    return read_delimited(spark, path)


def read_table(spark: SparkSession, base: str) -> DataFrame:
    """``base.parquet`` if there, else ``base.csv`` as text, else an error."""
    try:
        return spark.read.parquet(base + ".parquet")
    except AnalysisException as missing_parquet:
        try:
            return read_csv_text(spark, base + ".csv")
        except AnalysisException:
            raise FileNotFoundError(f"neither {base}.parquet nor {base}.csv") from missing_parquet


def read_json_records(spark: SparkSession, path) -> DataFrame:
    """Rows of JSON files that hold a list of objects.

    The objects are cut out by several tasks for each file and written, one a line, to the shared
    folder, where Spark's reader finds their schema and reads them again."""
    lines = scratch_path(spark, "json-lines")
    list_items(spark, path).select("record").write.text(lines)
    return spark.read.json(lines)


def json_keys(spark: SparkSession, path) -> DataFrame:
    """Top-level keys of JSON files that hold one object."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        F.explode(F.json_object_keys("value")).alias("key"),
    )


def file_diagnostic(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """Rows, and the first distinct values of some columns, for every file behind a table."""
    tagged = df.select(F.col("_metadata.file_path").alias("path"), *cols)
    pairs = tagged.select(
        "path",
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols])
        ),
    )
    counts = pairs.groupBy("path", "column_name", "value").agg(F.count("*").alias("n"))
    from arealoom.operators.windows import top_n

    first = top_n(counts.filter("value is not null"), ["path", "column_name"], [F.col("value")], k)
    samples = first.groupBy("path", "column_name").agg(
        F.array_join(F.array_sort(F.collect_list("value")), " | ").alias("sample_values")
    )
    totals = counts.groupBy("path", "column_name").agg(
        F.sum("n").alias("row_count"), F.count("value").alias("distinct_values")
    )
    return totals.join(samples, ["path", "column_name"], "left")
