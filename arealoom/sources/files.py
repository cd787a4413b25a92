"""Files as rows: inventories, signatures, hashes, archive members."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealoom.functions.measures import size_mb
from arealoom.functions.text import path_parts
from arealoom.operators.aggregates import rollup_inventory
from arealoom.sources.records import slices

# Folders that are not live data.
ARCHIVE_FOLDERS = ["_archive", "archive", "quarantine"]


def file_inventory(
    spark: SparkSession, root: str, exts=None, exclude_dirs=None, with_content: bool = False
) -> DataFrame:
    """Every file below a folder with an allowed extension, outside archive folders. Without
    ``with_content`` the scan lists files and opens none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    parts = path_parts("path")
    excluded = "|".join(exclude_dirs if exclude_dirs is not None else ARCHIVE_FOLDERS)
    out = files.select(
        "path",
        parts["file_name"].alias("file_name"),
        parts["file_extension"].alias("file_extension"),
        F.col("length").alias("size"),
        size_mb("length").alias("size_mb"),
        "modificationTime",
        *(["content"] if with_content else []),
    )
    if excluded:
        out = out.filter(~F.col("path").rlike(f"/({excluded})/"))
    if exts:
        out = out.filter(F.col("file_extension").isin([e.lower() for e in exts]))
    return out


def sniff_type(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Extension of each file, or its type by signature where there is none."""
    start = F.substring(content, 1, 16)
    text = F.hex(start)
    kind = (
        F.when(F.startswith(text, F.lit("504B")), ".zip_or_xlsx")
        .when(F.startswith(text, F.lit("25504446")), ".pdf")
        .when(text.rlike("^(09|0A|0B|0C|0D|20)*3C"), ".html")
        .otherwise("unknown")
    )
    ext = path_parts(path)["file_extension"]
    return files.withColumn("sniffed_type", F.when(ext != "", ext).otherwise(kind))


def content_hash(files: DataFrame, content: str = "content", size: str = "size", max_size: int | None = None) -> DataFrame:
    """SHA-256 of the bytes; larger files than ``max_size`` stay unhashed."""
    digest = F.sha2(F.col(content), 256)
    if max_size is not None:
        digest = F.when(F.col(size) <= max_size, digest)
    return files.withColumn("sha256", digest)


def content_hash_of(spark: SparkSession, root: str, max_size: int = 2_000_000_000) -> DataFrame:
    """Inventory with hashes. The size filter is pushed to the file source, so files that cannot
    be held as one value are listed but not opened; ``hash_status`` is ``too_large`` for them and
    ``hashed`` for all others."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    hashed = raw.filter(F.col("length") <= max_size).select(
        "path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), F.lit("hashed").alias("hash_status")
    )
    skipped = raw.filter(F.col("length") > max_size).select(
        "path", F.col("length").alias("size"), F.lit(None).cast("string").alias("sha256"), F.lit("too_large").alias("hash_status")
    )
    return hashed.unionByName(skipped)


def same_content(files: DataFrame, content: str = "content", size: str = "size") -> DataFrame:
    """Hashes of the files whose size occurs more than once; others cannot be copies. Bytes are hashed
    where they are read and do not go through the join; the column is left out."""
    shared = files.groupBy(size).agg(F.count("*").alias("__n")).filter("__n > 1").select(size)
    return files.withColumn("sha256", F.sha2(F.col(content), 256)).drop(content).join(shared, size, "left_semi")


_MEMBER_SCHEMA = (
    "path string, member string, member_extension string, size long, compressed_size long, "
    "member_status string, text string"
)

# Member extensions read as tables; other tabular ones are held for review.
READABLE = (".csv", ".tsv", ".txt")
HELD = (".xlsx", ".xls", ".json")


_MEMBER_COLUMNS = [part.split()[0] for part in _MEMBER_SCHEMA.split(", ")]


def _decoded(data: bytes) -> str:
    for encoding in ("utf-8-sig", "cp1252"):
        try:
            return data.decode(encoding)
        except UnicodeDecodeError:
            continue
    return data.decode("latin-1")


def _archive_rows(path: str, content: bytes, with_content: bool) -> Iterator[tuple]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for info in archive.infolist():
                if info.is_dir():
                    continue
                base = info.filename.rsplit("/", 1)[-1]
                ext = "." + base.rsplit(".", 1)[1].lower() if "." in base[1:] else ""
                readable = ext in READABLE
                status = "extracted" if readable else "held" if ext in HELD else "not_tabular"
                data = _decoded(archive.read(info)) if with_content and readable else None
                yield path, info.filename, ext, info.file_size, info.compress_size, status, data
    except zipfile.BadZipFile as error:
        yield path, "", "", 0, 0, f"failed: {error}", None


def _member_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_MEMBER_COLUMNS)
    kinds = [pa.int64() if c in ("size", "compressed_size") else pa.string() for c in _MEMBER_COLUMNS]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _MEMBER_COLUMNS)


def _members(with_content: bool, rows_per_batch: int = 5_000, bytes_per_batch: int = 1 << 22):
    """Members of many small archives share an output batch; a large member closes its batch."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in slices(batches):
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                for row in _archive_rows(path, content, with_content):
                    rows.append(row)
                    held += len(row[-1] or "")
                    if len(rows) >= rows_per_batch or held >= bytes_per_batch:
                        yield _member_batch(rows)
                        rows, held = [], 0
        yield _member_batch(rows)

    return read


def zip_members(files: DataFrame, with_content: bool = True) -> DataFrame:
    """Members of zip archives, one archive at a time on the executors; readable tables come with
    their text."""
    out = files.select("path", "content").mapInArrow(_members(with_content), _MEMBER_SCHEMA)
    return out if with_content else out.drop("text")


def member_lines(members: DataFrame) -> DataFrame:
    """Extracted members as text lines with their position; the first is the header."""
    lines = F.posexplode(F.split(F.regexp_replace("text", "\r?\n$", ""), "\r?\n"))
    return members.filter("member_status = 'extracted'").select("path", "member", lines.alias("line", "value"))


def unpack_members(members: DataFrame, target: str) -> DataFrame:
    """Write each extracted member as one file below ``target/data``, in a folder named by a hash of its
    source. Returns the index of all members (member_id, member_source, member_status)."""
    source = F.concat_ws("!", "path", F.nullif("member", F.lit("")))
    named = members.select(
        F.col("text").alias("value"), source.alias("member_source"), F.sha2(source, 256).alias("member_id"), "member_status"
    )
    named.write.parquet(f"{target}/members")
    stored = members.sparkSession.read.schema(named.schema).parquet(f"{target}/members")
    tables = stored.filter("member_status = 'extracted'").select("value", "member_id")
    tables.write.partitionBy("member_id").text(f"{target}/data")
    return stored.select("member_id", "member_source", "member_status")


def freeze(inventory: DataFrame, register: DataFrame, by: str) -> DataFrame:
    """Snapshot roll-up: files, bytes and hashes per family, against the families registered. Files
    whose ``hash_status`` (where the inventory has it) is ``too_large`` are no hash failures; they
    are counted apart and keep a family from being ready."""
    missing = F.col("sha256").isNull()
    large = missing & F.col("hash_status").eqNullSafe("too_large") if "hash_status" in inventory.columns else F.lit(False)
    rolled = rollup_inventory(inventory, by, "size", ["file_extension"]).join(
        inventory.groupBy(by).agg(
            F.count("sha256").alias("hashed_files"),
            F.count_if(missing & ~large).alias("hash_failures"),
            F.count_if(large).alias("too_large_files"),
        ),
        by,
    )
    known = register.select(by).distinct().withColumn("__known", F.lit(True))
    return rolled.join(known, by, "full").withColumn(
        "freeze_status",
        F.when(F.col("file_count").isNull(), "registered_without_files")
        .when(F.col("__known").isNull(), "files_without_register")
        .when(F.col("hash_failures") > 0, "review_hash_failures")
        .when(F.col("too_large_files") > 0, "review_too_large_files")
        .otherwise("ready"),
    ).drop("__known")
