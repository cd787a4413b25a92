"""Native-geography staging of a folder of raw tables."""

from __future__ import annotations

import hashlib
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arealoom.functions import vocab
from arealoom.functions.labels import classify
from arealoom.operators.aggregates import summarise_status
from arealoom.operators.catalog import unique_names
from arealoom.operators.inventory import apply_hold_rules
from arealoom.operators.joins import spread_join
from arealoom.operators.profiling import geography_from_values
from arealoom.session import col_name, materialise, scratch_path
from arealoom.sources.files import file_inventory, unpack_members, zip_members
from arealoom.sources.sinks import write_by_geography
from arealoom.sources.tables import SOURCE, file_layouts, layout_groups, read_group


def geography_of(columns: list[str]) -> str:
    """Finest geography named by the headers of one table."""
    for level, pattern in vocab.HEADER_LEVELS:
        if any(re.search(pattern, c) for c in columns):
            return level
    return "unknown"


#: Statuses of archive members that are not staged.
MEMBER_STATUSES = [("held", "held_member_not_decoded"), ("not_tabular", "held_member_not_tabular"), ("failed", "held_unreadable_archive")]


def stage_native(
    spark: SparkSession, root: str, target: str, families: list[tuple[str, str]]
) -> DataFrame:
    """Stage every readable table below a folder by its native geography; returns the audit.

    The audit has one row for every file and every archive member, whatever became of it: staged,
    held by a rule, a workbook, an empty table, or an unreadable archive (files of no byte at all are not
    listed by Spark's file sources). Delimited members of zip
    archives are unpacked to the shared scratch folder and staged alike. Encoding, delimiter and header
    of all files come from one pass; files that agree in them are one scan and one write, so the
    driver loops over distinct layouts, not files. The level comes from the headers, else from the
    values of each file. A second run overwrites the tables of the first."""
    return _stage(spark, _ruled(spark, root, families), target, families)


def _ruled(spark: SparkSession, root: str, families) -> DataFrame:
    return apply_hold_rules(file_inventory(spark, root).withColumn("family", classify(F.lower("path"), families, "unknown")))


_STAMP = ["container", "size", "modified"]


def stage_changed(spark: SparkSession, root: str, target: str, families: list[tuple[str, str]]) -> DataFrame:
    """``stage_native`` of the files that are new or have another size or time than at the last run;
    returns the audit of all files that are there now.

    Each run writes a folder of its own and then a manifest: an audit row, with size, time and run, for every
    file and member. The manifest says which run holds the rows of a file, so the rows of a changed
    file, and of one that is gone, are out with the next manifest, and nothing is written over. Files that
    did not change are not opened; where none did, no table is read but the manifest. A run that dies
    leaves the last manifest in force."""
    stamps = _ruled(spark, root, families).withColumnsRenamed({"modificationTime": "modified"})
    now = materialise(stamps, "inventory")
    present = now.select(F.col("path").alias("container"), "size", "modified")
    version, before = last_manifest(spark, target)
    if before is not None:
        fresh = present.join(before.select(*_STAMP).distinct(), _STAMP, "left_anti")
        gone = before.select(*_STAMP).distinct().join(present, _STAMP, "left_anti")
        if fresh.isEmpty() and gone.isEmpty():
            return before.select(*AUDIT)
        kept = before.join(present, _STAMP, "left_semi")
        todo = now.join(fresh.select(F.col("container").alias("path")), "path", "left_semi")
    else:
        kept, todo = None, now
    run = uuid.uuid4().hex
    audit = _stage(spark, todo, f"{target}/run={run}", families)
    container = F.coalesce(F.nullif(F.regexp_extract("path", r"^(.*?\.zip)!", 1), F.lit("")), F.col("path"))
    made = audit.withColumn("container", container).join(present, "container").withColumn("run", F.lit(run))
    rows = made.select(*AUDIT, *_STAMP, "run")
    rows = rows if kept is None else rows.unionByName(kept.select(*rows.columns))
    rows.write.parquet(f"{target}/manifest/version={version + 1:08d}")
    return last_manifest(spark, target)[1].select(*AUDIT)


AUDIT = ["family", "path", "native_geography", "status", "rows", "columns", "reason"]


def last_manifest(spark: SparkSession, target: str) -> tuple[int, DataFrame | None]:
    """Number and rows of the last manifest that was written whole; 0 and None before the first."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/manifest")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/manifest/version=*/_SUCCESS")) or []
    versions = [s.getPath().getParent().getName().split("=")[1] for s in done]
    if not versions:
        return 0, None
    return int(max(versions)), spark.read.parquet(f"{target}/manifest/version={max(versions)}")


def staged_rows(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows of all files that the last manifest names, of whatever layout; None where it names none."""
    rows = last_manifest(spark, target)[1]
    live = [] if rows is None else [r.run for r in rows.filter("status = 'staged'").select("run").distinct().collect()]
    if not live:
        return None
    read = spark.read.option("basePath", target).option("mergeSchema", True).parquet(*[f"{target}/run={r}" for r in sorted(live)])
    current = rows.filter("status = 'staged'").select(F.col("path").alias("source_path"), "run")
    return read.join(current, ["source_path", "run"], "left_semi").drop("run", "layout")


def _stage(spark: SparkSession, inventory: DataFrame, target: str, families) -> DataFrame:
    workbook = (F.col("stage_status") == "process") & ~F.col("file_extension").isin(".csv", ".zip")
    inventory = inventory.withColumns(
        {
            "stage_reason": F.when(workbook, "workbook, not decoded").otherwise(F.col("stage_reason")),
            "stage_status": F.when(workbook, "held_workbook").otherwise(F.col("stage_status")),
        }
    )
    audit = _held(inventory.filter("stage_status <> 'process'"), "path", F.col("stage_status"), F.col("stage_reason"), families)
    todo = inventory.filter("stage_status = 'process'").select("path", "file_extension").collect()
    paths = [unquote(r["path"]) for r in todo if r["file_extension"] == ".csv"]
    archives = [unquote(r["path"]) for r in todo if r["file_extension"] == ".zip"]
    members = None
    if archives:
        unpacked = scratch_path(spark, "members")
        members = unpack_members(zip_members(spark.read.format("binaryFile").load(archives)), unpacked)
        reason = F.coalesce(*[F.when(F.startswith("member_status", F.lit(s)), F.lit(name)) for s, name in MEMBER_STATUSES])
        rest = members.filter("member_status <> 'extracted'")
        audit = audit.unionByName(_held(rest, "member_source", reason, F.col("member_status"), families))
        found = file_inventory(spark, f"{unpacked}/data", exclude_dirs=[]).select("path")
        paths += [unquote(r["path"]) for r in found.collect()]
    if not paths:
        return audit
    layouts = materialise(file_layouts(spark, paths), "layouts")
    empty = layouts.filter("lines < 2").select(F.col("path").alias("source_path"))
    audit = audit.unionByName(
        _held(_with_member_source(empty, members), "source_path", F.lit("held_empty_table"), F.lit("no row below the header"), families)
    )
    for key, group in layout_groups(layouts.filter("lines > 1")).items():
        audit = audit.unionByName(_stage_group(spark, key, group, members, target, families))
    return audit


def _held(rows: DataFrame, path: str, status, reason, families) -> DataFrame:
    return rows.select(
        classify(F.lower(path), families, "unknown").alias("family"), F.col(path).alias("path"),
        F.lit("").alias("native_geography"), status.alias("status"), F.lit(0).cast("long").alias("rows"),
        F.lit(0).alias("columns"), reason.alias("reason"),
    )


def _stage_group(spark, key: tuple, paths: list[str], members, target: str, families) -> DataFrame:
    """Write the files of one layout and header, one folder for each level; audit rows by file."""
    separator, encoding, multi_line, _ = key
    raw = read_group(spark, paths, separator, encoding, multi_line, with_source=True)
    headers = [c for c in raw.columns if c != SOURCE]
    names = unique_names(headers)
    cells = [F.nullif(F.trim(F.col(col_name(c))), F.lit("")).alias(n) for c, n in zip(headers, names)]
    placed = raw.select(*cells, F.col(SOURCE).alias("source_path")).dropna("all", subset=names)
    level = geography_of(names)
    if level == "unknown":
        levels = geography_from_values(placed, names, by="source_path").select("source_path", "native_geography")
        leveled = spread_join(placed, levels, [(F.col("source_path"), "source_path")])
        leveled = leveled.withColumn("native_geography", F.coalesce("native_geography", F.lit("unknown")))
    else:
        leveled = placed.withColumn("native_geography", F.lit(level))
    tagged = _with_member_source(leveled, members).select(
        classify(F.lower("source_path"), families, "unknown").alias("source_family"), "source_path", *names, "native_geography"
    )
    digest = hashlib.sha256(repr((key, names)).encode()).hexdigest()
    out = f"{target}/layout={digest}"
    write_by_geography(tagged, out)
    return (
        spark.read.schema(tagged.schema).parquet(out)
        .groupBy("source_family", "source_path", "native_geography")
        .agg(F.count("*").alias("rows"))
        .select(
            F.col("source_family").alias("family"), F.col("source_path").alias("path"),
            F.when(F.col("native_geography") == "unknown_review", "unknown").otherwise(F.col("native_geography")).alias("native_geography"),
            F.lit("staged").alias("status"), "rows", F.lit(len(names)).alias("columns"), F.lit("").alias("reason"),
        )
    )


def _with_member_source(df: DataFrame, members: DataFrame | None) -> DataFrame:
    """Name unpacked members by their archive and member; other paths stay."""
    if members is None:
        return df
    index = members.filter("member_status = 'extracted'").select("member_id", "member_source")
    member = F.regexp_extract("source_path", "/member_id=([^/]+)/", 1)
    return df.join(index, member == F.col("member_id"), "left").withColumn(
        "source_path", F.coalesce("member_source", "source_path")
    ).drop("member_id", "member_source")


def staging_summary(audit: DataFrame) -> DataFrame:
    return summarise_status(audit, ["family", "native_geography", "status"], "path", "rows", "columns")
