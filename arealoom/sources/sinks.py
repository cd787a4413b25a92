"""Writers. A table written in two formats is computed once: the second copy is read back from
the first."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from arealoom.operators.audit import Check, ContractError, status_of
from arealoom.operators.catalog import with_source_metadata
from arealoom.sources.files import file_inventory
from arealoom.sources.tables import read_table


def write_pair(df: DataFrame, base: str, mode: str = "errorifexists") -> DataFrame:
    """Parquet and CSV copies of a table; returns the written Parquet."""
    df.write.mode(mode).parquet(base + ".parquet")
    written = df.sparkSession.read.schema(df.schema).parquet(base + ".parquet")
    written.write.mode(mode).option("header", True).option("escape", '"').csv(base + ".csv")
    return written


def publish_checked(df: DataFrame, path: str, checks: list[Check], keys: list[str] | str | None = None, partition_by=()) -> DataFrame:
    """Write a table and check it in one job; publish it only if no check fails. Returns the audit.

    The checks are metrics that Spark gathers while the rows are written to a folder beside ``path``,
    which takes the name ``path`` afterwards. A failed check leaves nothing behind and raises with the
    failures. Checks are aggregates without DISTINCT (Spark observes no others). With ``keys`` the rows
    are dealt by their key before they are written, so that a repeated or null key shows beside its twin:
    ``repeated_keys`` and ``null_keys`` are checked too. An existing ``path`` is an error."""
    spark = df.sparkSession
    checks, out = list(checks), df
    if keys:
        names = [keys] if isinstance(keys, str) else list(keys)
        missing = F.lit(False)
        for name in names:
            missing = missing | F.col(name).isNull()
        place = Window.partitionBy(*names).orderBy(F.lit(0))
        out = out.withColumn("__again", (F.row_number().over(place) > 1) & ~missing).withColumn("__missing", F.lit(False) | missing)
        zero = lambda v: v == 0
        checks += [Check("null_keys", F.count_if("__missing"), zero), Check("repeated_keys", F.count_if("__again"), zero)]
    seen = Observation()
    values = [c.value.cast("double") for c in checks]
    metrics = [F.struct(v.alias("value"), status_of(c, v).alias("status")).alias(f"c{i}") for i, (c, v) in enumerate(zip(checks, values, strict=True))]
    fs, target = _folder(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    staged = f"{path.rstrip('/')}-unpublished-{uuid.uuid4().hex}"
    out.observe(seen, F.count("*").alias("written"), *metrics).drop("__again", "__missing").write.partitionBy(*partition_by).parquet(staged)
    found = [seen.get[f"c{i}"] for i in range(len(checks))]
    failed = [f"{c.name} = {f['value']}" for c, f in zip(checks, found, strict=True) if f["status"] == "fail"]
    if failed:
        fs.delete(_folder(spark, staged)[1], True)
        raise ContractError(f"not published: {', '.join(failed)}")
    if not fs.rename(_folder(spark, staged)[1], target):
        raise OSError(f"cannot publish {path}")
    rows = [(c.name, f["value"], f["status"], c.notes) for c, f in zip(checks, found, strict=True)]
    return spark.createDataFrame(rows, "check_name string, value double, status string, notes string")


def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def write_by_geography(
    df: DataFrame, base: str, geography: str = "native_geography", mode: str = "overwrite"
) -> None:
    """One folder per geography; an unknown one goes to review. A second run replaces the first.

    Rows keep the partitioning they come with, so a geography that holds most of the rows is
    written by all tasks."""
    level = F.col(geography)
    routed = F.when(level.isNull() | (level == "unknown"), "unknown_review").otherwise(level)
    df.withColumn(geography, routed).write.mode(mode).partitionBy(geography).parquet(base)


def stage_existing(
    spark: SparkSession, candidates: dict[str, list[str]], family: str, geography: str, base: str
) -> list[tuple[str, str, str]]:
    """Copy already processed tables into the native layer: per table the first candidate that
    exists. Returns (table, path, status); a table without any is ``not_found``."""
    log = []
    for table, paths in candidates.items():
        found = None
        for path in paths:
            try:
                found = (path, read_table(spark, path))
                break
            except FileNotFoundError:
                continue
        if found is None:
            log.append((table, "", "not_found"))
            continue
        tagged = with_source_metadata(found[1], family, found[0], table)
        tagged.write.mode("errorifexists").parquet(f"{base}/native_geography={geography}/table={table}")
        log.append((table, found[0], "staged"))
    return log


def table_index(spark: SparkSession, root: str) -> DataFrame:
    """Rows, files and size of every geography folder of the native layer. Row counts come from
    Parquet footers: the count reads no column."""
    rows = (
        spark.read.option("basePath", root).option("mergeSchema", False).parquet(root)
        .groupBy("native_geography").agg(F.count("*").alias("table_rows"))
    )
    files = (
        file_inventory(spark, root, [".parquet"])
        .withColumn("native_geography", F.regexp_extract("path", "native_geography=([^/]+)", 1))
        .groupBy("native_geography")
        .agg(F.count("*").alias("file_count"), F.sum("size").alias("size"))
    )
    return rows.join(files, "native_geography")
