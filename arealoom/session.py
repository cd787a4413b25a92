"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, memory: str = "8g", app: str = "arealoom") -> SparkSession:
    """A single-machine session for tests and benches; a cluster passes its own session in."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``. Where it is unset, a
    temporary folder on a single machine, and an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new place in the folder of this application below the scratch folder."""
    return f"{scratch_root(spark)}/arealoom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove all that this application left in the scratch folder; for when its results are written."""
    drop_path(spark, f"{scratch_root(spark)}/arealoom/{spark.sparkContext.applicationId}")
    _WRITTEN.clear()


#: Tables that ``materialise`` wrote, in their order.
_WRITTEN: list[str] = []


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a table to the shared scratch folder and read it back: cuts lineage and survives a
    lost executor, which cached blocks do not."""
    path = scratch_path(df.sparkSession, label)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str, rows: int) -> DataFrame:
    """A table dealt over tasks by a key, about ``rows`` in each, for a step that makes much of every row.

    Scans are cut by the bytes of files, which tell little of what comes out of short rows: a small file is
    the work of one task or two. One count of the rows, which Parquet has in its footers, decides."""
    return df.repartition(max(1, math.ceil(df.count() / rows)), key)


class Steps:
    """Steps that each read the table of the one before: ``write`` makes the table of a step, then removes
    what the step itself had written, and the table of the step before, which nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.last = spark, None

    def write(self, step, label: str) -> DataFrame:
        mark = len(_WRITTEN)
        table = materialise(step(), label)
        path = _WRITTEN.pop()
        done = _WRITTEN[mark:] + ([self.last] if self.last else [])
        del _WRITTEN[mark:]
        for old in done:
            drop_path(self.spark, old)
        self.last = path
        return table


class Scratch:
    """Tables that live as long as a ``with`` block: ``materialise`` for what only the block reads.

    What a block gives back must not read them any more when it is evaluated."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def table(self, df: DataFrame, label: str = "stage") -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        for path in self.paths:
            drop_path(self.spark, path)


def col_name(name: str) -> str:
    """Quote a column name so dots and spaces in source headers are taken literally."""
    return "`" + name.replace("`", "``") + "`"
