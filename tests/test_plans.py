"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from arealoom.checks import QUERIES
from arealoom.checks.registry import table
from arealoom.operators import bridges as B
from arealoom.operators import joins as J
from arealoom.operators import windows as W
from arealoom.operators.bridges import allocate, dominant
from arealoom.operators.period import select_period


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q[:3] not in ("src", "snk", "stm", "aud", "str")))
def test_no_pairing_of_whole_tables(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)


def test_first_of_group_is_cut_before_its_shuffle(spark, sf):
    lines = table(spark, sf, "lineitem")
    text = plan(W.dedupe_first(lines, "l_orderkey", [F.col("l_linenumber"), F.col("l_partkey")]))
    assert text.rindex("WindowGroupLimit") > text.index("Exchange hashpartitioning")


def test_scans_read_only_what_is_needed(spark, sf):
    lines = table(spark, sf, "lineitem")
    text = plan(dominant(lines, "l_orderkey", "l_suppkey", "l_quantity"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double>" in text
    orders = table(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    chosen = plan(select_period(orders.select("o_orderkey", "d"), "d", target="1998-12-31"))
    assert "o_totalprice" not in chosen


def test_filters_reach_the_scan(spark, sf):
    orders = table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey").count()
    assert "EqualTo(o_orderstatus,F)" in plan(orders)


def test_a_key_with_a_third_of_the_rows(spark):
    """A hot source code, and a hot target, give the same totals as a plain computation."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500)
    edges = spark.range(30_000).select(
        hot.alias("f"), F.when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).alias("t"), F.lit(0.5).alias("r")
    ).dropDuplicates(["f", "t"])
    values = spark.range(500).select(F.col("id").alias("f"), F.col("id").cast("double").alias("v"))
    got = allocate(values, edges, "f", "t", "r", ["v"]).agg(F.sum("v"), F.sum("contributing_edges")).first()
    want = edges.join(values, "f").agg(F.sum(F.col("v") * F.col("r")), F.count("*")).first()
    assert tuple(got) == tuple(want)


def test_ffill_of_a_hot_partition(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("p"), F.col("id").alias("n"),
        F.when(F.col("id") % 997 == 0, F.col("id")).alias("v"),
    )
    filled = W.ffill(df, "p", "n", ["v"], block=256)
    assert filled.count() == 20_000
    assert filled.filter("p = -1 and n >= 2991 and v is null").count() == 0


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
        # AQE's bounds for hot partitions are made for full-size data; these fit the table of the tests
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=60_000):
    """Rows of which four fifths have one key."""
    key = F.when(F.col("id") % 5 < 4, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 400).cast("string")))
    return spark.range(n).select("id", key.alias("k"), (F.col("id") % 7).cast("string").alias("t"), F.lit(1.0).alias("v"))


SPREAD = {
    "flag_split": lambda df: B.flag_split(df, "k", "t"),
    "share_of_total": lambda df: B.share_of_total(df, "k", ["t", "id"], "v"),
    "flag_membership": lambda df: J.flag_membership(df, df.select("k"), "k", "member"),
    "lookup_any": lambda df: J.lookup_any(df, df.select("k", F.col("id").alias("o"), F.col("t").alias("u")), [(F.col("k"), F.col("k"))], "o", ["u"]),
    "allocate": lambda df: _edges_of_allocation(df),
    "fallback_join": lambda df: J.fallback_join(df, df.select(F.col("k").alias("x"), F.upper("k").alias("y")).distinct(), ("k", "x"), ("t", "y")),
    "reconcile_paths": lambda df: J.reconcile_paths(
        df.withColumnRenamed("k", "path"), df.select(F.col("k").alias("path"), F.lit(True).alias("active")).distinct(),
        df.select(F.col("t").alias("source_path"), F.col("k").alias("destination_path")).limit(5),
    ),
    "repeated_rows": lambda df: J.flag_membership(df.select("k"), df.select("k"), "k", "member"),
    "lookup_manifest": lambda df: J.lookup_manifest(df, df.select(F.col("k").alias("p"), F.col("t").alias("w"), F.col("id").alias("o")), "k", "p", "w", "o"),
}


def _edges_of_allocation(df):
    """The join of ``allocate`` on its own: its sum per target comes after."""
    split = df.select("k", "t").distinct().groupBy("k").agg((F.count("t") > 1).alias("split"))
    values = df.select("k").distinct().withColumn("n", F.lit(1.0)).join(split, "k")
    return J.spread_join(df, values, [(F.col("k"), "k")], "inner")


def test_a_join_onto_an_aggregate_reads_what_is_used(spark, tmp_path, no_broadcast):
    wide = spark.range(1000).select(F.col("id"), (F.col("id") % 9).alias("k"), *[F.lit("x" * 20).alias(f"c{i}") for i in range(30)])
    wide.write.parquet(str(tmp_path / "wide"))
    read = spark.read.parquet(str(tmp_path / "wide"))
    flagged = J.flag_membership(read, spark.range(5).select(F.col("id").alias("k")), "k", "member").select("id", "member")
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,k:bigint>" in plan


def test_keys_of_several_types_meet(spark, no_broadcast):
    left = spark.createDataFrame([(1, 5), (2, 6)], "n int, k int")
    right = spark.createDataFrame([(5, "a"), (None, "b")], "k long, x string")
    assert sorted((r.n, r.x) for r in J.spread_join(left, right, [(F.col("k"), "k")]).collect()) == [(1, "a"), (2, None)]


def test_path_ends_with_name(spark):
    names = spark.createDataFrame([(1, "b.csv"), (2, "zz"), (3, None), (4, ""), (5, "a/b.csv")], "n int, name string")
    paths = spark.createDataFrame([(7, "x/ab.csv"), (8, "b.csv"), (9, None), (10, "q/a/b.csv")], "o int, path string")
    found = J.lookup_any(names, paths, [], "o", ["o"], suffixes=[("name", "path")])
    assert sorted((r.n, r.o) for r in found.collect()) == [(1, 7), (2, None), (3, None), (4, None), (5, 10)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", sorted(SPREAD))
def test_a_hot_key_is_dealt_over_tasks(spark, no_broadcast, name):
    df = hot(spark)
    out = SPREAD[name](df)
    # the hash uses all columns, so that none and no join is left out
    tasks = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(F.xxhash64("*"))).collect()]
    assert sum(tasks) == df.count()
    assert max(tasks) < 0.35 * sum(tasks)


def test_spread_join_is_a_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (3, "b")], "n int, k string")
    right = spark.createDataFrame([("a", 10), (None, 20), ("c", 30)], "k string, x int")
    got = sorted((r.n, r.k or "", r.x or 0) for r in J.spread_join(left, right, [(F.col("k"), "k")]).collect())
    assert got == [(1, "a", 10), (2, "", 0), (3, "b", 0), (3, "b", 0)]


def test_steps_leave_the_last_table_only(spark):
    import os

    from arealoom.session import Steps, drop_scratch, materialise, scratch_root

    folder = f"{scratch_root(spark)}/arealoom/{spark.sparkContext.applicationId}"
    drop_scratch(spark)
    steps, table = Steps(spark), spark.range(5)
    for i in range(3):
        table = steps.write(lambda: materialise(table.filter(f"id <> {i}"), "aside").select("id"), f"step{i}")  # noqa: B023
    assert sorted(r.id for r in table.collect()) == [3, 4]
    assert [n.split("-")[0] for n in os.listdir(folder)] == ["step2"]
    drop_scratch(spark)
    assert not os.path.exists(folder)
