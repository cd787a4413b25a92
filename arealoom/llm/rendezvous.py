"""Rendezvous hashing of record keys over weighted shards, with DataFrame functions only.

Every (key, shard) pair has a hash; the key goes to the shard of the least ``-ln(hash) / weight``.
Adding a shard changes no other pair, so it only takes keys into itself, in proportion to its
weight; taking one away moves only its own keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Numbering blocks in a shard, by three hexadecimal digits of the key's hash.
BLOCK_DIGITS = 3
#: Copies of one row that a task numbers at a time.
COPIES = 65536


def _unit(text: Column) -> Column:
    """A number between 0 and 1 from 52 bits of a hash, ends left out."""
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit(""))


def shard_of(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key. A null key counts as the empty string; equal scores (practically none) go
    to the smaller shard number."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("weights must be positive and there must be a shard")
    shards = F.array(*[F.struct(F.lit(int(s)).alias("id"), F.lit(float(w)).alias("weight")) for s, w in sorted(weights.items())])
    scored = F.transform(
        shards,
        lambda s: F.struct(
            (-F.log(_unit(F.concat_ws("/", key_text(key), s["id"].cast("string")))) / s["weight"]).alias("score"), s["id"].alias("id")
        ),
    )
    return F.array_min(scored)["id"]


def assign(df: DataFrame, key: str, weights: Mapping[int, float], shard: str = "shard") -> DataFrame:
    """Add the shard of each row: one pass without a shuffle. A column of that name is replaced. Rows
    with equal keys share a shard; an empty table stays empty."""
    return df.withColumn(shard, shard_of(F.col(f"`{key}`"), weights))


def number(df: DataFrame, key: str, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in the order of the key's hash block, the
    key and the other columns (nulls first).

    Rows are counted per distinct row first, so a row repeated any number of times is one row in the
    shuffles; its copies are made in parts of ``COPIES`` after the numbering. No task holds more
    than one block of a shard. Columns must be sortable; long texts should be hashed before. A column
    named like the slot is replaced.
    """
    df = df.drop(slot) if slot != key else df
    named = df.columns
    df = df.toDF(*[c if c in (key, shard) else f"c{i}" for i, c in enumerate(named)])
    if {"_block", "_n", "_before", "_part", "_start", "_copy"} & {key, shard, slot}:
        raise ValueError("the key, shard and slot must not be named like the numbering's own columns")
    others = [c for c in df.columns if c not in (key, shard)]
    block = F.substring(F.md5(key_text(F.col(f"`{key}`"))), 1, BLOCK_DIGITS)
    cells = df.withColumn("_block", block).groupBy(shard, "_block", *[f"`{c}`" for c in [key, *others]]).agg(F.count("*").alias("_n"))
    in_block = Window.partitionBy(shard, "_block").orderBy(*[F.col(f"`{c}`") for c in [key, *others]])
    cells = cells.withColumn("_start", F.sum("_n").over(in_block.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n"))
    totals = df.withColumn("_block", block).groupBy(shard, "_block").agg(F.count("*").alias("_before"))
    along = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_before").over(along), F.lit(0)))
    parts = (
        cells.join(totals, [shard, "_block"])
        .withColumn("_part", F.explode(F.expr(f"sequence(0L, (_n - 1) div {COPIES})")))
        .repartition(shard, "_block", "_part")
    )
    last = F.least(F.col("_n"), (F.col("_part") + 1) * COPIES) - 1
    copies = parts.withColumn("_copy", F.explode(F.sequence(F.col("_part") * COPIES, last)))
    return copies.select(*[F.col(f"`{c}`").alias(name) for c, name in zip(df.columns, named, strict=True)], (F.col("_before") + F.col("_start") + F.col("_copy")).alias(slot))


def moved(df: DataFrame, key: str, before: Mapping[int, float], after: Mapping[int, float]) -> DataFrame:
    """Rows by shard before and after a change of the shards: what the change moves."""
    column = F.col(f"`{key}`")
    return df.select(shard_of(column, before).alias("from_shard"), shard_of(column, after).alias("to_shard")).groupBy("from_shard", "to_shard").count()


def write_shards(df: DataFrame, key: str, weights: Mapping[int, float], path: str) -> None:
    """Write the rows under one folder per shard; each task writes its own files, so a large shard is
    written by many tasks."""
    assign(df, key, weights).write.mode("overwrite").partitionBy("shard").parquet(path)
