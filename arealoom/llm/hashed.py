"""Hashed token features of texts and linear scores over them, shared by the text classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealoom.llm.words import _BYTE_VALUES, _hash_spans, find_words, LOWER, NOT_ALNUM, release, slices, WHITE_SPACE
from arealoom.operators.joins import spread_join

BITS = 18
#: Labels that a model of few classes may have.
MOST_LABELS = 64
BUCKETS = 1 << BITS


def _bucket(hashes: np.ndarray, salt: int) -> np.ndarray:
    return ((hashes ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)


def terms(data: np.ndarray, bounds: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of each word (lowered) and of its first five bytes; the first word of each row."""
    words = find_words(data, bounds, NOT_ALNUM, LOWER) if len(data) == 0 else find_words(LOWER[data], bounds, NOT_ALNUM)
    stems = _hash_spans(LOWER[data], words.starts, np.minimum(words.ends, words.starts + 5), _BYTE_VALUES)
    return [_bucket(words.hashes, 1), _bucket(stems, 2)], words.first


#: Bytes by kind: capitals, small letters and all beyond ASCII, digits; other characters stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x41:0x5B], _SHAPE[0x61:0x7B], _SHAPE[0x80:], _SHAPE[0x30:0x3A] = 0x41, 0x61, 0x61, 0x30


def styles(data: np.ndarray, bounds: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets of each word, of the shapes of its first and last three bytes, and of whether it repeats
    the word before it; the first word of each row."""
    words = find_words(data, bounds, WHITE_SPACE)
    values = _BYTE_VALUES[_SHAPE]
    head = _hash_spans(data, words.starts, np.minimum(words.ends, words.starts + 3), values)
    tail = _hash_spans(data, np.maximum(words.starts, words.ends - 3), words.ends, values)
    again = np.zeros(len(words.hashes), np.uint64)
    again[1:] = words.hashes[1:] == words.hashes[:-1]
    begins = words.first[:-1][np.diff(words.first) > 0]
    again[begins] = 2
    return [_bucket(words.hashes, 3), _bucket(head, 4), _bucket(tail, 5), _bucket(again, 6)], words.first


def bag(features: list[np.ndarray], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one row and how often each occurs."""
    return np.unique(np.concatenate([f[low:high] for f in features]), return_counts=True)


def row_sums(features: list[np.ndarray], first: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The sum of the weights of all features of each row."""
    out = np.zeros(len(first) - 1)
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        for feature in features:
            out[some] += np.add.reduceat(weights[feature], first[:-1][some])
    return out


def least_rows(rows: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """The ``n`` rows of each group whose keys have the least hashes, with their place ``n``.

    Groups are counted first; a hash threshold then leaves about four times the rows wanted of each,
    so the window that ranks them is small however many rows a group has. Groups must be few."""
    place = F.xxhash64(key) / float(1 << 64) + 0.5
    counts = rows.groupBy(group).agg(F.count("*").alias("_all"))
    near = spread_join(rows.withColumn("_place", place), counts, [(F.col(group), group)], "inner")
    near = near.filter((F.col("_all") <= 16 * n) | (F.col("_place") * F.col("_all") <= 4 * n))
    order = Window.partitionBy(group).orderBy("_place", key)
    return near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= n).drop("_place", "_all")


def sample_bags(labels: DataFrame, texts: DataFrame, key: str, label: str, text: str, make, per_label: int) -> list[tuple]:
    """(label, key, buckets, counts) of at most ``per_label`` rows of each label: those of the least key
    hashes, chosen from the labels alone before any text is read. More than ``MOST_LABELS`` labels are an
    error, so what is broadcast (keys and labels) and what comes to the driver (bags of at most
    ``BUCKETS`` entries) is bounded; null keys, labels and texts are not used."""
    rated = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label")).filter("key IS NOT NULL AND label IS NOT NULL")
    if rated.select("label").distinct().limit(MOST_LABELS + 1).count() > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    chosen = least_rows(rated, "label", "key", per_label).select("key", "label").distinct()
    rows = texts.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in slices(batch.column(2)):
                features, first = make(data, bounds)
                made = [bag(features, first[i], first[i + 1]) for i in range(high - low)]
                columns = [pa.array([x.astype(kind).tobytes() for x in side], pa.binary()) for side, kind in zip(zip(*made, strict=True), ("<u4", "<u4"), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.slice(low, high - low).columns[:2], *columns], ["label", "key", "buckets", "counts"])
        release()

    # at most per_label rows of each of MOST_LABELS labels
    sample = rows.join(F.broadcast(chosen), "key").dropDuplicates(["key", "label"]).select("label", F.col("key").cast("string").alias("key"), "text")
    kind = sample.schema["label"].dataType.simpleString()
    found = sample.mapInArrow(run, f"label {kind}, key string, buckets binary, counts binary").collect()
    found.sort(key=lambda row: (str(row.label), row.key))
    return [(r.label, r.key, np.frombuffer(r.buckets, "<u4").astype(np.int64), np.frombuffer(r.counts, "<u4").astype(float)) for r in found]


def add_columns(df: DataFrame, text: str, fields: list[tuple[str, T.DataType]], work) -> DataFrame:
    """Add columns that ``work`` makes from the bytes and bounds of ``text``; columns of these names are
    replaced, all others pass."""
    names = [name for name, _ in fields]
    keep = [i for i, f in enumerate(df.schema.fields) if f.name not in names]
    column = df.columns.index(text)
    schema = T.StructType([*[df.schema.fields[i] for i in keep], *[T.StructField(n, kind) for n, kind in fields]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in slices(batch.column(column)):
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in keep], *work(data, bounds)], [*[batch.schema.names[i] for i in keep], *names]
                )
        release()

    return df.mapInArrow(run, schema)
