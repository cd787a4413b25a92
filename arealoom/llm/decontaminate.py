"""Benchmark decontamination by a prefix-filtered set join.

Every item window is a set of word shingles that a document must hold in full, so one necessary
token is enough as its prefix: the shingle that is rarest in the whole corpus. Documents meet the
windows on these tokens only; the position of the token gives the only place where the window can
stand, length and position bound it, and the words there decide exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealoom.llm.words import LOWER, NOT_ALNUM, Words, find_words, gather, release, slices, window_hashes
from arealoom.session import materialise

#: Bits of the filter of wanted tokens. Its size is fixed; more tokens only let more rows through.
FILTER_BITS = 1 << 24


def _words(data: np.ndarray, bounds: np.ndarray) -> Words:
    return find_words(LOWER[data], bounds, NOT_ALNUM)


def _joined(data: np.ndarray, words: Words, index: np.ndarray, groups: np.ndarray) -> pa.Array:
    """The words ``index``, each followed by a space, as one string per group of words."""
    padded = np.append(LOWER[data], np.uint8(0x20))
    text, ends = gather(padded, words.starts[index], words.ends[index] - words.starts[index] + 1)
    text[ends[1:] - 1] = 0x20
    if len(text) >= 1 << 31:
        raise ValueError("the words around the hits of one slice take over 2 GiB")
    return pa.Array.from_buffers(pa.string(), len(groups) - 1, [None, pa.py_buffer(ends[groups].astype(np.int32)), pa.py_buffer(text)])


def _spread(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive numbers and their bounds."""
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], lengths), bounds


def item_windows(items: DataFrame, item_id: str, text: str, width: int, shingle: int) -> DataFrame:
    """Distinct windows with the items they come from: ``window`` (words, each followed by a space),
    ``width``, ``items``, and the shingles as ``tokens`` (hash, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in slices(batch.column(1)):
                words = _words(data, bounds)
                counts = np.diff(words.first)
                widths = np.minimum(counts, width)
                rows = np.repeat(np.arange(high - low), np.where(counts > 0, counts - widths + 1, 0))
                within = np.arange(len(rows)) - np.searchsorted(rows, rows)
                starts, widths = words.first[:-1][rows] + within, widths[rows]
                index, groups = _spread(starts, widths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low).take(pa.array(rows)), _joined(data, words, index, groups), pa.array(widths, pa.int32())],
                    ["item", "window", "width"],
                )
        release()

    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    windows = rows.mapInArrow(run, "item string, window string, width int")
    distinct = windows.groupBy("window", "width").agg(F.sort_array(F.collect_set("item")).alias("items"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in slices(batch.column(0)):
                words = _words(data, bounds)
                counts = np.diff(words.first)
                made = [
                    [
                        {"token": int(t), "place": i}
                        for i, t in enumerate(window_hashes(words.hashes[words.first[r] : words.first[r + 1]], min(shingle, counts[r])).view(np.int64))
                    ]
                    for r in range(high - low)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(low, high - low).columns, pa.array(made, pa.list_(pa.struct([("token", pa.int64()), ("place", pa.int32())])))],
                    [*batch.schema.names, "tokens"],
                )
        release()

    return distinct.mapInArrow(tokens, "window string, width int, items array<string>, tokens array<struct<token: bigint, place: int>>")


def token_filter(tokens: DataFrame):
    """A broadcast bit set of the column ``token``; at most ``FILTER_BITS`` bits come to the driver."""
    place = F.expr(f"token & {FILTER_BITS - 1}")
    rows = tokens.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(token & 63))")).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    for row in rows:
        bits[row.word] = np.int64(row.bits).view(np.uint64)
    return tokens.sparkSession.sparkContext.broadcast(bits)


def _hits(words: Words, bits: np.ndarray, shingles: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each shingle width the words at which a wanted shingle may start, and its hash."""
    for k in shingles:
        hashes = window_hashes(words.hashes, k)
        place = hashes & np.uint64(FILTER_BITS - 1)
        wanted = (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)
        at = np.flatnonzero(wanted)
        at = at[words.window_ok(k)[at]] if len(at) else at
        yield at, hashes[at].view(np.int64)


def token_counts(docs: DataFrame, text: str, wanted, shingles: list[int]) -> DataFrame:
    """How often each wanted shingle stands in the whole corpus: ``token``, ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            found = []
            for _, _, data, bounds in slices(batch.column(0)):
                found += [hashes for _, hashes in _hits(_words(data, bounds), bits, shingles)]
            tokens, counts = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(counts)], ["token", "n"])
        release()

    return docs.select(text).mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def candidates(docs: DataFrame, text: str, wanted, shingles: list[int], reach: int) -> DataFrame:
    """Every row of ``docs`` with its number of words and, for each wanted shingle in it, the hash,
    the place and up to ``reach`` words on either side."""
    spot = pa.struct([("token", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("near", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            column = batch.schema.get_field_index(text)
            keep = [i for i in range(batch.num_columns) if i != column]
            for low, high, data, bounds in slices(batch.column(column)):
                words = _words(data, bounds)
                found = list(_hits(words, bits, shingles))
                at, tokens = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.argsort(at, kind="stable")
                at, tokens = at[order], tokens[order]
                row = np.searchsorted(words.first, at, side="right") - 1
                left = np.minimum(at - words.first[row], reach)
                right = np.minimum(words.first[row + 1] - at, reach + 1)
                index, groups = _spread(at - left, left + right)
                near = _joined(data, words, index, groups)
                spots = pa.StructArray.from_arrays(
                    [pa.array(tokens), pa.array(at - words.first[row], pa.int32()), pa.array(left, pa.int32()), near], fields=list(spot)
                )
                offsets = np.searchsorted(row, np.arange(high - low + 1)).astype(np.int32)
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in keep], pa.array(np.diff(words.first)), pa.ListArray.from_arrays(pa.array(offsets), spots)],
                    [*[batch.schema.names[i] for i in keep], "n_words", "spots"],
                )
        release()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)
    return docs.mapInArrow(run, f"{fields}, n_words bigint, spots array<struct<token: bigint, at: int, before: int, near: string>>")


def mark(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    width: int = 13, shingle: int = 3,
) -> DataFrame:
    """Which words of each document stand in an occurrence of an item window.

    Words are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lowered.
    A window is ``width`` consecutive words of an item; an item of fewer words is one window, one of
    none has no window. Returns one row per document row: ``doc_id``, ``doc_print`` (hash of the
    text; with ``doc_id`` it names the document), ``n_words``, ``n_hit``, ``items`` (the ids as
    sorted strings), ``spans`` (first and past-last word of each occurrence).

    Null and empty texts have no words. A null item id counts as an item without a name: its windows
    hit but are not listed. Repeated rows of a document each get the same result, as do documents
    under one id each for their own text. Without items nothing is hit. Other columns, whatever
    their names, are not read.
    """
    reach = max(width, shingle) - 1
    windows = materialise(item_windows(items, item_id, item_text, width, shingle), "windows")
    exploded = windows.select("window", F.explode("tokens").alias("t")).select("window", "t.token", "t.place")
    shingles = sorted({min(shingle, row.width) for row in windows.select("width").distinct().collect()}) or [shingle]
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("doc_print"), F.col(f"`{text}`").alias("text"))
    counts = token_counts(texts, "text", token_filter(exploded), shingles)
    rarest = (
        exploded.join(counts, "token", "left")
        .groupBy("window")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "place")).alias("prefix"))
        .filter("prefix.n > 0")
        .select("window", "prefix.token", "prefix.place")
    )
    prefixes = materialise(rarest.join(windows.select("window", "width", "items"), "window"), "prefixes")
    rows = materialise(candidates(texts, "text", token_filter(prefixes), shingles, reach), "candidates")
    key = ["doc_id", "doc_print"]
    spots = rows.filter(F.size("spots") > 0).select(*key, "n_words", F.explode("spots").alias("s")).select(*key, "n_words", "s.*").distinct()
    start = F.col("at") - F.col("place")
    here = F.slice(F.split("near", " "), F.greatest(F.col("before") - F.col("place"), F.lit(0)) + 1, F.col("width"))
    hits = (
        spots.join(prefixes, "token")
        .filter((start >= 0) & (start + F.col("width") <= F.col("n_words")))
        .filter(F.concat_ws(" ", here, F.lit("")) == F.col("window"))
        .select(*key, start.alias("start"), (start + F.col("width")).alias("end"), "items")
    )
    along = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(along), F.col("start"))))
    found = (
        hits.withColumn("fresh", fresh)
        .groupBy(*key)
        .agg(
            F.sum("fresh").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"),
        )
        .select(F.col("doc_id").alias("_id"), F.col("doc_print").alias("_print"), "n_hit", "items", "spans")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("doc_print").eqNullSafe(F.col("_print"))
    return rows.select(*key, "n_words").join(found, same, "left").select(
        *key,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start: int, end: int>>")).alias("spans"),
    )


def contaminated(percent: int = 5) -> Column:
    """Whether at least ``percent`` of the words of a marked document are hit, and one at least."""
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))


def clean(docs: DataFrame, items: DataFrame, percent: int = 5, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose document is not contaminated."""
    bad = mark(docs, items, doc_id, text, **options).filter(contaminated(percent)).select(F.col("doc_id").alias("_id"), "doc_print").distinct()
    bad = materialise(bad, "contaminated")
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("doc_print"))
    return docs.join(bad, same, "left_anti")
