"""Near-duplicate documents by MinHash bands and odd sketches.

The MinHash samples of a shingle set are folded into a bitmap by parity: each sample flips one bit.
Samples that two sets share cancel in the XOR of their bitmaps, so its population count tells how
many samples differ, most precisely where few do. Bands of samples bring documents together, the
sketches sort out who is worth a look, and full shingle sets decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealoom.llm.words import LOWER, WHITE_SPACE, find_words, mix, release, slices, window_hashes
from arealoom.session import Scratch, materialise

#: Samples; bands of rows use all of them. A pair of similarity 0.8 shares no band with probability
#: (1 - 0.8**4)**32, about 5e-8.
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
#: Bits of a sketch, in 64-bit words.
SKETCH_WORDS = 8
#: Standard deviations that the number of differing samples and, on top, the sketch of a true pair may
#: show: six of both together.
DEVIATIONS = 4
#: Bytes of sets, and members, that meet in one task, on either side.
PART_BYTES, PART_ROWS = 4 << 20, 1024
_RNG = np.random.Generator(np.random.PCG64(71))
_FACTORS = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 1 << 15


def sketch_limit(similarity: float) -> int:
    """The greatest XOR population count of two sketches at which a pair of at least ``similarity``
    may be expected, ``DEVIATIONS`` standard deviations of both steps allowed for."""
    bits, differ = 64 * SKETCH_WORDS, SAMPLES * (1 - similarity)
    differ = min(SAMPLES, differ + DEVIATIONS * math.sqrt(differ * similarity))
    expected = bits / 2 * (1 - (1 - 2 / bits) ** (2 * differ))
    return math.ceil(expected + DEVIATIONS * math.sqrt(bits / 4 * (1 - (1 - 4 / bits) ** (2 * differ))))


def _shingles(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and their bounds."""
    words = find_words(data, bounds, WHITE_SPACE, LOWER)
    counts = np.diff(words.first)
    rows = words.rows()
    parts = []
    at = np.flatnonzero(words.window_ok(k))
    if len(at):
        parts.append((rows[at], window_hashes(words.hashes, k)[at]))
    for size in range(1, k):  # texts of fewer words are one shingle
        short = words.first[:-1][counts == size]
        if len(short):
            parts.append((rows[short], window_hashes(words.hashes, size)[short] + np.uint64(size)))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    row, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    row, hashes = row[new], hashes[new]
    return hashes, np.searchsorted(row, np.arange(len(bounds)))


def _samples(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash samples (sample, row) of rows that are not empty."""
    out = np.empty((SAMPLES, len(bounds) - 1), np.uint64)
    low = 0
    while low < len(bounds) - 1:
        high = max(int(np.searchsorted(bounds, bounds[low] + _BLOCK, side="right")) - 1, low + 1)
        part, starts = hashes[bounds[low] : bounds[high]], bounds[low:high] - bounds[low]
        for i in range(SAMPLES):
            out[i, low:high] = np.minimum.reduceat(part * _FACTORS[i], starts)
        low = high
    return out


def _sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (row, word) of the samples."""
    place = mix(samples + np.arange(SAMPLES, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(64 * SKETCH_WORDS)
    out = np.zeros((samples.shape[1], SKETCH_WORDS), np.uint64)
    row = np.arange(samples.shape[1])
    for i in range(SAMPLES):
        out[row, (place[i] >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (place[i] & np.uint64(63))
    return out


def _bands(samples: np.ndarray) -> np.ndarray:
    """A hash of each band (row, band)."""
    out = np.zeros((BANDS, samples.shape[1]), np.uint64)
    for i in range(ROWS):
        out = mix(out * np.uint64(31) + samples[i::ROWS])
    return mix(out + np.arange(BANDS, dtype=np.uint64)[:, None]).T


_SIGNATURE = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()), ("sketch", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))]
)


def signatures(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """One row per document row: ``doc_id``, ``n_shingles``, two hashes of the whole set (null for the
    empty set), ``sketch`` and ``bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in slices(batch.column(1)):
                hashes, at = _shingles(data, bounds, k)
                counts = np.diff(at)
                some = counts > 0
                own = np.append(at[:-1][some], len(hashes))
                samples = _samples(hashes, own)
                size = int(some.sum())
                sums = [np.zeros(high - low, np.uint64) for _ in range(2)]
                for total, salt in zip(sums, (1, 2), strict=True):
                    if size:
                        total[some] = np.add.reduceat(mix(hashes * _FACTORS[salt]), own[:-1])
                empty = ~some
                lists = []
                for values in (_sketches(samples), _bands(samples)):
                    width = values.shape[1]
                    offsets = np.concatenate([[0], np.cumsum(some)]).astype(np.int32) * width
                    lists.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.ascontiguousarray(values).reshape(-1).view(np.int64))))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(counts), *[pa.array(x.view(np.int64), mask=empty) for x in sums], *lists], schema=_SIGNATURE
                )
        release()

    schema = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, sketch array<bigint>, bands array<bigint>"
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def sketch_distance(a: Column, b: Column) -> Column:
    return sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(SKETCH_WORDS)), F.lit(0))


def shingle_sets(wanted: DataFrame, docs: DataFrame, doc_id: str, text: str, k: int, scratch: Scratch) -> DataFrame:
    """The full sorted shingle set (packed) of every document in ``wanted`` (``id``)."""
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in slices(batch.column(1)):
                hashes, at = _shingles(data, bounds, k)
                raw = hashes.tobytes()
                bodies = [raw[8 * i : 8 * j] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(bodies, pa.binary())], ["id", "shingles"])

    # rows that share an id are told apart by nothing here: a set of any of them may confirm
    return scratch.table(texts.join(wanted, "id", "left_semi").mapInArrow(sets, "id bigint, shingles binary"), "sets")


def verified(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (``a``, ``b``) whose full shingle sets reach the similarity in percent."""
    full = shingle_sets(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), docs, doc_id, text, k, scratch)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                keep.append(_similar(*(np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y)), percent))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = (
        pairs.select("a", "b")
        .join(full.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a")
        .join(full.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b")
    )
    return joined.select("a", "b", "left", "right").mapInArrow(compare, "a bigint, b bigint").distinct()


def meetings(members: DataFrame, full: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (``a``, ``b``) between members of one group (``g``) that are in different components.

    ``members`` has ``g``, ``id``, ``root``, ``open``, ``sketch`` and the group's numbers of parts ``n_open`` and
    ``n_all``; ``full`` the shingle sets. Every open member meets every member, twice: first one part of the
    open ones and one part of all meet with their sketches alone, and name the members that have
    someone near enough; then those, and only those, meet again with their sets. Found links come
    out, never pairs. Pairs whose components a task has joined already are not compared.
    """
    limit = sketch_limit(percent / 100)

    def near(x: _Members, y: _Members, i: int) -> np.ndarray:
        far = np.bitwise_count(x.sketches[i] ^ y.sketches).sum(axis=1)
        return (far <= limit) & (y.roots != x.roots[i]) & (~y.open | (y.ids > x.ids[i]))

    def name(left: pa.Table, right: pa.Table) -> pa.Table:
        release()
        asking, asked = np.zeros(left.num_rows, bool), np.zeros(right.num_rows, bool)
        if left.num_rows and right.num_rows:
            x, y = _unpacked(left), _unpacked(right)
            for i in range(left.num_rows):
                mask = near(x, y, i)
                asking[i] = mask.any()
                asked |= mask
        named = [(left, asking, True), (right, asked, False)]
        return pa.concat_tables(
            pa.table({c: t.column(c).filter(pa.array(m)) for c in key + columns} | {"asks": pa.array(np.full(m.sum(), side))})
            for t, m, side in named
        )

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        release()
        found: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            x, y = _unpacked(left), _unpacked(right)
            joined: dict[int, int] = {}

            def find(root: int) -> int:
                while root in joined:
                    root = joined[root]
                return root

            for i in range(left.num_rows):
                for j in np.flatnonzero(near(x, y, i)):
                    p, q = find(int(x.roots[i])), find(int(y.roots[j]))
                    if p != q and _similar(x.sets[i], y.sets[j], percent):
                        found.append((int(x.ids[i]), int(y.ids[j])))
                        joined[p] = q
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    part = F.xxhash64("id")
    columns, key = ["id", "root", "open", "sketch"], ["g", "x", "y"]
    asks = members.filter("open").select("g", *columns, F.pmod(part, "n_open").alias("x"), F.explode(F.expr("sequence(0L, n_all - 1)")).alias("y"))
    # the aliases keep the columns of both sides apart
    answers = members.select(
        F.col("g").alias("g"), *[F.col(c).alias(c) for c in columns], F.explode(F.expr("sequence(0L, n_open - 1)")).alias("x"), F.pmod(part, "n_all").alias("y")
    )
    kinds = "g bigint, x bigint, y bigint, id bigint, root bigint, open boolean, sketch array<bigint>, asks boolean"
    named = scratch.table(asks.groupBy(*key).cogroup(answers.groupBy(*key)).applyInArrow(name, kinds), "named")
    ready = scratch.table(named.join(full, "id"), "near-sets")
    left, right = ready.filter("asks").drop("asks"), ready.filter("NOT asks").drop("asks")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(compare, "a bigint, b bigint")


class _Members(NamedTuple):
    ids: np.ndarray
    roots: np.ndarray
    open: np.ndarray
    sketches: np.ndarray
    sets: list[np.ndarray]


def _unpacked(rows: pa.Table) -> _Members:
    sketches = rows.column("sketch").combine_chunks()
    sets = rows.column("shingles").to_pylist() if "shingles" in rows.column_names else []
    return _Members(
        rows.column("id").to_numpy(),
        rows.column("root").to_numpy(),
        rows.column("open").to_numpy(),
        sketches.flatten().to_numpy().view(np.uint64).reshape(rows.num_rows, SKETCH_WORDS),
        [np.frombuffer(b, np.uint64) for b in sets],
    )


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared) > 0


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``id`` and the smallest id reachable for every end of a link (``a``, ``b``).

    Rounds of large and small stars: neighbours move to the smallest one around, until every node
    hangs on the smallest of its component. Each round's links are written to the shared folder.
    """
    edges = scratch.table(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = scratch.table(large, "large")
        least = scratch.table(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = scratch.table(small.filter("u > v").distinct(), "small")
        state = edges.agg(F.count("*"), F.sum(F.col("v").cast("decimal(20,0)")), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("id"), "root")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 4, percent: int = 80) -> DataFrame:
    """Connected components of documents whose shingle sets reach a Jaccard similarity in percent.

    Shingles are ``k`` consecutive words (runs of anything but ASCII white space, A-Z lowered); fewer
    words are one shingle. Returns one row per document row: ``doc_id``, ``n_shingles``,
    ``component_id`` (the smallest id reachable, itself included) and ``kept``.

    Documents with equal sets are one class from the start, and only the smallest id of a class is
    compared. A bucket of a band gives no pairs of all its members: each is compared with one leader.
    Only members outside the leader's component then meet all others there, part by part, and only
    links come out. No partner is dropped: what the sketch lets through is confirmed on full sets.

    Null and empty texts have an empty set, are linked with nothing and kept. A null id takes no part:
    its ``component_id`` is null and ``kept`` is true. Rows that share an id are one node: their links
    are pooled; all of them have its component. An empty table gives an empty table; other columns,
    whatever their names, are not read.
    """
    signed = materialise(signatures(docs, doc_id, text, k), "signatures")
    with Scratch(docs.sparkSession) as scratch:
        every = materialise(_components_of(signed, docs, doc_id, text, k, percent, scratch), "components")
    component = F.coalesce("root", "doc_id")
    return (
        signed.select("doc_id", "n_shingles")
        .join(every, "doc_id", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
    )


def _components_of(signed: DataFrame, docs: DataFrame, doc_id: str, text: str, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """``doc_id`` and ``root`` of every document that has a link."""
    nodes = signed.filter("doc_id IS NOT NULL AND set_a IS NOT NULL")
    classes = scratch.table(nodes.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    same = nodes.join(classes.filter("n > 1"), ["set_a", "set_b"]).filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    same = scratch.table(same, "same")

    # one row per class and band, for buckets of two classes at least
    reps = nodes.join(classes.select(F.col("rep").alias("doc_id"), "set_a", "set_b"), ["doc_id", "set_a", "set_b"], "left_semi")
    reps = scratch.table(reps.groupBy("doc_id", "set_a", "set_b").agg(F.first("sketch").alias("sketch"), F.first("bands").alias("bands")), "reps")
    members = reps.select(F.col("doc_id").alias("id"), F.posexplode("bands").alias("band", "key"))
    buckets = members.groupBy("band", "key").agg(F.min("id").alias("leader"), F.max("id").alias("last")).filter("leader < last")
    buckets = scratch.table(buckets.select("band", "key", "leader"), "buckets")
    members = scratch.table(members.join(buckets, ["band", "key"]).select("band", "key", "leader", "id"), "members")

    stars = members.groupBy("id").agg(F.min("leader").alias("leader")).filter("leader < id")
    sketch = reps.select("doc_id", "sketch")
    limit = sketch_limit(percent / 100)
    near = sketch_distance(F.col("x"), F.col("y")) <= limit
    pairs = (
        stars.join(sketch.select(F.col("doc_id").alias("id"), F.col("sketch").alias("x")), "id")
        .join(sketch.select(F.col("doc_id").alias("leader"), F.col("sketch").alias("y")), "leader")
        .filter(near)
        .select(F.col("leader").alias("a"), F.col("id").alias("b"))
    )
    pairs = scratch.table(pairs, "star-pairs")
    links = scratch.table(verified(pairs, docs, doc_id, text, k, percent, scratch), "star-links")

    # members that are not yet with their leader, against all in the buckets of leaders in its component
    roots = components(links, scratch)
    rooted = _with_root(_with_root(members, "id", roots, "root"), "leader", roots, "head")
    rooted = scratch.table(rooted, "rooted")
    busy = scratch.table(rooted.filter("root <> head").select("band", "key").distinct(), "busy")
    meet = rooted.join(busy, ["band", "key"], "left_semi").groupBy(F.col("head").alias("g"), "id", "root")
    meet = scratch.table(meet.agg(F.max(F.col("root") != F.col("head")).alias("open")), "meet")
    full = shingle_sets(meet.select("id").distinct(), docs, doc_id, text, k, scratch)
    sizes = full.select("id", (F.octet_length("shingles") + 8 * SKETCH_WORDS).alias("size"))
    members = meet.join(sketch.withColumnRenamed("doc_id", "id"), "id").join(sizes, "id")
    members = scratch.table(members, "meeting")
    open_size, open_ = F.when(F.col("open"), F.col("size")), F.col("open")
    parts = members.groupBy("g").agg(
        F.greatest(F.ceil(F.sum(open_size) / PART_BYTES), F.ceil(F.count_if(open_) / PART_ROWS)).alias("n_open"),
        F.greatest(F.ceil(F.sum("size") / PART_BYTES), F.ceil(F.count("*") / PART_ROWS)).alias("n_all"),
    )
    parts = scratch.table(parts.filter("n_open > 0"), "parts")
    more = scratch.table(meetings(members.drop("size").join(parts, "g"), full, percent, scratch), "more-links")

    return components(links.union(more).union(same), scratch).select(F.col("id").alias("doc_id"), F.col("root"))


def _with_root(rows: DataFrame, column: str, roots: DataFrame, name: str) -> DataFrame:
    found = roots.select(F.col("id").alias(column), F.col("root").alias(name))
    return rows.join(found, column, "left").withColumn(name, F.coalesce(name, column))


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, less those that are near-duplicates of one that stays: of each group
    the row of the smallest id.

    Rows that share an id are judged by their own texts: a document is an id and a text hash, and the
    smallest of a group is told by id, then text hash. Of rows with one id and one text, one stays
    (the least by the other columns). Rows without an id all stay. Where no id repeats, which one count
    tells, the ids themselves are the nodes, and no hash stands for a document."""
    key, columns = F.col(f"`{doc_id}`"), [F.col(f"`{c}`") for c in docs.columns]
    if docs.filter(key.isNotNull()).groupBy(key).count().filter("count > 1").isEmpty():
        groups = near_duplicates(docs, doc_id, text, k, percent)
        dropped = materialise(groups.filter(~F.col("kept")).select(F.col("doc_id").alias("_dropped")).distinct(), "dropped")
        return docs.join(dropped, key == F.col("_dropped"), "left_anti").select(*columns)
    body = F.col(f"`{text}`")
    marked = docs.withColumns({"_node": F.when(key.isNotNull(), F.xxhash64(key, body)), "_print": F.xxhash64(body), "_id": key})
    groups = near_duplicates(marked, "_node", text, k, percent)
    groups = groups.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("_node"), "component_id").distinct()
    names = marked.filter("_node IS NOT NULL").select("_id", "_print", "_node").distinct()
    named = materialise(names.join(groups, "_node"), "named")
    first = named.groupBy("component_id").agg(F.min(F.struct("_id", "_print", "_node")).alias("first"))
    dropped = materialise(named.join(first.select("first._node"), "_node", "left_anti").select("_node"), "dropped")
    single = marked.join(dropped, "_node", "left_anti")
    order = Window.partitionBy("_node").orderBy(*[F.col(f"`{c}`") for c in docs.columns if c not in (doc_id, text)] or [F.lit(0)])
    once = single.filter("_node IS NOT NULL").withColumn("_row", F.row_number().over(order)).filter("_row = 1")
    return once.select(*columns).union(single.filter("_node IS NULL").select(*columns))
