"""Exact top-k search by inner product with a table of distances to pivots.

Vectors get one more component that brings all to the greatest norm, so the largest inner product is
the least Euclidean distance. Distances of every row to many pivots are computed once and stored. For
a query, the greatest difference of pivot distances is a lower bound of its distance to a row: rows
are evaluated in the order of their bounds until the next bound is beyond the k-th best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealoom.session import materialise

#: Rows that pivots and the first thresholds are taken from, pivots, rows of a block, queries of a pass.
SAMPLE_ROWS, PIVOTS, BLOCK_ROWS, PASS_QUERIES = 512, 32, 1024, 1 << 15
#: Queries scored against the sample at once.
QUERY_STEP = 1024
#: Rows of a block evaluated at once, and the least slack for rounded distances.
STEP_ROWS, SLACK = 64, 0.05


def quantised(df: DataFrame, vec_id: str, vector: str, scale: int = 1024) -> DataFrame:
    """``vec_id`` and ``vec``: floor of ``scale`` times each component as double, a long. Rows with a null id, a
    null vector or a null or non-finite component are left out."""
    column = F.col(f"`{vector}`")
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.filter(F.col(f"`{vec_id}`").isNotNull() & column.isNotNull()).filter(finite)
    return rows.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.transform(column, lambda x: F.floor(x.cast("double") * scale)).alias("vec")
    )


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(lists), width))
    if len(lists):
        sizes = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(lists)), sizes)
        out[row, np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)] = lists.flatten().to_numpy()
    return out


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: each next one is the farthest from those chosen."""
    chosen, far = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(count, len(sample)):
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
        if far.max() == 0:
            break
        chosen.append(int(far.argmax()))
    return sample[chosen]


def _row_distances(x: np.ndarray, pivots: np.ndarray, top: float) -> np.ndarray:
    """Distances of lifted rows to lifted pivots."""
    lift = np.sqrt(np.maximum(0, top - (x * x).sum(1)))[:, None] * np.sqrt(np.maximum(0, top - (pivots * pivots).sum(1)))
    return np.sqrt(np.maximum(0, 2 * top - 2 * (x @ pivots.T + lift)))


def _query_distances(q: np.ndarray, pivots: np.ndarray, top: float) -> np.ndarray:
    return np.sqrt(np.maximum(0, (q * q).sum(1)[:, None] + top - 2 * q @ pivots.T))


def slack(top: float, width: int) -> float:
    """More than the rounding of three distances computed as doubles, one of them held in 32 bits,
    for squared norms of at most ``top``."""
    return max(SLACK, math.sqrt(top) * (2.0**-22 + 8 * math.sqrt((width + 8) * 2.0**-52)))


class _Best:
    """The k best of every query so far, by score and then smaller id."""

    def __init__(self, ids: np.ndarray, k: int):
        self.own, self.k = ids, k
        self.found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        other = ids != self.own[q]
        ids, scores = ids[other], scores[other]
        if q in self.found:
            ids, scores = np.concatenate([self.found[q][0], ids]), np.concatenate([self.found[q][1], scores])
        order = np.lexsort((ids, -scores))[: self.k]
        self.found[q] = ids[order], scores[order]

    def worst(self, q: int) -> float:
        scores = self.found.get(q, (None, ()))[1]
        return float(scores[-1]) if len(scores) == self.k else -np.inf


def top_k(df: DataFrame, queries: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """The ``k`` rows of the highest integer inner product for each query row.

    ``queries`` is a condition on ``vec_id``. Candidates are all rows but those with the query's id; ties
    go to the smaller id; fewer candidates give fewer rows. Returns ``query_id``, ``rank`` from 1,
    ``vec_id``, ``score``. Vectors that are null or hold a null or non-finite component, and null ids,
    take no part; a shorter vector counts as ended with zeros; rows that share an id are candidates
    one by one, and one query each if their vectors differ; an empty table gives no rows. Scores are
    exact; a squared norm of 2**63 or more (after ``scale``) is an error, as its score is no long.

    Pivots come from ``SAMPLE_ROWS`` rows of the least id hashes. All rows are in the table of distances,
    in blocks of about ``BLOCK_ROWS`` around the nearest pivot. Queries are searched in passes of
    about ``PASS_QUERIES``, broadcast one pass at a time; every task keeps ``k`` rows per query.
    """
    spark = df.sparkSession
    rows = quantised(df, vec_id, vector, scale)
    squares = F.aggregate("vec", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x.cast("long"))
    facts = rows.agg(F.max(F.size("vec")).alias("width"), F.max(squares).alias("top"), F.count("*").alias("n")).first()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not facts.n:
        return spark.createDataFrame([], schema)
    width, top = facts.width, float(facts.top)
    # squared norms bound components and scores
    held, exact = np.int32 if facts.top < 1 << 60 else np.int64, np.float64 if facts.top < 1 << 52 else np.int64
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(SAMPLE_ROWS).collect()
    sample_ids = np.array([r.vec_id for r in sample])
    sample_rows = _matrix(pa.array([r.vec for r in sample], pa.list_(pa.int64())), width)
    pivots = choose_pivots(sample_rows, PIVOTS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            distances = _row_distances(x, pivots, top)
            made = [pa.array([r.tobytes() for r in y], pa.binary()) for y in (x.astype(held), distances.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, pa.array(distances.argmin(axis=1), pa.int32())], ["vec_id", "vec", "far", "cell"])

    measured = materialise(rows.mapInArrow(measure, "vec_id bigint, vec binary, far binary, cell int"), "distances")
    # at most PIVOTS cells
    cells = {r.cell: -(-r["count"] // BLOCK_ROWS) for r in measured.groupBy("cell").count().collect()}
    parts = F.create_map(*[F.lit(x) for pair in cells.items() for x in pair])[F.col("cell")]
    spread = F.pmod(F.xxhash64("vec_id", "vec"), parts)
    table = measured.withColumn("block", F.struct("cell", spread.alias("part")))
    table = materialise(table.repartition("block").sortWithinPartitions("block").select("vec_id", "vec", "far", F.hash("block").alias("block")), "blocks")

    asked = measured.filter(queries).select("vec_id", "vec").distinct()
    asked = materialise(asked.withColumn("pass", F.pmod(F.xxhash64("vec_id", "vec"), F.lit(max(1, -(-asked.count() // PASS_QUERIES))))), "queries")
    passes = [r["pass"] for r in asked.select("pass").distinct().orderBy("pass").collect()]
    found = [_search(table, asked.filter(F.col("pass") == p), pivots, top, width, k, sample_ids, sample_rows, held, exact) for p in passes]
    if not found:
        return spark.createDataFrame([], schema)
    every = found[0]
    for one in found[1:]:
        every = every.union(one)
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(table: DataFrame, asked: DataFrame, pivots, top: float, width: int, k: int, sample_ids, sample_rows, held, exact) -> DataFrame:
    queries = asked.select("vec_id", "vec", F.xxhash64("vec").alias("hash")).orderBy("vec_id", "vec").collect()
    ids = np.array([r.vec_id for r in queries], np.int64)
    hashes = np.array([r["hash"] for r in queries], np.int64)
    q = np.array([np.frombuffer(r.vec, held) for r in queries]).astype(float).reshape(len(ids), width)
    loose = slack(top, width)
    shared = table.sparkSession.sparkContext.broadcast((ids, hashes, q, _query_distances(q, pivots, top), (q * q).sum(1) + top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes, q, far, base = shared.value
        best = _Best(ids, k)
        # thresholds from the sample; its own rows are found again with all others
        limit = np.full(len(ids), np.inf)
        if len(sample_ids) > k:
            kth = np.empty(len(ids))
            for low in range(0, len(ids), QUERY_STEP):
                some = slice(low, low + QUERY_STEP)
                scores = np.where(sample_ids == ids[some, None], -np.inf, q[some] @ sample_rows.T)
                kth[some] = np.sort(scores, axis=1)[:, -k]
            limit = np.where(np.isfinite(kth), np.sqrt(np.maximum(0, base - 2 * kth)), np.inf) + loose
        for batch in batches:
            block = batch.column(3).to_numpy()
            rows = batch.column(0).to_numpy()
            vectors = np.frombuffer(b"".join(batch.column(1).to_pylist()), held).reshape(len(rows), -1).astype(exact)
            distances = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float32).reshape(len(rows), -1).astype(float)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(rows)]])
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                part = distances[low:high]
                gap = np.maximum(far - part.max(axis=0), part.min(axis=0) - far).max(axis=1)
                for i in np.flatnonzero(gap <= limit):
                    bound = np.abs(part - far[i]).max(axis=1)
                    order = np.argsort(bound, kind="stable")
                    order = order[: np.searchsorted(bound[order], limit[i], side="right")]
                    at = 0
                    while at < len(order) and bound[order[at]] <= limit[i]:
                        chosen = low + order[at : at + STEP_ROWS]
                        best.add(i, rows[chosen], vectors[chosen] @ q[i].astype(exact))
                        worst = best.worst(i)
                        if np.isfinite(worst):
                            limit[i] = min(limit[i], np.sqrt(max(0.0, base[i] - 2 * worst)) + loose)
                        at += STEP_ROWS
        for i, (found, scores) in best.found.items():
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, ids[i])), pa.array(np.full(n, hashes[i])), pa.array(found), pa.array(scores.astype(np.int64))],
                ["query_id", "query_hash", "vec_id", "score"],
            )

    return table.mapInArrow(run, "query_id bigint, query_hash bigint, vec_id bigint, score bigint")
