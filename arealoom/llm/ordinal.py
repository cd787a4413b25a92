"""Text quality by ordinal cumulative-link regression.

One weight vector over hashed words and shapes scores a text; ordered thresholds on that score part
the grades: P(grade <= j) = sigmoid(threshold_j - score). The grades' probabilities give an expected
grade and the tail probability of a good enough grade, which selects.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealoom.llm import hashed

#: Rows of each grade that a model is fitted on.
SAMPLE_PER_GRADE = 1000
EPOCHS, RATE, SPARSITY, SCALE = 10, 0.3, 1e-5, 8.0
#: Share of rows of the wanted grades that the chosen tail probability may leave out on held-out rows.
LOST_SHARE = 0.001


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades
    wanted: int
    cut: float


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def tail(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade > j) for each row and threshold j."""
    return _sigmoid(np.asarray(score)[..., None] - thresholds)


def _fit(bags: list, grades: np.ndarray, levels: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(seed))
    weights, squares = np.zeros(hashed.BUCKETS), np.full(hashed.BUCKETS, 1e-8)
    # the first threshold and the logarithms of the gaps keep the order
    free = np.concatenate([[-1.0], np.zeros(levels - 2)])
    free_squares = np.full(levels - 1, 1e-8)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            at, value = bags[i]
            thresholds = free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])
            above = _sigmoid(weights[at] @ value - thresholds)
            g = grades[i]
            # likelihood P(> g - 1) - P(> g); slopes by score and by threshold
            high, low = (1.0 if g == 0 else above[g - 1]), (0.0 if g == levels - 1 else above[g])
            p = max(high - low, 1e-9)
            d_high, d_low = high * (1 - high), low * (1 - low)
            slope = -(d_high - d_low) / p
            by_threshold = np.zeros(levels - 1)
            if g > 0:
                by_threshold[g - 1] = d_high / p
            if g < levels - 1:
                by_threshold[g] = -d_low / p
            step = np.clip(slope, -5, 5) * value
            squares[at] += step * step
            rate = RATE / np.sqrt(squares[at])
            moved = weights[at] - rate * step
            weights[at] = np.sign(moved) * np.maximum(0, np.abs(moved) - rate * SPARSITY)
            back = np.array([by_threshold.sum(), *[np.exp(free[j]) * by_threshold[j:].sum() for j in range(1, levels - 1)]])
            back = np.clip(back, -5, 5)
            free_squares += back * back
            free = free - RATE / np.sqrt(free_squares) * back
    return weights, free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])


def train(bags: list, grades: np.ndarray, levels: int, wanted: int) -> Model:
    """Fit on (buckets, counts) and grades 0 to ``levels`` - 1; the cut comes from a fifth held out."""
    bags = [(at, SCALE * n / max(1.0, n.sum())) for at, n in bags]
    rows = np.arange(len(bags))
    weights, thresholds = _fit([bags[i] for i in rows if i % 5 != 4], grades[rows % 5 != 4], levels, 1)
    held = [tail(weights[bags[i][0]] @ bags[i][1], thresholds)[wanted - 1] for i in rows if i % 5 == 4 and grades[i] >= wanted]
    cut = min(0.5, float(np.quantile(held, LOST_SHARE))) if held else 0.5
    weights, thresholds = _fit(bags, grades, levels, 2)
    return Model(weights, thresholds, wanted, cut)


def fit(rated: DataFrame, texts: DataFrame, levels: int, wanted: int, key: str = "doc_id", text: str = "text", grade: str = "grade") -> Model:
    """Fit on the integer grades of ``rated``, at most ``SAMPLE_PER_GRADE`` rows of each; texts of grade ``wanted`` or more
    are to be selected. Null keys, texts and grades and grades out of range are not used."""
    rows = rated.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{grade}`").cast("int").alias("_grade"))
    rows = rows.filter(F.col("_grade").between(0, levels - 1))
    found = hashed.sample_bags(rows, texts.withColumn("_key", F.col(f"`{key}`")), "_key", "_grade", text, hashed.styles, SAMPLE_PER_GRADE)
    rng = np.random.Generator(np.random.PCG64(9))
    found = [found[i] for i in rng.permutation(len(found))]
    return train([r[2:] for r in found], np.array([r[0] for r in found], int), levels, wanted)


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``expected_grade``, ``p_wanted`` (the tail probability) and ``selected``.

    A null text, or one without a word, has grade 0, probability 0 and is not selected. Columns of these
    names are replaced; all others pass; rows are judged one by one on their whole text, so repeated
    rows agree, and an empty table gives an empty table.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        model = shared.value
        features, first = hashed.styles(data, bounds)
        count = np.diff(first) * len(features)
        score = SCALE * hashed.row_sums(features, first, model.weights) / np.maximum(1, count)
        above = np.where((count > 0)[:, None], tail(score, model.thresholds), 0.0)
        wanted = above[:, model.wanted - 1]
        return [pa.array(above.sum(axis=1)), pa.array(wanted), pa.array((count > 0) & (wanted >= model.cut))]

    return hashed.add_columns(df, text, [("expected_grade", T.DoubleType()), ("p_wanted", T.DoubleType()), ("selected", T.BooleanType())], work)
