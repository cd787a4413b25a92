"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another. Each model sees the hashed words of the text and the
probabilities of all categories before it. In training these probabilities come from models that
did not see the row (out-of-fold), so later models learn from what they will get in use.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealoom.llm import hashed

#: Rows of each combination of labels that a chain is fitted on, and folds.
SAMPLE_PER_LABEL, FOLDS = 1000, 4
EPOCHS, RATE, SPARSITY = 12, 0.5, 2e-4
#: A term counts in a model if it stands in so many rows and its shares with and without the category
#: differ by so many standard deviations.
LEAST_ROWS, LEAST_DEVIATIONS = 4, 6.0


class Chain(NamedTuple):
    categories: list[str]
    weights: list[np.ndarray]  # of the buckets, for each category
    links: list[np.ndarray]  # of the earlier categories' probabilities, and the constant last
    thresholds: list[float]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _fit_one(bags: list, before: np.ndarray, labels: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression by AdaGrad; small weights are pulled to zero, rare classes weigh more."""
    rng = np.random.Generator(np.random.PCG64(seed))
    weights, squares = np.zeros(hashed.BUCKETS), np.full(hashed.BUCKETS, 1e-8)
    link, link_squares = np.zeros(before.shape[1] + 1), np.full(before.shape[1] + 1, 1e-8)
    share = labels.mean() if len(labels) else 0.5
    bags = _telling(bags, labels)
    cost = np.where(labels, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            at, value = bags[i]
            side = np.append(before[i], 1.0)
            slope = cost[i] * (_sigmoid(weights[at] @ value + link @ side) - labels[i])
            step = slope * value
            squares[at] += step * step
            rate = RATE / np.sqrt(squares[at])
            moved = weights[at] - rate * step
            weights[at] = np.sign(moved) * np.maximum(0, np.abs(moved) - rate * SPARSITY)
            step = slope * side
            link_squares += step * step
            link -= RATE / np.sqrt(link_squares) * step
    return weights, link


def marks(data: np.ndarray, bounds: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The buckets of words, stems, shapes and repetitions of each row, every one once."""
    keys = []
    for make in (hashed.terms, hashed.styles):
        features, first = make(data, bounds)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        keys += [row << hashed.BITS | f for f in features]
    key = np.unique(np.concatenate(keys))
    return [key & (hashed.BUCKETS - 1)], np.searchsorted(key >> hashed.BITS, np.arange(len(bounds)))


def _telling(bags: list, labels: np.ndarray) -> list:
    """The bags without terms that tell nothing about the label."""
    counts = np.zeros((2, hashed.BUCKETS))
    for (at, _), label in zip(bags, labels, strict=True):
        counts[int(label), at] += 1
    rows = np.maximum(1, np.array([[(labels == 0).sum()], [(labels == 1).sum()]]))
    share = counts / rows
    both = counts.sum(0) / rows.sum()
    spread = np.sqrt(both * (1 - both) * (1 / rows).sum()) + 1e-12
    keep = (counts.sum(0) >= LEAST_ROWS) & (np.abs(share[1] - share[0]) >= LEAST_DEVIATIONS * spread)
    return [(at[keep[at]], value[keep[at]]) for at, value in bags]


def _values(bags: list) -> list:
    """One for every distinct term: how often it is said does not count."""
    return [(at, np.ones(len(at))) for at, _ in bags]


def train(bags: list, labels: np.ndarray, categories: Sequence[str]) -> Chain:
    """Fit on (buckets, counts) and labels (row, category)."""
    bags, fold = _values(bags), np.arange(len(bags)) % FOLDS
    before = np.zeros((len(bags), 0))
    chain = Chain(list(categories), [], [], [])
    for c in range(len(categories)):
        y = labels[:, c]
        out_of_fold = np.zeros(len(bags))
        for f in range(FOLDS):
            rows, rest = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            weights, link = _fit_one([bags[i] for i in rows], before[rows], y[rows], seed=100 * c + f)
            for i in rest:
                out_of_fold[i] = _sigmoid(weights[bags[i][0]].sum() + link @ np.append(before[i], 1.0))
        weights, link = _fit_one(bags, before, y, seed=100 * c + FOLDS)
        chain.weights.append(weights)
        chain.links.append(link)
        chain.thresholds.append(_threshold(out_of_fold, y))
        before = np.column_stack([before, out_of_fold])
    return chain


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The threshold of the best F0.5 (precision weighs more) of the out-of-fold probabilities, in the
    middle of its gap."""
    if not len(y) or not y.any():
        return 1.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    quality = 1.25 * hits / (np.arange(1, len(y) + 1) + 0.25 * y.sum())
    best = int(np.argmax(quality))
    after = p[order[best + 1]] if best + 1 < len(p) else 0.0
    return float((p[order[best]] + after) / 2)


def fit(labels: DataFrame, texts: DataFrame, categories: Sequence[str], key: str = "doc_id", text: str = "text") -> Chain:
    """Fit a chain on the 0/1 columns ``categories`` of ``labels``, in the order given, on at most
    ``SAMPLE_PER_LABEL`` rows of each combination of labels. Rows with a null key, text or label are not
    used; without rows nothing is ever predicted."""
    mixed = F.concat(*[F.col(f"`{c}`").cast("int").cast("string") for c in categories])
    rows = hashed.sample_bags(labels.select(F.col(f"`{key}`").alias("_key"), mixed.alias("_mixed")), texts.withColumn("_key", F.col(f"`{key}`")), "_key", "_mixed", text, marks, SAMPLE_PER_LABEL)
    rng = np.random.Generator(np.random.PCG64(3))
    rows = [rows[i] for i in rng.permutation(len(rows))]
    labels = np.array([[c == "1" for c in r[0]] for r in rows], float).reshape(len(rows), len(categories))
    return train([r[2:] for r in rows], labels, categories)


def predict(df: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """Add ``p_<category>`` and ``is_<category>`` for each category of the chain.

    Every word of the whole text counts once, however often it stands there. A null or empty text has
    no words and is in no category. Columns of these names are replaced; all others pass; rows are
    judged one by one, so repeated rows agree, and an empty table gives an empty table.
    """
    shared = df.sparkSession.sparkContext.broadcast(chain)
    fields = [(f"{kind}_{c}", T.DoubleType() if kind == "p" else T.BooleanType()) for c in chain.categories for kind in ("p", "is")]

    def work(data: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
        chain = shared.value
        features, first = marks(data, bounds)
        some = np.diff(first) > 0
        before, out = np.zeros((len(bounds) - 1, 0)), []
        for weights, link, threshold in zip(chain.weights, chain.links, chain.thresholds, strict=True):
            side = np.column_stack([before, np.ones(len(before))])
            p = np.where(some, _sigmoid(hashed.row_sums(features, first, weights) + side @ link), 0.0)
            out += [pa.array(p), pa.array(some & (p >= threshold))]
            before = np.column_stack([before, p])
        return out

    return hashed.add_columns(df, text, fields, work)
