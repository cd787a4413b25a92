"""Language identification with averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its subwords (runs of 2 to 4 bytes of its letters, words
joined by single spaces), hashed into buckets; a linear layer and a softmax give the language. The
model is trained by stochastic gradient descent on a bounded sample. A temperature fitted on a part
of the sample that was not trained on makes the probabilities honest; a threshold on them rejects.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealoom.llm.hashed import least_rows
from arealoom.llm.words import release, slices

SIZES = (2, 3, 4)
BUCKETS = 1 << 14
#: Rows of each language, and of all languages, that a model is fitted on.
SAMPLE_PER_LANGUAGE, SAMPLE_ROWS = 300, 3000
#: Share of right predictions that the threshold may reject, and its highest value.
REJECTED_SHARE, HIGHEST_THRESHOLD = 0.002, 0.5
NO_LANGUAGE = "und"
#: Bytes of texts that are scored at once.
SLICE_BYTES = 1 << 20
_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


class Model(NamedTuple):
    languages: list[str]
    scores: np.ndarray  # (bucket, language): embedding times linear layer; a zero row at the end
    bias: np.ndarray
    temperature: float
    threshold: float


def _letters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowered letters, everything else one space, and the new bounds."""
    folded = _FOLD[data]
    # capitals of the two-byte Latin letters
    folded[1:][(data[:-1] == 0xC3) & (data[1:] <= 0x9E) & (data[1:] >= 0x80)] += 0x20
    space = folded == 0x20
    keep = ~space
    keep[1:] |= ~space[:-1]
    return folded[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


def _subwords(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """For each size the bucket at every byte; ``BUCKETS`` where the subword would leave the row."""
    wide = data.astype(np.uint32)
    code = wide.copy()
    for size in range(2, max(SIZES) + 1):
        code = code[:-1] << np.uint32(8) | wide[size - 1 :]
        if size in SIZES and len(code):
            mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * size)
            bucket = np.full(len(data), BUCKETS, np.int64)
            bucket[: len(code)] = mixed >> np.uint32(32 - 14)
            for back in range(1, size):
                at = bounds[1:] - back
                bucket[at[at >= bounds[:-1]]] = BUCKETS
            yield bucket, size


def bags(data: np.ndarray, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each row and their shares."""
    data, bounds = _letters(data, bounds)
    found = [bucket for bucket, _ in _subwords(data, bounds)]
    out = []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        counts = np.bincount(np.concatenate([b[low:high] for b in found] or [np.zeros(0, np.int64)]), minlength=BUCKETS + 1)[:BUCKETS]
        at = np.flatnonzero(counts)
        out.append((at, counts[at] / max(1, counts.sum())))
    return out


def logits(model: Model, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Scores (row, language) before the softmax."""
    data, bounds = _letters(data, bounds)
    rows, k = len(bounds) - 1, len(model.languages)
    total, count = np.zeros((rows, k)), np.zeros(rows)
    some = np.flatnonzero(np.diff(bounds) > 0)
    starts = bounds[:-1][some]
    if len(some):
        for bucket, size in _subwords(data, bounds):
            for c in range(k):
                total[some, c] += np.add.reduceat(model.scores[:, c][bucket], starts)
            count += np.maximum(0, np.diff(bounds) - size + 1)
    return total / np.maximum(1, count)[:, None] + model.bias


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], dimension: int = 16, epochs: int = 12, rate: float = 2.0, seed: int = 5) -> Model:
    """Fit on (language, buckets, shares); every fifth row of a language is kept for calibration."""
    languages = sorted({language for language, _, _ in rows})
    rng = np.random.Generator(np.random.PCG64(seed))
    embedding = rng.normal(0, 1 / np.sqrt(dimension), (BUCKETS, dimension))
    layer, bias = np.zeros((dimension, len(languages))), np.zeros(len(languages))
    order = {language: 0 for language in languages}
    fit, hold = [], []
    for language, at, share in rows:
        (hold if order[language] % 5 == 4 else fit).append((languages.index(language), at, share))
        order[language] += 1
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(fit)):
            label, at, share = fit[i]
            hidden = share @ embedding[at]
            slope = softmax(hidden @ layer + bias)
            slope[label] -= 1
            back = layer @ slope
            layer -= step * np.outer(hidden, slope)
            bias -= 0.1 * step * slope
            embedding[at] -= step * 20 * np.outer(share, back)
    raw = np.array([share @ embedding[at] @ layer + bias for _, at, share in hold or fit])
    labels = np.array([label for label, _, _ in hold or fit], int)
    temperature, threshold = 1.0, 0.0
    if len(labels):
        grid = np.exp(np.linspace(np.log(0.5), np.log(10), 61))
        losses = [-np.log(softmax(raw / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
        temperature = float(grid[int(np.argmin(losses))])
        p = softmax(raw / temperature)
        right = np.sort(p.max(axis=1)[p.argmax(axis=1) == labels])
        if len(right):
            threshold = min(HIGHEST_THRESHOLD, float(right[int(REJECTED_SHARE * len(right))]))
    scores = np.zeros((BUCKETS + 1, len(languages)))
    scores[:BUCKETS] = embedding @ layer
    return Model(languages, scores, bias, temperature, threshold)


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Train on at most ``SAMPLE_PER_LANGUAGE`` rows of each language and ``SAMPLE_ROWS`` in all, those of
    the least key hashes. Rows without a label or a key are not chosen, chosen ones without a text not
    used; without any usable row the model has no language and predicts ``und``. Only bags of at most
    ``BUCKETS`` shares of the chosen rows come to the driver."""
    # chosen by key and label alone, so that this scan reads no text
    usable = labelled.select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").alias("lang")).filter("key IS NOT NULL AND lang IS NOT NULL")
    chosen = least_rows(usable, "lang", "key", SAMPLE_PER_LANGUAGE)
    chosen = chosen.orderBy("n", "lang", "key").limit(SAMPLE_ROWS).select("key", "lang", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in slices(batch.column(2)):
                made = bags(data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(low, high - low).columns[:2], pa.array([x.astype(np.uint16).tobytes() for x, _ in made], pa.binary()),
                     pa.array([x.astype(np.float32).tobytes() for _, x in made], pa.binary())],
                    ["lang", "n", "buckets", "shares"],
                )
        release()

    texts = labelled.select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")
    # at most SAMPLE_ROWS keys
    sample = texts.join(F.broadcast(chosen), ["key", "lang"]).dropDuplicates(["key", "lang"]).select("lang", "n", "text")
    rows = sample.mapInArrow(run, "lang string, n int, buckets binary, shares binary").collect()
    rows.sort(key=lambda row: (row.n, row.lang))
    return train([(r.lang, np.frombuffer(r.buckets, np.uint16).astype(np.int64), np.frombuffer(r.shares, np.float32)) for r in rows])


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (calibrated probability) and ``accepted`` to every row.

    ``und`` with score 0, not accepted, where the text is null or has no letter, or the model no
    language; else always a learned language. A score below the model's threshold is not accepted.
    Ties go to the language first in alphabetical order. Columns of these names are replaced; all
    others pass. Rows are judged one by one, an empty table gives an empty table.
    """
    names = ["lang_pred", "score", "accepted"]
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names or c == text])
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = [f for f in kept.schema.fields if f.name not in names]
    keep = [i for i, f in enumerate(kept.schema.fields) if f.name not in names]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        languages = np.array([*model.languages, NO_LANGUAGE], object)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for low, high, data, bounds in slices(column, SLICE_BYTES):
                letters = np.diff(np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])[bounds]) > 0
                for i in np.flatnonzero(~letters & (np.diff(bounds) > 0)):
                    letters[i] = _LETTER.search(data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace")) is not None
                if model.languages:
                    p = softmax(logits(model, data, bounds) / model.temperature)
                    best, score = p.argmax(axis=1), p.max(axis=1)
                else:
                    letters[:] = False
                    best, score = np.zeros(high - low, int), np.zeros(high - low)
                best = np.where(letters, best, len(model.languages))
                score = np.where(letters, score, 0.0)
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in keep], pa.array(languages[best], pa.string()), pa.array(score), pa.array(letters & (score >= model.threshold))],
                    [*[f.name for f in fields], *names],
                )
        release()

    return kept.mapInArrow(run, schema)


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows that no model is fitted on: CRC-32 of the key as text leaves no remainder; false for null."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(False))
