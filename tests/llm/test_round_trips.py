"""Whitening, periodic runs and piece encoding against numpy, brute force and the tokenizer library."""

import functools
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from arealoom.llm import pieces, runs, whitening
from arealoom.llm.queries import QUERIES, with_planted_runs

WORD = r"[^\x20\x09-\x0D]+"


def brute_runs(w):
    n, out = len(w), []
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            s = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            e = i + p
            if e - s >= max(24, 3 * p) and not any(p % d == 0 and w[s : e - d] == w[s + d : e] for d in range(1, p)):
                out.append((s, e - s, p))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def run_texts():
    rng = random.Random(5)
    for kind in range(100):
        base = [f"w{rng.randrange(rng.choice([1, 2, 3, 30]))}" for _ in range(rng.randrange(120))]
        if kind % 4 == 1:
            for _ in range(3):
                base += [f"x{rng.randrange(4)}" for _ in range(rng.randrange(1, 20))] * rng.randrange(1, 9) + base[: rng.randrange(5)]
        if kind % 4 == 2:
            block = ["a"] * rng.randrange(20, 40) + [f"y{rng.randrange(9)}" for _ in range(5)]
            base = block * rng.randrange(1, 6) + base[:5] + block
        if kind % 4 == 3:
            a, b = ["a"], ["a", "b"]
            for _ in range(rng.randrange(3, 9)):
                a, b = b, b + a
            base = b * rng.randrange(1, 4)
        yield rng.choice([" ", "\n", "\t "]).join(base)


def test_runs_against_brute_force(spark, edge_docs, no_docs):
    texts = list(run_texts())
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    out = runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(2))
    assert out.columns == ["doc_id", "text", "n_words", "runs", "strongest", "collapsed"]
    some = 0
    for r in out.collect():
        w = texts[r.doc_id].split()
        want = brute_runs(w)
        some += len(want)
        assert [(x.start, x.length, x.period) for x in r.runs] == want and r.n_words == len(w)
        assert r.collapsed == brute_collapsed(w, want)
        best = min(want, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        assert (tuple(r.strongest) if r.strongest else None) == best
    assert some > 100
    got = runs.periodic_runs(edge_docs).collect()
    assert len(got) == edge_docs.count()
    for r in got:
        w = re.findall(WORD, r.text or "")
        if len(w) < 1000:
            want = brute_runs(w)
            assert [tuple(x) for x in r.runs] == want and r.collapsed == brute_collapsed(w, want)
        else:
            assert r.runs == [] and r.collapsed == " ".join(w)
    assert runs.periodic_runs(no_docs).count() == 0


def test_long_periodic_text(spark):
    rng = random.Random(2)
    block = [f"v{rng.randrange(50)}" for _ in range(977)]
    w = block * 40 + ["end"] + ["z"] * 5000
    (row,) = runs.periodic_runs(spark.createDataFrame([(" ".join(w),)], "text string")).collect()
    assert [tuple(x) for x in row.runs] == [(0, 977 * 40, 977), (977 * 40 + 1, 5000, 1)]
    assert tuple(row.strongest) == (977 * 40 + 1, 5000, 1) and row.collapsed == " ".join([*block, "end", "z"])


def test_runs_query_against_the_contract(spark, sf):
    docs = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r.doc_id: r for r in QUERIES["op12_grammar_runs"](spark, sf).collect()}
    assert len(got) == len(docs)
    hit = 0
    for d in docs:
        w = re.findall(WORD, d["text"] or "")
        h, n = zlib.crc32(str(d["doc_id"]).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            hit += 1
        if n > 500:  # brute force is quadratic
            continue
        want, r = brute_runs(w), got[d["doc_id"]]
        best = min(want, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, (r.start, r.length, r.period)) == (len(want), best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{p}\n" for s, k, p in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(w, want).encode()).hexdigest()
    assert hit > 5
    rows = spark.createDataFrame([(None, "a b"), (7, None), (8, "")], "doc_id long, text string")
    assert [tuple(r) for r in with_planted_runs(rows).collect()] == [(None, "a b"), (7, None), (8, "")]


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def ids_of(codec, text):
    return np.frombuffer(codec.encode(text), "<u4").tolist()


def test_pieces_against_the_library(model, library):
    codec = pieces.Codec(model, memo_bytes=20_000)
    rng = random.Random(3)
    signs = list("  \n\t\ra▁bet.,;_²中文漢字あア😀é\x00�'\"<0x0A>s") + ["ing", "tion", "St.", "__."]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += [" " * k + "to" + " " * (k // 2) for k in range(90)]
    texts += ["".join(rng.choice(model.pieces[259:]) for _ in range(rng.randrange(12))) for _ in range(3000)]
    for text in texts:
        ids = ids_of(codec, text)
        assert ids == library.encode(text), text
        assert codec.decode(ids) == library.decode(ids), text
    for _ in range(3000):
        ids = [rng.randrange(32000) if rng.random() < 0.6 else rng.randrange(300) for _ in range(rng.randrange(8))]
        assert codec.decode(ids) == library.decode(ids), ids


@functools.cache
def both():
    path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.Codec(pieces.load_model(path)), sentencepiece.SentencePieceProcessor(model_file=path)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text_as_the_library(text):
    codec, lib = both()
    assert ids_of(codec, text) == lib.encode(text)


def test_piece_columns_and_edges(spark, edge_docs, no_docs, model, library):
    out = pieces.round_trip(edge_docs, model)
    assert set(out.columns) == {*edge_docs.columns, "decoded"}
    rows = out.collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids)
    apart = pieces.decode(pieces.encode(edge_docs, model), model)
    assert sorted(map(str, apart.select(*out.columns).collect())) == sorted(map(str, rows))
    odd = spark.createDataFrame([(None,), ([],), ([None, 300],)], "ids array<int>")
    assert [r.decoded for r in pieces.decode(odd, model).collect()] == ["", "", library.decode([300])]
    assert pieces.round_trip(no_docs, model).count() == 0


def test_pieces_query_against_the_library(spark, sf, library):
    docs = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r.doc_id: r for r in QUERIES["op13_prefix_table_pieces"](spark, sf).collect()}
    for d in docs:
        ids, r = library.encode(d["text"] or ""), got[d["doc_id"]]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_characteristic_polynomial_of_small_matrices(spark):
    rng = random.Random(4)
    for d in (1, 2, 3, 7):
        a = [[rng.randrange(-9, 10) for _ in range(d + 2)] for _ in range(d)]
        m = [[sum(x * y for x, y in zip(r, s, strict=True)) for s in a] for r in a]
        poly = whitening.characteristic_polynomial(spark, m)
        assert np.allclose(np.array(poly[::-1], float), np.poly(np.array(m, float)), rtol=1e-6, atol=1e-3)
        want = sorted(np.linalg.eigvalsh(np.array(m, float)), reverse=True)
        assert np.allclose([x / 2**b for x, b in whitening.largest_roots(poly, d)], [w for w in want if w > 1e-9])


def test_repeated_and_missing_roots(spark):
    m = [[5, 0, 0, 0], [0, 5, 0, 0], [0, 0, 2, 0], [0, 0, 0, 0]]
    poly = whitening.characteristic_polynomial(spark, m)
    roots = whitening.largest_roots(poly, 8)
    assert [round(a / 2**b, 9) for a, b in roots] == [5, 5, 2]
    v = np.array([[float(x) for x in r] for r in whitening.null_vectors(m, roots)])
    assert np.allclose(v @ v.T, np.eye(3), atol=1e-15) and np.allclose(v @ np.array(m), v * np.array([[5], [5], [2]]))


def test_whitening_query_against_numpy(spark, sf):
    table = pq.read_table(f"{sf}/embeddings.parquet")
    x = np.floor(1024 * np.array(table["embedding"].to_pylist(), np.float64)) + 100000
    rows = QUERIES["op11_polynomial_whitening"](spark, sf).toPandas()
    centred = x - x.mean(0)
    cov = centred.T @ centred / len(x)
    values, vectors = (a[..., ::-1] for a in np.linalg.eigh(cov))
    want = centred @ vectors[:, :8] / np.sqrt(values[:8])
    got = rows.pivot(index="vec_id", columns="component", values="whitened").loc[table["vec_id"].to_pylist()].to_numpy()
    assert np.abs(got - want * np.sign((got * want).sum(0))).max() < 1e-9
    assert np.abs(got.T @ got / len(x) - np.eye(8)).max() < 1e-9 and rows.identity_error.max() < 1e-12
    assert np.allclose(rows.groupby("component").explained.first(), values[:8] / values.sum(), rtol=1e-9)
    whole = x.astype(int)
    deviation = ((len(x) * whole - whole.sum(0)) ** 2).sum(1)
    assert dict(zip(rows.vec_id, rows.deviation, strict=True)) == dict(zip(table["vec_id"].to_pylist(), deviation.tolist(), strict=True))
    assert set(rows.n) == {len(x)}


VECTORS = T.StructType([T.StructField("id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("n", T.StringType())])


def test_whitening_edges(spark):
    rng = random.Random(6)
    good = [[rng.random() - 0.5, rng.random(), 0.25] for _ in range(40)]
    bad = [None, [], [None, 1.0, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0]]
    rows = [(i, v, "x") for i, v in enumerate([*good, *good[:2], *bad])]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    model = whitening.fit(df)
    assert model.n == 42 and len(model.eigenvalues) == 2 and model.error < 1e-12  # the third dimension is constant
    out = whitening.whiten(df, model)
    assert out.columns == ["id", "embedding", "n", "deviation", "whitened"] and out.count() == 42
    same = spark.createDataFrame([(1, [0.5, 0.5], ""), (2, [0.5, 0.5], "")], VECTORS)
    flat = whitening.fit(same)
    assert flat.eigenvalues == [] and [(r.deviation, r.whitened) for r in whitening.whiten(same, flat).collect()] == [(0, [])] * 2
    empty = df.filter("id < 0")
    assert whitening.fit(empty) is None and whitening.whiten(empty, None).count() == 0
    # exact sums beyond 64 bits
    huge = spark.createDataFrame([(1, [2.0**45, 1.0], ""), (2, [-(2.0**45), 3.0], ""), (3, [7.0, 0.0], "")], VECTORS)
    n, sums, products = whitening.moments(huge, "embedding", 1024.0, 100_000)
    assert (n, sums, products[0]) == (3, [7168, 4096], [2 * 2**110 + 7168**2, 2**55 * 1024 - 2**55 * 3072])
    with pytest.raises(Exception, match="several lengths"):
        whitening.fit(spark.createDataFrame([(1, [1.0], ""), (2, [1.0, 2.0], "")], VECTORS))
