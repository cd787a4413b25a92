"""Tokens by round trip, classifiers by held-out rows."""

import random
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from arealoom.llm import bpe, hashed, langid, ordinal, queries, toxicity

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def vocab():
    return bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(vocab):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(vocab.tokens)}, special_tokens={})


def ids(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_encoding_is_exact(vocab, reference):
    codec, rng = bpe.Codec(vocab, PATTERN), random.Random(1)
    texts = ["".join(rng.choice("aabb  cde\n\t12 .,!éèßあ中\x85\x1c 😀'st") for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(30)) for _ in range(500)]
    texts += ["a" * 3000, "ab" * 3000, " " * 5000, "the" * 2000, "x" + "ing" * 20000, "=" * 999, "abcabcab" * 500]
    for text in texts:
        packed = codec.encode(text)
        assert ids(packed) == reference.encode_ordinary(text)
        assert codec.decode(packed) == text.encode()


def test_memos_are_emptied_when_full(vocab, reference):
    # five entries of about 220 bytes
    codec, text = bpe.Codec(vocab, PATTERN, memo_bytes=1150), "quite a few different words in one unremarkable sentence, again and again"
    assert ids(codec.encode(text)) == reference.encode_ordinary(text)
    assert len(codec.memo) <= 5 and codec.memo.held <= 1150 and len(codec.fits) <= 5


def test_a_small_vocabulary_and_bad_ones():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"xyz": 259}
    small = bpe.vocabulary(ranks)
    assert (small.left[256], small.right[256]) == (97, 98) and small.left[259] == -1
    codec = bpe.Codec(small, r"\S+")
    assert ids(codec.encode("abcx")) == [258, 120] and ids(codec.encode("xyz")) == [259] and ids(codec.encode("xyza")) == [120, 121, 122, 97]
    with pytest.raises(ValueError):
        bpe.vocabulary({b"a": 0})


def test_ids_checked_in_the_worker(edge_docs, edge_rows, no_docs, vocab, reference):
    coded = bpe.checked(edge_docs, vocab, PATTERN, memo_bytes=10_000)
    assert set(coded.columns) == {c for c in edge_docs.columns if c != "text"} | {"ids", "intact"}
    rows = coded.collect()
    assert all(r.intact for r in rows)
    want = [(str(i), reference.encode_ordinary(t or "")) for i, t in edge_rows]
    assert sorted(want) == sorted((str(r.doc_id), ids(r.ids)) for r in rows)
    assert bpe.checked(no_docs, vocab, PATTERN).count() == 0


def test_tokens_of_a_table(edge_docs, edge_rows, no_docs, vocab, reference):
    coded = bpe.round_trip(edge_docs, vocab, PATTERN)
    assert coded.columns == [*[c for c in edge_docs.columns if c != "ids"], "ids", "decoded"]
    got = sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in coded.collect())
    want = [(str(i), struct.pack(f"<{len(x)}I", *x), (t or "").encode()) for i, t in edge_rows for x in [reference.encode_ordinary(t or "")]]
    assert got == sorted(want)
    again = bpe.decode(bpe.encode(edge_docs.select("doc_id", "text"), vocab, PATTERN), vocab)
    assert sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in again.collect()) == got
    assert bpe.round_trip(no_docs, vocab, PATTERN).count() == 0


def test_languages_of_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(docs.filter(langid.held_out(F.col("doc_id"))), model)
    assert found.filter("lang_pred = lang").count() >= 0.97 * found.count()
    assert found.filter("accepted").count() >= 0.97 * found.count()


def test_language_edges(spark, sf, edge_docs, edge_rows, no_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs)
    got = langid.predict(edge_docs, model)
    assert got.columns == [*[c for c in edge_docs.columns if c not in ("score", "accepted")], "lang_pred", "score", "accepted"]
    rows = got.collect()
    assert len(rows) == len(edge_rows)
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred in model.languages and 0 <= r.score <= 1
    assert langid.predict(no_docs, model).count() == 0
    blank = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.predict(edge_docs, blank).select("lang_pred").collect()} == {"und"}
    assert langid.predict(spark.createDataFrame([("123 +-*",)], "text string"), model).first().lang_pred == "und"


def test_rejection_is_calibrated():
    rng = np.random.Generator(np.random.PCG64(1))
    rows = [(lang, np.sort(rng.choice(np.arange(low, low + 60), 20, replace=False)), np.full(20, 0.05)) for lang, low in (("a", 0), ("b", 50)) for _ in range(100)]
    model = langid.train(rows)
    assert 0 <= model.threshold <= langid.HIGHEST_THRESHOLD and 0.5 <= model.temperature <= 10.0001


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    rows = spark.read.parquet(f"{sf}/documents.parquet").join(labels, "doc_id").select("doc_id", "text", "junk", "toxic")
    chain = toxicity.fit(rows.filter("doc_id % 3 <> 0").select("doc_id", "junk", "toxic"), rows.select("doc_id", "text"), ["junk", "toxic"])
    got = toxicity.predict(rows.filter("doc_id % 3 = 0"), chain)
    clean = got.filter("toxic = 0")
    assert clean.filter("is_toxic").count() <= 0.05 * clean.count()
    toxic = got.filter("toxic = 1 AND junk = 0")
    assert toxic.filter("is_toxic").count() >= 0.6 * toxic.count()
    junk = got.filter("junk = 1")
    assert junk.filter("is_junk").count() >= 0.8 * junk.count()


def test_a_later_model_uses_the_earlier_category():
    rng = np.random.Generator(np.random.PCG64(2))
    labels = np.column_stack([rng.integers(0, 2, 400)] * 2).astype(float)
    bags = [(np.array([int(a), 10 + i % 7]), np.ones(2)) for i, a in enumerate(labels[:, 0])]
    chain = toxicity.train(bags, labels, ["first", "second"])
    assert len(chain.links[0]) == 1 and len(chain.links[1]) == 2 and chain.links[1][0] > 0


def test_classifier_edges(spark, sf, edge_docs, edge_rows, no_docs):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = spark.read.parquet(f"{sf}/documents.parquet").join(labels, "doc_id")
    chain = toxicity.fit(rows.select("doc_id", "toxic"), rows.select("doc_id", "text"), ["toxic"])
    got = toxicity.predict(edge_docs, chain).collect()
    assert len(got) == len(edge_rows)
    assert all(r.p_toxic == 0 and not r.is_toxic for r in got if not (r.text or "").strip())
    nothing = toxicity.fit(rows.filter("doc_id < 0").select("doc_id", "toxic"), rows.select("doc_id", "text"), ["toxic"])
    assert toxicity.predict(edge_docs, nothing).filter("is_toxic").count() == 0
    assert toxicity.predict(no_docs, chain).count() == 0
    graded = rows.select("doc_id", F.when(F.col("quality") == 0, 0).otherwise(2 - F.col("toxic")).alias("grade"))
    model = ordinal.fit(graded, rows.select("doc_id", "text"), 3, 2)
    assert (np.diff(model.thresholds) > 0).all()
    found = ordinal.predict(edge_docs, model).collect()
    assert all((r.expected_grade, r.p_wanted, r.selected) == (0, 0, False) for r in found if not (r.text or "").strip())
    assert all(0 <= r.p_wanted <= r.expected_grade <= 2 for r in found)
    assert ordinal.predict(no_docs, model).count() == 0


def test_grades_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    grade = F.when(F.col("quality") == 0, 0).otherwise(2 - F.col("toxic"))
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", grade.alias("grade"))
    rows = spark.read.parquet(f"{sf}/documents.parquet").join(labels, "doc_id").select("doc_id", "text", "grade")
    got = ordinal.predict(rows.filter("doc_id % 3 = 0"), ordinal.fit(rows.filter("doc_id % 3 <> 0").drop("text"), rows.drop("grade"), 3, 2))
    means = {r.grade: r.m for r in got.groupBy("grade").agg(F.avg("expected_grade").alias("m")).collect()}
    assert means[0] < 0.5 < means[2]
    good = got.filter("grade = 2")
    assert good.filter("selected").count() >= 0.95 * good.count()


def test_bags_count_words():
    data = np.frombuffer(b"One two two", np.uint8)
    features, first = hashed.terms(data, np.array([0, 11]))
    assert first.tolist() == [0, 3] and hashed.bag(features[:1], 0, 3)[1].tolist() in ([1, 2], [2, 1])


def test_least_rows_are_those_of_the_least_hashes(spark):
    rows = spark.range(4000).select(F.col("id").alias("key"), F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("g"))
    rows = rows.union(spark.createDataFrame([(-1, "once")], "key long, g string"))
    got = {}
    for r in hashed.least_rows(rows, "g", "key", 50).collect():
        got.setdefault(r.g, set()).add(r.key)
    want = {}
    for r in rows.withColumn("h", F.xxhash64("key")).orderBy("h").collect():
        if len(want.setdefault(r.g, set())) < 50:
            want[r.g].add(r.key)
    assert got == want


def test_labels_without_a_grade_are_not_learnt_from(spark, tmp_path, monkeypatch):
    labels = [(1, 0, None), (2, 1, 1), (3, 1, 0), (4, None, 0), (5, None, None), (6, 1, None), (7, None, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    monkeypatch.setattr(queries.ordinal, "fit", lambda rated, *a, **b: seen.append(rated))
    monkeypatch.setattr(queries.ordinal, "predict", lambda df, model: df.withColumns(dict.fromkeys(["expected_grade", "p_wanted", "selected"], F.lit(0))))
    queries.op8_ordinal_quality(spark, str(tmp_path))
    grades = {r.doc_id: r.grade for r in seen[0].collect()}
    assert grades == {1: 0, 2: 1, 3: 2, 4: None, 5: None, 6: None, 7: None}
