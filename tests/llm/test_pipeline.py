"""Queries against their SQL, and the pipeline against brute force."""

import os
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from arealoom.llm.queries import ORACLES, QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import oracle  # noqa: E402


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert oracle.differences(df, oracle.connect(sf), ORACLES[name]) is None
    elif "whitening" in name:
        assert df.count() == 8 * spark.read.parquet(f"{sf}/embeddings.parquet").count()
    else:
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        assert df.count() == docs.count() and df.join(docs, "doc_id", "left_anti").count() == 0


def test_there_is_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages_and_their_decisions(spark, sf):
    from tests_llm_brute import brute_cut, brute_groups, brute_hits

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "byte_bpe"]
    letters = docs.filter(F.col("text").rlike(r"\p{L}"))
    told = stages["language_id"](spark, docs.union(docs.limit(1).withColumn("text", F.lit("12 34")).withColumn("doc_id", F.lit(-5).cast("long"))), sf)
    assert told.columns == docs.columns and told.filter("doc_id = -5").count() == 0
    assert told.count() >= 0.98 * letters.count()

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    single = stages["minhash_near_dedup"](spark, docs, sf)
    kept = {i for i, root in brute_groups(rows, 5).items() if i == root}
    assert single.columns == docs.columns and {r.doc_id for r in single.select("doc_id").collect()} == kept

    few = docs.filter("doc_id < 60")
    cut = stages["suffix_array_dedup"](spark, few, sf)
    want = {i: t.decode("utf-8", "ignore") for i, t in brute_cut([(i, t) for i, t in rows if i < 60]).items()}
    got = cut.collect()
    assert cut.columns == docs.columns and {r.doc_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = stages["benchmark_decontamination"](spark, docs, sf)
    bad = {i for i, n, h in brute_hits(rows, items) if h and 20 * h >= n}
    assert bad and {r.doc_id for r in clean.select("doc_id").collect()} == {i for i, _ in rows} - bad

    coded = stages["byte_bpe"](spark, docs, sf)
    assert coded.count() == docs.count() and coded.filter("NOT intact OR n_tokens * 4 <> octet_length(ids)").count() == 0


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark, sf):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(1, a, "en"), (5, a, "en"), (5, b, "en"), (7, b, "en"), (8, c, "en"), (8, c, "de"), (9, "", "en"), (None, a, "en"), (None, a, "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = dict(corpus_pipeline.STAGES)["minhash_near_dedup"](spark, docs, sf)
    assert got.columns == docs.columns
    want = [(1, a, "en"), (5, b, "en"), (8, c, "de"), (9, "", "en"), (None, a, "en"), (None, a, "en")]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.text, r.lang)) for r in got.collect())


def test_the_whole_pipeline(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert 0 < out.count() <= 200 and out.filter("NOT intact").count() == 0
