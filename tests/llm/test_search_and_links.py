"""Near-duplicates, decontamination, pivot search and sharding against brute force."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealoom.llm import decontaminate, oddsketch, pivots, rendezvous


def shingle_sets(rows, k):
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def components(rows, k, percent):
    sets = shingle_sets(rows, k)
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, x), (b, y) in itertools.combinations([(i, s) for (i, _), s in zip(rows, sets, strict=True) if i is not None and s], 2):
        if 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    return sorted((str(i), len(s), str(None if i is None else find(i))) for (i, _), s in zip(rows, sets, strict=True))


@pytest.mark.parametrize("k", [1, 4, 5])
def test_near_duplicates(edge_docs, edge_rows, k):
    got = oddsketch.near_duplicates(edge_docs, k=k).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == components(edge_rows, k, 80)
    assert all(r.kept == (r.component_id == r.doc_id) for r in got if r.doc_id is not None)
    assert all(r.kept for r in got if r.doc_id is None)


def test_links_between_members_that_miss_their_leader(spark):
    """A chain of copies, each like the next but not like the first, is one component."""
    rng = random.Random(4)
    words, rows = [f"w{i}" for i in range(300)], []
    for i in range(40):
        rows.append((i, " ".join(words)))
        for at in rng.sample(range(300), 4):
            words[at] = f"n{i}_{at}"
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = oddsketch.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == components(rows, 4, 80)


def test_members_meet_part_by_part(spark, monkeypatch):
    """Two families around leaders that their members are not like enough: parts of few rows or bytes meet
    by sketches, and only members with someone near send their sets."""
    rng = random.Random(6)
    base, rows = [f"w{i}" for i in range(200)], []
    for family in range(5):
        root = list(base)
        for at in rng.sample(range(200), 14):
            root[at] = f"f{family}_{at}"
        for copy in range(12):
            words = list(root)
            for at in rng.sample(range(200), 3):
                words[at] = f"c{family}_{copy}_{at}"
            rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = components(rows, 4, 80)
    for limit, value in (("PART_ROWS", 4), ("PART_BYTES", 4096)):
        monkeypatch.setattr(oddsketch, limit, value)
        got = oddsketch.near_duplicates(docs).collect()
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want


def test_sketches_let_true_pairs_through(spark):
    assert oddsketch.sketch_limit(0.8) < 160
    rng = random.Random(8)
    rows, i = [], 0
    for _ in range(60):
        base = [f"t{rng.random()}" for _ in range(200)]
        other = [w if rng.random() > 0.02 else f"u{rng.random()}" for w in base]
        rows += [(i, " ".join(base)), (i + 1, " ".join(other))]
        i += 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = oddsketch.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == components(rows, 4, 80)


def hits(rows, items, width):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = {}
    for item, text in items:
        w = words(text)
        size = min(width, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes, out = {len(w) for w in windows}, []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])] - {None}
        out.append((str(doc), len(w), len(hit), ",".join(sorted(map(str, found)))))
    return sorted(out)


@pytest.mark.parametrize("width", [2, 13])
def test_contaminated_words(spark, edge_docs, edge_rows, width):
    by_id = {i: t for i, t in edge_rows}
    items = [(1, by_id[3][40:260]), (2, by_id[4][:200].upper()), (10, "word"), (11, None), (12, ""), (13, "be be"), (None, by_id[5][50:170]), (1, "no such thing here")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.mark(edge_docs, bench, width=width)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, ",".join(r["items"])) for r in got.collect()) == hits(edge_rows, items, width)
    clean = decontaminate.clean(edge_docs, bench, width=width)
    assert clean.columns == edge_docs.columns
    bad = Counter((d, n, h) for d, n, h, _ in hits(edge_rows, items, width) if h and 20 * h >= n)
    assert clean.count() == len(edge_rows) - sum(bad.values())


def test_decontamination_of_empty_tables(spark, edge_docs, edge_rows, no_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.mark(edge_docs, bench).filter("n_hit > 0").count() == 0
    assert decontaminate.clean(edge_docs, bench).count() == len(edge_rows)
    assert decontaminate.mark(no_docs, bench).count() == 0
    assert oddsketch.near_duplicates(no_docs).count() == 0


def test_top_k_with_ties_nulls_and_repeats(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.5, 0.25, 0.0]) for _ in range(6)]) for i in range(700)]
    rows += [(700, None), (701, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (702, [float("nan")] * 6), (703, [float("inf")] * 6), (None, [1.0] * 6), (704, [0.5, 0.5]), (200, rows[5][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(4)
    got = {}
    for r in pivots.top_k(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    valid = [(i, [int(1024 * x // 1) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and abs(x) < 2 for x in v)]
    want = {}
    for q, x in [(q, x) for q, x in valid if q % 100 == 0]:
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), i) for i, y in valid if i != q)[:10]
        want.setdefault(q, []).extend((n, i, -s) for n, (s, i) in enumerate(scored, 1))
    assert {q: sorted(v) for q, v in got.items()} == {q: sorted(v) for q, v in want.items()}
    assert pivots.top_k(df.filter("vec_id < 0"), F.col("vec_id") % 100 == 0).count() == 0
    few = pivots.top_k(df.filter("vec_id < 4"), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in few] == [1, 2, 3]


@pytest.mark.parametrize("size", [1e3, 1e5, 2.0**21])
def test_search_is_exact_for_large_vectors(spark, size):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-s, s) for s in [1.2 * size] + [size / 4] * 5]) for i in range(700)]
    for i in range(0, 700, 7):  # neighbours that differ by little
        rows[i] = (i, [x + rng.uniform(-1, 1) / 512 for x in rows[3][1]])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = {}
    for q, x in whole[::10]:
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in whole if i != q)[:10]
        want[q] = [(n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    got = {}
    for r in pivots.top_k(df, F.col("vec_id") % 10 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == want


def test_slack_grows_with_the_norms():
    top = 1e14
    assert pivots.slack(top, 64) > 2 * np.spacing(np.float32(2 * math.sqrt(top)))
    assert pivots.slack(1e6, 64) == pivots.SLACK


def test_passes_follow_the_number_of_queries(spark, monkeypatch):
    calls, search = [], pivots._search
    monkeypatch.setattr(pivots, "_search", lambda *a: calls.append(1) or search(*a))
    monkeypatch.setattr(pivots, "PASS_QUERIES", 8)
    rows = [(i, [float(i % 13), float(i % 7)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert pivots.top_k(df, F.col("vec_id") % 100 == 0).count() == 40
    assert len(calls) == 1


def test_shards(edge_docs, edge_rows, no_docs):
    weights = {0: 1.0, 1: 1.0, 2: 2.0}
    placed = rendezvous.assign(edge_docs.select("doc_id", "text", "block"), "doc_id", weights)
    numbered = rendezvous.number(placed.select("doc_id", "shard", F.md5("text").alias("digest")), "doc_id").collect()
    assert len(numbered) == len(edge_rows)
    for shard in {r.shard for r in numbered}:
        assert sorted(r.slot for r in numbered if r.shard == shard) == list(range(sum(r.shard == shard for r in numbered)))
    assert len({r.shard for r in numbered if r.doc_id == 34}) == 1
    assert rendezvous.number(rendezvous.assign(no_docs.select("doc_id"), "doc_id", weights), "doc_id").count() == 0


def test_shards_follow_their_weights_and_move_little(spark):
    keys = spark.range(20000).withColumnRenamed("id", "key")
    before, after = {s: 1.0 + (s == 3) for s in range(5)}, {s: 1.0 + (s == 3) for s in range(6)}
    share = {r.shard: r["count"] / 20000 for r in rendezvous.assign(keys, "key", before).groupBy("shard").count().collect()}
    assert all(abs(share[s] - before[s] / 6) < 0.02 for s in before)
    moves = rendezvous.moved(keys, "key", before, after).collect()
    assert all(r.from_shard == r.to_shard or r.to_shard == 5 for r in moves)
    with pytest.raises(ValueError):
        rendezvous.assign(keys, "key", {})


def test_copies_of_one_row_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(rendezvous, "COPIES", 7)
    rows = spark.range(50).selectExpr("CAST(NULL AS LONG) AS key", "0 AS shard").union(spark.range(9).selectExpr("id", "0"))
    assert sorted(r.slot for r in rendezvous.number(rows, "key").collect()) == list(range(59))
