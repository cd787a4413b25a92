"""Removal of repeats against brute force."""

import random
import re

import numpy as np
import pytest

from arealoom.llm import substrings, suffixes
from tests_llm_brute import brute_cut


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def removed(units, width):
    """Per document a mask of the units in a window that also starts earlier."""
    seen, out = set(), []
    for doc in units:
        mask = [False] * len(doc)
        for i in range(len(doc) - width + 1):
            window = tuple(doc[i : i + width])
            if window in seen:
                mask[i : i + width] = [True] * width
            seen.add(window)
        out.append(mask)
    return out


def spans(mask):
    return sum(m and (i == 0 or not mask[i - 1]) for i, m in enumerate(mask))


@pytest.mark.parametrize("width", [5, 20])
def test_words_of_repeated_windows_go(edge_docs, edge_rows, width):
    rows = in_order(edge_rows)
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    want = sorted(
        (str(i), len(w), sum(m), " ".join(x for x, gone in zip(w, m, strict=True) if not gone))
        for (i, _), w, m in zip(rows, words, removed(words, width), strict=True)
    )
    got = substrings.remove(edge_docs, width=width)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_text"]
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got.collect()) == want


@pytest.mark.parametrize("width", [10, 100])
def test_bytes_of_repeated_strings_go(edge_docs, edge_rows, width):
    rows = in_order(edge_rows)
    texts = [(text or "").encode() for _, text in rows]
    want = sorted(
        (str(i), len(t), sum(m), spans(m), bytes(x for x, gone in zip(t, m, strict=True) if not gone))
        for (i, _), t, m in zip(rows, texts, removed(texts, width), strict=True)
    )
    got = suffixes.remove(edge_docs, width=width).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == want


def test_other_columns_are_carried(edge_docs, edge_rows):
    got = suffixes.remove(edge_docs, carry=True, as_text=True)
    assert got.count() == len(edge_rows)
    assert got.filter("row.kept <> 'x' OR NOT row.doc_id <=> doc_id").count() == 0
    whole = {r.doc_id: r.kept for r in got.filter("n_removed = 0").collect()}
    assert whole[28] == "word" and whole[26] == "" and whole[None] == ""
    cut = next(r for r in got.collect() if (r.doc_id, r.n_bytes) == (33, len("中文" * 90) * 3))
    assert cut.kept and set(cut.kept) == {"中", "文"}


def test_windows_of_a_busy_minimiser_are_dealt_one_by_one(spark, monkeypatch):
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    passage = letters(300)
    rows = [(i, letters(150) + passage + letters(150)) for i in range(300)]
    rows += [(400 + i, letters(60) + rows[i][1][100:400] + letters(60)) for i in range(20)] + [(500, "xyz" * 9000), (501, "yzx" * 50)]
    made = []
    answer = suffixes.blocks.with_replies
    monkeypatch.setattr(suffixes.blocks, "with_replies", lambda *a: made.append(answer(*a)) or made[-1])
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 20_000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: bytes(r.kept) for r in suffixes.remove(docs).collect()}
    want = brute_cut(rows)
    assert got == want
    size = {}
    for row in made[0].filter("kind = 0").collect():
        count = len(row.extra) // 32
        keys = np.frombuffer(row.extra, np.uint64, count, 16 * count).tolist()
        windows = np.frombuffer(row.extra, np.uint32, count, 28 * count) & suffixes._COUNT
        for key, n in zip(keys, windows.tolist(), strict=True):
            size[key] = size.get(key, 0) + n + 99
    assert max(size.values()) <= 20_000


def test_empty_tables(no_docs):
    assert substrings.remove(no_docs).count() == 0
    assert suffixes.remove(no_docs, carry=True).count() == 0


@pytest.mark.parametrize("symbols", [1, 2, 3, 10, 300])
@pytest.mark.parametrize("small", [0, 512])
def test_suffix_array(monkeypatch, symbols, small):
    monkeypatch.setattr(suffixes, "SMALL_ALPHABET", small)
    rng = random.Random(symbols)
    for _ in range(150):
        text = np.array([rng.randrange(symbols) for _ in range(rng.randint(0, 70))], np.int32)
        order = suffixes.suffix_array(text, symbols)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        shared = suffixes.common_prefixes(text, order) if len(text) else []
        for a, b in zip(order[:-1], order[1:], strict=False):
            x, y = text[a:], text[b:]
            n = min(len(x), len(y))
            differ = np.flatnonzero(x[:n] != y[:n])
            assert shared[b] == (differ[0] if len(differ) else n)


@pytest.mark.parametrize("period", sorted(substrings.COVERS))
def test_covers_hold_every_distance(period):
    cover = substrings.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
