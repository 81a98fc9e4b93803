"""Ranked search (operator 12) against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from larkmetric.llm import queries, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in rows]
    n = sum(bool(c) for _, c in held)
    total = sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            norm = 25 + (75 * c.total() * n) // max(total, 1)
            score = 0
            for term, times in Counter(terms(text)).items():
                if c[term]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += times * weight * ((1_000_000_000 * c[term]) // (1000 * c[term] + 8 * norm))
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(map(repr, out))


def found(df):
    return sorted(repr((r.item_id, r.rank, r.doc_id, r.score)) for r in df.collect())


@pytest.fixture
def items(workers):
    return lambda rows: workers.createDataFrame(rows, "item_id long, text string, doc_id string, score int")


def padded(rows):
    return [(i, t, "x", 1) for i, t in rows]


def test_awkward_rows(workers, corpus, items, monkeypatch):
    """Nulls, empty texts, ties of copies, repeated items and terms, small shards and blocks."""
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", 9000)
    monkeypatch.setattr(ranked_search, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(ranked_search, "LEAF", 6)
    rows = corpus[1]
    asked = [(1, rows[3][1]), (2, rows[50][1]), (2, rows[50][1]), (3, None), (4, ""), (5, "nowhere"), (None, "日本語 ok OK, ok"), (7, rows[-1][1]), (8, "ab" * 3 + " x1a x1a zza")]
    index = ranked_search.build_index(workers.read.parquet(corpus[0]))
    assert index.count() > 3
    assert found(ranked_search.search(index, items(padded(asked)))) == brute(rows, asked)
    assert found(ranked_search.search(index, items(padded(asked)), k=3)) == brute(rows, asked, 3)


def test_many_copies_tie(workers, frame, items, monkeypatch):
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", 500)
    rng = random.Random(2)
    rows = [(rng.randint(-500, 500), rng.choice(["one two three", "one two", "four five six", "two one"])) for _ in range(300)] + [(None, "one two three")]
    asked = [(1, "one two"), (2, "six"), (3, "three three one")]
    assert found(ranked_search.search(ranked_search.build_index(frame(rows, 4)), items(padded(asked)))) == brute(rows, asked)


def test_empty_tables(frame, items):
    nothing = ranked_search.build_index(frame([], 0))
    assert found(ranked_search.search(nothing, items(padded([(1, "a")])))) == []
    blank = ranked_search.build_index(frame([(1, None), (2, "!?")], 1))
    assert found(ranked_search.search(blank, items(padded([(1, "a")])))) == []
    some = ranked_search.build_index(frame([(1, "a")], 1))
    assert found(ranked_search.search(some, items([]))) == []
    # A term that nearly all documents have may weigh nothing.
    common = [(i, "a") for i in range(1200)] + [(2000, "a b")]
    asked = [(1, "A a"), (2, "b a")]
    got = found(ranked_search.search(ranked_search.build_index(frame(common)), items(padded(asked))))
    assert got == brute(common, asked) and len(got) == 1


def test_ids_of_text(workers, items):
    docs = workers.createDataFrame([("b", "cat dog"), ("a", "cat dog"), ("c", "bird"), (None, "cat")], "doc_id string, text string")
    got = ranked_search.search(ranked_search.build_index(docs), items(padded([(1, "dog")]))).collect()
    assert [(r.rank, r.doc_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, "a"), (2, "b")]


def test_windows_cut_no_term(monkeypatch):
    monkeypatch.setattr(ranked_search.arrays, "CHUNK_BYTES", 16)
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab  -é") for _ in range(rng.randint(0, 120))) for _ in range(30)] + ["x" * 100, "", "a " * 40]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0] + [len(t.encode()) for t in texts])
    text, hashes, n = ranked_search._terms(data, bounds)
    for k, t in enumerate(texts):
        assert sorted(n[text == k]) == sorted(Counter(terms(t)).values())
    assert len(np.unique(hashes)) == len({w for t in texts for w in terms(t)})


def test_sparse_tables(monkeypatch):
    """Maxima of any interval of any list, and the intervals that the search opens."""
    rng = np.random.default_rng(4)
    docs = [np.sort(rng.choice(200, n, replace=False)) for n in (1, 2, 57, 200, 130)]
    shard = {
        "terms": np.arange(10, 15).astype(np.uint64).tobytes(),
        "n_of": ranked_search._packed(np.array([len(d) for d in docs])),
        "docs": ranked_search._packed(np.concatenate(docs)),
        "tfs": ranked_search._packed(rng.integers(1, 9, sum(map(len, docs)))),
        "lengths": ranked_search._packed(rng.integers(5, 90, 200), "<i8"),
    }
    posts = ranked_search.Postings(shard, np.arange(9, 16).astype(np.uint64), np.array([5, 900, 0, 700, 20, 300, 8]), 1000, 50_000)
    assert posts.list_of.tolist() == [-1, 0, -1, 1, 2, 3, -1]
    sizes = np.array([1, 57, 200, 130])
    for _ in range(300):
        lst = rng.integers(4)
        a, b = np.sort(rng.choice(sizes[lst] + 1, 2, replace=False)) + sizes[:lst].sum()
        at = posts.largest(np.array([a]), np.array([b]))[0]
        assert a <= at < b and posts.impact[at] == posts.impact[a:b].max()


def test_query_on_tables(workers, corpus, tmp_path, items):
    workers.read.parquet(corpus[0]).write.parquet(f"{tmp_path}/documents.parquet")
    asked = [(k, corpus[1][k][1]) for k in range(0, 60, 7)]
    items(padded(asked)).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert found(queries.op12_ranked_search(workers, str(tmp_path))) == brute(corpus[1], asked)
