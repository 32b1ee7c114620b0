import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from coinloom.llm import lexical
from hypothesis import given, settings
from hypothesis import strategies as st

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(UPPER))


def plainly(docs, items, keep=10):
    """Every item against every document, one by one."""
    held = [(d, Counter(words(t))) for d, t in docs]
    n = [sum(c.values()) for _, c in held]
    big_n, big_l = sum(x > 0 for x in n), sum(n)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for i, terms in asked.items():
        scored = []
        for (d, c), size in zip(held, n, strict=True):
            score = 0
            for t in terms & set(c):
                m = 100 - 90 + (90 * size * big_n) // big_l
                score += math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:keep])]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB9 -_é€😀\x00\x7f\n"), max_size=20)), max_size=6))
def test_terms(texts):
    got, doc = lexical.terms(pa.array(texts, pa.string()))
    want = [(k, w.encode()) for k, t in enumerate(texts) for w in words(t)]
    assert list(zip(doc.tolist(), got.to_pylist(), strict=True)) == want


def corpus(seed, n, vocabulary):
    rng = np.random.default_rng(seed)
    return [" ".join(f"w{int(k)}" for k in rng.zipf(1.4, rng.integers(0, 40)) % vocabulary) for _ in range(n)]


@pytest.mark.parametrize(("tile_terms", "tile_docs"), [(1024, 256), (3, 7)])
def test_against_every_pair(spark, monkeypatch, tile_terms, tile_docs):
    monkeypatch.setattr(lexical, "TILE_TERMS", tile_terms)
    monkeypatch.setattr(lexical, "TILE_DOCUMENTS", tile_docs)
    texts = corpus(1, 300, 60)
    docs = [(k - 40, t) for k, t in enumerate(texts)] + [(1000 + k, texts[5]) for k in range(40)]  # ties across the cut
    docs += [(None, texts[5]), (7, None), (8, ""), (9, "-- !"), (12, "Only HERE wörter"), (12, "Only HERE wörter")]
    items = [(k, t) for k, t in enumerate(corpus(2, 40, 80))] + [(50, texts[5]), (51, None), (52, "nowhere"), (53, "WÖRTER wörter ONLY"), (None, "w1 w2 w3"), (54, "w1"), (54, "w9 w7")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as terms", "1 as n", "2 as item").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 as term")
    want = plainly(docs, items)
    assert found(lexical.search(d, i)) == want
    monkeypatch.setattr(lexical, "BLOCK_CELLS", 40)  # several blocks of items
    assert found(lexical.search(d, i)) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert found(lexical.search(none, items)) == []
    assert found(lexical.search(some, items.limit(0))) == []
    assert found(lexical.search(some, spark.createDataFrame([(1, "z"), (2, None)], "item_id long, text string"))) == []
    only = spark.createDataFrame([(1, "--"), (2, None)], "doc_id long, text string")
    assert found(lexical.search(only, items)) == []


def test_vocabulary_is_cut_before_sums_pass_the_exact_range():
    n = 5000
    weights = np.full(n, 2_000_000, np.int64)  # far above any real weight
    tiles = lexical.tiles(np.zeros(n, np.int64), np.arange(n), weights)
    assert sum(len(words) for t in tiles for words, _ in t.parts) == n
    assert all(matrix.sum() * lexical.IMPACT < 2**53 for t in tiles for _, matrix in t.parts)


def test_best_keeps_ties_by_id():
    best = lexical.Best(1, 3)
    rng = np.random.default_rng(3)
    ids = rng.permutation(200)
    for part in np.split(ids, 10):
        best.take(np.array([0]), np.full((1, 20), 5), part, np.zeros(20, np.int64))
    assert best.doc[0].tolist() == [0, 1, 2]
