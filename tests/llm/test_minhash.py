"""Weighted MinHash against all pairs, with the operator's own weights."""

import random

import numpy as np
import pyarrow as pa
import pytest
from coinloom.llm import weighted_minhash as wm


def frame(spark, texts, first=0):
    return spark.createDataFrame([(i + first, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)


def edited(words, n, rng):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**9)}"
    return out


def plain_weights(texts):
    """Each text's shingles with count times weight, in plain Python: 1.25 for a shingle of one text or of at
    most one in 4,096, down to 1 for one of all texts."""
    sets = []
    for t in texts:
        w, have = t.lower().split(), {}
        for i in range(len(w) - 4):
            k = tuple(w[i : i + 5])
            have[k] = have.get(k, 0) + 1
        sets.append(have)
    df, n = {}, len(texts)
    for have in sets:
        for k in have:
            df[k] = df.get(k, 0) + 1
    fall = lambda k: min(1.0, -np.log(df[k] / n) / np.log(max(2, min(n, wm.RARE))))
    return [{k: c * (1 + wm.IDF_GAIN * fall(k)) for k, c in have.items()} for have in sets]


def plain_jaccard(a, b):
    low = sum(min(w, b[k]) for k, w in a.items() if k in b)
    return low / (sum(a.values()) + sum(b.values()) - low)


def classes_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def test_weights_against_plain_python(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = [" ".join(edited(base, 6, rng)) for _ in range(40)] + [" ".join(rng.choices(base, k=90)) for _ in range(20)]
    freq = wm.document_frequencies(frame(spark, texts))
    sets, plain = wm.ShingleSets(pa.array(texts), freq), plain_weights(texts)
    for i in range(len(texts)):
        got = sets.similarity(i, np.arange(len(texts)))
        want = [plain_jaccard(plain[i], plain[j]) for j in range(len(texts))]
        assert np.abs(got - want).max() < 0.01  # the sketch's counters are shared


def test_weights_are_alike_at_every_size():
    rng = np.random.default_rng(1)
    width, n = 1 << wm.SKETCH_BITS, 10**10
    share = np.full((2, width), 400 / width) * rng.uniform(0.9, 1.1, (2, width))  # rare shingles fill the counters
    share[:, 7] += 0.01  # and one stands in 1 % of all documents
    small, large = (wm.Frequencies.of(np.round(share * m), m).weights[0] for m in (10**6, n))
    assert abs(small[7] - large[7]) < 0.002 and 1.12 < large[7] < 1.16
    assert np.median(large) > 1.18 and abs(np.median(small) - np.median(large)) < 0.01


@pytest.mark.parametrize("block", [2048, 64])
def test_loose_group_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(wm, "BLOCK", block)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(edited(base, rng.choice([1, 2, 3, 3, 4, 5, 6]), rng)) for _ in range(300)]
    texts += [" ".join(f"x{rng.randrange(9999)}" for _ in range(80)) for _ in range(50)]
    docs = frame(spark, texts)
    sets = wm.ShingleSets(pa.array(texts), wm.document_frequencies(docs))
    links = [(i, j) for i in range(len(texts)) for j in np.flatnonzero(sets.similarity(i, np.arange(len(texts))) >= 0.8 - 1e-9) if j > i]
    want = classes_of(len(texts), links)
    assert len(links) > 1000 and 100 < len(set(want)) < 300
    got = {r.doc_id: r.class_id for r in wm.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_recall_just_above_the_threshold(spark):
    rng = random.Random(5)
    texts, pairs = [], []
    while len(texts) < 800:
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(150, 400))]
        texts += [" ".join(base), " ".join(edited(base, max(1, round(len(base) * 0.0215)), rng))]
    docs = frame(spark, texts)
    sets = wm.ShingleSets(pa.array(texts), wm.document_frequencies(docs))
    for i in range(0, len(texts), 2):
        if 0.8 <= sets.similarity(i, np.array([i + 1]))[0] <= 0.825:
            pairs.append(i)
    got = {r.doc_id: r.class_id for r in wm.near_duplicates(docs).collect()}
    found = sum(got[i] == got[i + 1] for i in pairs)
    print(f"{found} of {len(pairs)} pairs of 0.8 to 0.825")
    assert len(pairs) >= 60 and found >= len(pairs) - 1
    assert all((got[i] == got[i + 1]) <= (sets.similarity(i, np.array([i + 1]))[0] >= 0.8 - 1e-9) for i in range(0, len(texts), 2))


def test_a_group_gives_fewer_links_than_members(spark):
    """What is decided in a group comes out as links that span it, not as its pairs."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(edited(base, rng.randint(1, 4), rng)) for _ in range(200)]
    docs = frame(spark, texts)
    freq = wm.document_frequencies(docs)
    rows = wm.signatures(docs.selectExpr("doc_id", "text", "cast(doc_id as string) as print"), freq).collect()
    group = spark.createDataFrame(
        [(r.bands[0], 0, 0, r.doc_id, r.sig, r.bands, r.doc_id, texts[r.doc_id]) for r in rows],
        "bucket long, _bi int, _bj int, node long, sig binary, bands array<long>, component long, text string",
    )
    same = group.withColumn("bucket", group.bands[0]).groupBy("bucket").count().orderBy("count", ascending=False).first()
    one = group.filter(group.bucket == same["bucket"]).coalesce(1).sortWithinPartitions("bucket", "_bi", "_bj", "node")
    assert wm._decided(one, freq, 0.8).count() < same["count"]


def test_likely_keeps_all_that_are_wanted_and_few_others(spark):
    rows = spark.range(200_000).selectExpr("id as node", "md5(cast(id as string)) as print", "'text' as text")
    wanted = rows.filter("node % 10 = 0").select("node", "print")
    kept = wm.likely(rows, wanted, "node", "print")
    assert kept.columns == rows.columns
    assert kept.filter("node % 10 = 0").count() == 20_000 and kept.filter("node % 10 != 0").count() < 2_000
