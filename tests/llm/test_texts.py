"""Near-duplicates, passages, decontamination, tokens and toxicity on small tables with known answers."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from coinloom.llm import chaining, decontam, pieces, toxicity, weighted_minhash
from coinloom.llm.kernels import Words, counted, shingles

RNG = random.Random(11)
LEXICON = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 8))) for _ in range(2500)]


def prose(n, seed):
    rng = random.Random(seed)
    return [rng.choice(LEXICON) for _ in range(n)]


def text(words):
    return " ".join(w + ("." if i % 12 == 11 else "") for i, w in enumerate(words))


def documents(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, print string, node int")


def test_shingles_against_plain_python():
    texts = ["", None, "a b", "A, b! c d e f", "é日 ü a_b 9 " * 3, "one"]
    where, _, times = counted(*shingles(Words(pa.array(texts))))
    assert np.bincount(where, times, minlength=6).tolist() == [0, 0, 1, 2, 8, 1]


def edited(words, changes, seed):
    rng, out = random.Random(seed), list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = rng.choice(LEXICON)
    return out


def jaccard(a, b):
    s, t = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(s & t) / len(s | t)


def test_near_duplicates(spark):
    bases = [prose(300, k) for k in range(12)]
    words = [w for k, b in enumerate(bases) for w in [b, *(edited(b, c, 100 * k + c) for c in (1, 2, 3, 4, 30, 60))]]
    texts = [text(w) for w in words]
    texts += [texts[0].upper(), texts[7], texts[7], None, "", "", "few words", "few words", "other few", "!!!"]
    got = {r.doc_id: r for r in weighted_minhash.near_duplicates(documents(spark, texts)).collect()}
    assert len(got) == len(texts)
    n = len(words)
    for i in range(n):
        for j in range(i):
            s = jaccard(words[i], words[j])
            if s >= 0.85:
                assert got[i].class_id == got[j].class_id, (i, j, s)
            if s < 0.3 and i // 7 != j // 7:
                assert got[i].class_id != got[j].class_id
    assert got[n].class_id == 0 and got[n + 1].class_id == got[n + 2].class_id == got[7].class_id
    assert {got[n + k].class_id for k in (3, 4, 5)} == {n + 3} and got[n + 6].class_id == got[n + 7].class_id == n + 6
    assert got[n + 8].kept and got[n + 9].kept
    assert all(r.kept == (r.doc_id == r.class_id) for r in got.values())


def test_near_duplicates_of_odd_tables(spark):
    assert weighted_minhash.near_duplicates(documents(spark, ["x"]).limit(0)).count() == 0
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (None, "z"), (3, "q r s t u v"), (3, "q r s t u v"), (None, "q r s t u v")]
    got = weighted_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.class_id < 0, r.kept) for r in got) == [
        (-1, False, False), (-1, True, True), (-1, True, True), (-1, True, True), (3, False, True), (3, False, True),
    ]


def test_large_near_copy_group_stays_together(spark):
    base = prose(400, 77)
    texts = [text(edited(base, 1 + k % 4, 1000 + k)) for k in range(150)] + [text(prose(200, 5000 + k)) for k in range(30)]
    got = {r.doc_id: r.class_id for r in weighted_minhash.near_duplicates(documents(spark, texts)).collect()}
    assert {got[k] for k in range(150)} == {0} and len({got[k] for k in range(150, 180)}) == 30


def test_passages(spark):
    shared, other = prose(60, 1), prose(55, 2)
    docs = [prose(200, 10 + k) for k in range(8)]
    for k in (0, 3, 5):
        docs[k][40 + k : 40 + k] = shared
    fuzzy = list(other)
    fuzzy[20], fuzzy[40] = "changed", "twice"
    docs[1][10:10], docs[6][150:150] = other, fuzzy
    docs[2][5:5], docs[7][9:9] = prose(30, 3), prose(30, 3)  # too short
    texts = [text(d) for d in docs] + [None, "", text(docs[4])]
    found = chaining.repeated_passages(documents(spark, texts)).collect()
    assert {(r.doc_id, r.other_id) for r in found} == {(3, 0), (5, 0), (6, 1), (10, 4)}
    assert len(found) == 4
    for r in found:
        if r.doc_id in (3, 5):
            assert Words(pa.array([texts[r.doc_id][r.start : r.end]])).hash.tolist() == Words(pa.array([" ".join(shared)])).hash.tolist()
    assert chaining.repeated_passages(documents(spark, ["x"]).limit(0)).count() == 0


def test_parts_of_a_chain_that_fails(spark):
    one, two = prose(60, 31), prose(60, 32)
    texts = [text(prose(90, 40 + k) + one + prose(45, 50 + k) + two + prose(90, 60 + k)) for k in range(2)]
    found = chaining.repeated_passages(documents(spark, texts)).collect()
    assert sorted(r.n_words for r in found) == [60, 60] and all(r.share == 1 for r in found)
    for r in found:
        assert texts[1][r.start : r.end].split()[0].strip(".") in (one[0], two[0])


def test_passages_whose_seeds_were_first_seen_elsewhere(spark):
    shared = prose(60, 71)
    parts = [prose(80, 72) + shared[:33] + prose(80, 73), prose(80, 74) + shared[27:] + prose(80, 75)]
    holders = [prose(80, 80 + k) + shared + prose(80, 90 + k) for k in range(3)]
    texts = [text(w) for w in parts + holders]
    found = chaining.repeated_passages(documents(spark, texts)).collect()
    assert {(r.doc_id, r.other_id) for r in found} == {(3, 2), (4, 2)} and all(r.n_words >= 60 for r in found)
    assert len(found) == 2


def test_each_passage_of_a_pair_counts_once(spark):
    line = prose(12, 95)
    texts = [text(prose(40, 96 + k) + line * 12 + prose(40, 98 + k)) for k in range(2)]
    found = [tuple(r) for r in chaining.repeated_passages(documents(spark, texts)).collect()]
    assert found and len({f[:6] for f in found}) == len(found)


def test_far_away_chains_do_not_hide_near_ones():
    got = chaining.chains([(0, 0, 400), (600, 600, 26), (631, 630, 26)])
    assert got == [[(0, 0, 400)], [(600, 600, 26), (631, 630, 26)]]


def test_chains_take_the_best_order():
    got = chaining.chains([(0, 0, 10), (12, 12, 10), (30, 5, 8), (24, 26, 9)])
    assert got[0] == [(0, 0, 10), (12, 12, 10), (24, 26, 9)] and got[1] == [(30, 5, 8)]


def test_fenwick_against_plain_maximum():
    rng = random.Random(2)
    tree, values = chaining.Fenwick(40), {}
    for k in range(200):
        p, v = rng.randrange(40), rng.random()
        tree.add(p, v, k)
        values[p] = max(values.get(p, (0, 0)), (v, k))
        q = rng.randrange(40)
        assert tree.upto(q) == max([values[x] for x in values if x <= q], default=(float("-inf"), -1))


BENCH = [text(prose(40, 900 + k)) for k in range(6)] + ["tiny", None]


@pytest.mark.parametrize("block_bytes", [10**7, 300])
def test_decontamination(spark, block_bytes):
    clean = [text(prose(150, 300 + k)) for k in range(10)]
    leak = [clean[0] + " " + BENCH[0].upper() + " x", BENCH[1], clean[1][:70] + BENCH[2].replace(" ", " *** ") + clean[2], clean[3] + " " + BENCH[3][30:200]]
    fuzzy = list(BENCH[4])
    for i in range(20, len(fuzzy), 40):
        fuzzy[i] = "#"
    texts = clean + leak + ["é " + clean[4] + " " + "".join(fuzzy), None, "", "tiny"]
    bench = spark.createDataFrame(list(enumerate(BENCH)), "item_id long, text string")
    found = decontam.find_leaks(documents(spark, texts), bench, block_bytes).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(10, 0), (11, 1), (12, 2), (13, 3), (14, 4)}
    for r in found:
        if r.doc_id == 10:
            assert r.edits == 0 and texts[10][r.start : r.end].lower() in BENCH[0]
    kept = decontam.drop_contaminated(documents(spark, texts), bench, block_bytes)
    assert sorted(r.doc_id for r in kept.collect()) == [*range(10), 15, 16, 17]
    assert decontam.find_leaks(documents(spark, texts), bench.limit(0)).count() == 0


def edit_distance_in(text_, window):
    row = [0] * (len(text_) + 1)
    for i, a in enumerate(window, 1):
        new = [i]
        for j, b in enumerate(text_, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_leaks_against_edit_distance():
    item = BENCH[5][:96]
    index = decontam.Index.build([1], [item])
    norm = decontam.Squeezed(pa.array([item]))
    window = index.windows[0].decode()
    rng = random.Random(6)
    for trial in range(60):
        copy = list(item)
        for _ in range(trial % 12):
            copy[rng.randrange(len(copy))] = rng.choice("abcdefgh")
        whole = text(prose(20, trial)) + " " + "".join(copy) + " " + text(prose(20, 99 + trial))
        squeezed = decontam.Squeezed(pa.array([whole])).data.tobytes().decode()
        best = edit_distance_in(squeezed, window)
        found = index.search(pa.array([whole]))
        assert bool([f for f in found if f[4] <= index.edits[0]]) == (best <= index.edits[0]) or len(index.windows) > 1
    assert len(norm.data) > 0


def test_leaks_in_stretches_of_common_grams(monkeypatch):
    """Texts and items full of one repeated phrase: searched piece by piece, the same windows are found."""
    phrase = "over and over again "
    items = [phrase * 6, phrase * 3 + text(prose(20, 7)), BENCH[0]]
    index = decontam.Index.build([1, 2, 3], items)
    texts = pa.array([phrase * 60, text(prose(30, 8)) + " " + phrase * 3 + text(prose(20, 7)), BENCH[0] + " " + phrase * 20, "x", None])
    whole = {f[:2] for f in index.search(texts)}
    assert whole >= {(0, 1), (1, 2), (2, 3), (2, 1)}
    for most in (50, 1000):
        monkeypatch.setattr(decontam, "MOST_HITS", most)
        assert {f[:2] for f in index.search(texts)} == whole


def model_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


TEXTS = ["", None, " ", "  a  b ", "▁x ▁", "日本語 😀\x00z", "\t\n x", "a" * 3000, "<s> </s> <unk> <0x41>", "Éa è. 12345", "é ﬁ ½ Ａ"]


def test_tokens_as_the_library(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_path())
    df = documents(spark, TEXTS)
    got = {r.doc_id: r for r in pieces.digest_documents(df, model_path(), with_ids=True).collect()}
    spans = {r.doc_id: r for r in pieces.encode_documents(df, model_path()).collect()}
    for i, t in enumerate(TEXTS):
        ids = lib.encode(t or "")
        assert got[i].ids == ids == spans[i].ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()
        raw = (t or "").encode()
        assert got[i].covered_bytes == len(raw)
        ends = [0, *spans[i].ends]
        assert all(a <= b for a, b in zip(ends, ends[1:], strict=False)) and b"".join(raw[a:b] for a, b in zip(ends, ends[1:], strict=False)) == raw


def test_normaliser_as_the_library():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    for rule in ("nmt_nfkc_cf", "nfkc", "identity"):
        lib = sentencepiece.SentencePieceNormalizer(rule_name=rule)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(lib.serialized_model_proto())
        ours = pieces.Normaliser(model.normalizer_spec)
        for t in [x or "" for x in TEXTS] + ["Ａ  Ｂ ﬁ ½ é Ä", "  x  "]:
            norm, places = ours(t)
            assert norm.decode() == lib.normalize(t)
            assert len(places) == len(norm) + 1 and (np.diff(places) >= 0).all() and places[-1] <= len(t.encode())


def test_noisy_or_and_its_slope():
    """Against plain products, and against differences of the likelihood."""
    rng = np.random.default_rng(4)
    n, m, width = 12, 40, 7
    doc, toxic = np.sort(rng.integers(0, n, m)), rng.integers(0, 2, n)
    entry, which = rng.integers(0, m, 90), rng.integers(0, width, 90)
    at = rng.normal(0, 0.7, width + 1)

    def scores(w):
        return 1 / (1 + np.exp(-(w[-1] + np.bincount(entry, w[which], minlength=m))))

    def likelihood(w):
        p = scores(w)
        whole = [1 - np.prod([1 - x for x, d in zip(p, doc, strict=True) if d == k]) for k in range(n)]
        assert np.allclose(toxicity.noisy_or(p, doc, n), whole)
        have = [k for k in range(n) if (doc == k).any()]
        return sum(np.log(whole[k]) if toxic[k] else np.log(1 - whole[k]) for k in have) / n

    got = toxicity.slope(scores(at), doc, toxic.astype(float), entry, which, width)
    for k in range(width + 1):
        step = np.zeros(width + 1)
        step[k] = 1e-6
        assert abs((likelihood(at + step) - likelihood(at - step)) / 2e-6 - got[k]) < 1e-6


def test_toxicity(spark):
    rng = random.Random(8)
    bad = ["grolk", "snarv", "blizt", "vurmek"]
    rows, labels = [], []
    for k in range(1500):
        words, toxic = prose(rng.randint(20, 120), 7000 + k), int(k % 6 == 0)
        for _ in range(rng.randint(1, 3) * toxic):
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((k, text(words)))
        if k < 1200:
            labels.append((k, toxic))
    rows += [(5000, None), (5001, ""), (None, "x y")]
    labels += [(None, 1), (7, None), (3, 0), (3, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(rows)
    unseen = [r for r in got if r.doc_id is not None and r.doc_id < 1500 and (r.doc_id >= 1200 or r.held_out)]
    assert sum(r.predicted == int(r.doc_id % 6 == 0) for r in unseen) / len(unseen) > 0.97
    assert {r.score for r in got if r.doc_id in (5000, 5001)} == {0.0}
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    by_id = dict(rows[:1500])
    for r in toxicity.score_documents(docs.filter("doc_id < 300"), model).filter("score >= 0.5").collect():
        assert all(any(b in by_id[r.doc_id][o.start : o.end] for b in bad) for o in r.offending)
    kept = toxicity.reject_toxic(docs.selectExpr("*", "doc_id as `a.b`"), model)
    assert kept.columns == ["doc_id", "text", "a.b"] and kept.filter("doc_id is null or doc_id >= 5000").count() == 3
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_documents(docs, none).filter("score > 0.01").count() == 0
