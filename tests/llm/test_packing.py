import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from coinloom.llm import byte_tokens, packing
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def one_by_one(lengths, capacity):
    """Sorted fill levels of best-fit decreasing, piece by piece."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        at = bisect_left(rooms, n)
        left = rooms.pop(at) if at < len(rooms) else capacity
        insort(rooms, left - n)
    return sorted(rooms)


def filled(counts, capacity):
    """Sorted rooms of the bins that a plan fills; checks that places follow each other."""
    plan, bins = packing.best_fit_decreasing(counts, capacity), {}
    for length, count in counts.items():
        own = sorted(r for r in plan if r[0] == length)
        for k, (_, number, first, each, offset) in enumerate(own):
            stop = own[k + 1][1] if k + 1 < len(own) else count
            for i in range(stop - number):
                bins.setdefault(first + i // each, []).append((offset + i % each * length, length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sorted(capacity - sum(n for _, n in p) for p in bins.values())


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40), st.data())
def test_plan_is_that_of_piece_by_piece(capacity, data):
    lengths = data.draw(st.lists(st.integers(1, capacity), max_size=120))
    assert filled(Counter(lengths), capacity) == one_by_one(lengths, capacity)


def test_plan_of_many_pieces():
    rng = np.random.default_rng(5)
    lengths = np.minimum(2048, rng.zipf(1.3, 30_000) + rng.integers(0, 900, 30_000)).tolist()
    counts = Counter(lengths)
    assert filled(counts, 2048) == one_by_one(lengths, 2048)
    huge = packing.best_fit_decreasing({n: c * 10**7 for n, c in counts.items()})
    assert len(huge) < 3 * 2048 * 11
    with pytest.raises(ValueError, match="does not fit"):
        packing.best_fit_decreasing({2049: 1})


def test_tightest_room():
    room = packing.Room(2048)
    assert room.tightest(1) is None
    for r in (5, 900, 2048):
        room.add(r, 2)
    assert [room.tightest(n) for n in (1, 5, 6, 900, 901, 2048)] == [5, 5, 900, 900, 2048, 2048]
    room.add(900, -2)
    assert room.tightest(6) == 2048


odd = st.text(st.sampled_from("aZ9'stmdrevl \n\t\x0b\x1c\x85\xa0_-é²٣ª漢́‍😀　​<|>"), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(odd, st.text(st.characters(exclude_categories=["Cs"]), max_size=20)), max_size=5))
def test_ids_are_those_of_the_library(texts):
    own = byte_tokens.tokenizer(PATH)
    ids, counts = own.encode(texts)
    want = [e.ids for e in own.library.encode_batch(texts, add_special_tokens=False)]
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])][: len(texts)] == want


def test_long_and_special_texts(monkeypatch, library):
    monkeypatch.setattr(byte_tokens, "STRETCH", 50)
    own = byte_tokens.ByteTokenizer(PATH)
    texts = ["don't  stop\n 'til you're done 's " * 40, "x" * 500, "", "a<|endoftext|>b  <|endoftext|>", "  \n\n " * 60 + "end", "漢字 かな " * 50]
    for known in (10, 60, 500_000):
        monkeypatch.setattr(byte_tokens, "MOST_WORDS", known)
        ids, counts = own.encode(texts)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_whole_table_has_the_librarys_ids(small, library):
    import duckdb

    texts = [r[0] or "" for r in duckdb.sql(f"SELECT text FROM '{small}/documents.parquet'").fetchall()]
    ids, counts = byte_tokens.tokenizer(PATH).encode(texts)
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def pieces_plainly(library, text, capacity):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
    cut = len(ids) % capacity or (capacity if ids else 0)
    bounds = [0, *range(cut, len(ids) + 1, capacity)]
    return [(k, a, ids[a:b]) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]


def test_documents(spark, library):
    rows = [(1, None), (2, ""), (None, "no id"), (3, "word " * 300), (4, "same"), (4, "same"), (5, "word " * 63), (6, "word " * 64)]
    rows += [(k, "lorem ipsum dolor " * (k % 9)) for k in range(100, 190)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as piece", "'x' as ids", "0 as sequence_id").repartition(3)
    packed = packing.pack(packing.token_pieces(docs, PATH, 64, with_ids=True), 64).persist()
    got = packed.collect()
    want = [(d, k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, t in rows for k, start, ids in pieces_plainly(library, t, 64)]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sorted(64 - sum(n for _, n in p) for p in bins.values()) == one_by_one([r.length for r in got], 64)
    laid = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in got:
        assert laid[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    packed.unpersist()


def test_hot_length_and_empty_table(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'one two', repeat('one two three ', int(id % 11))) as text")
    rows = packing.numbered(packing.token_pieces(docs, PATH), per_slot=10).collect()
    by_length = {}
    for r in rows:
        by_length.setdefault(r.length, []).append(r.number)
    assert all(sorted(v) == list(range(len(v))) for v in by_length.values())
    assert packing.pack(packing.token_pieces(docs.limit(0), PATH)).collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        byte_tokens.ByteTokenizer(public_tokenizers.path("word_bpe_49k.json"))
