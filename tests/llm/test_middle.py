import hashlib

import pytest
from coinloom.llm import frames
from hypothesis import given, settings
from hypothesis import strategies as st


def plainly(doc_id, text):
    """Form, cuts and output straight from the text."""
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


texts = st.text(st.sampled_from("ab<>PSM é€😀\n"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.integers(-(10**18), 10**18), texts, st.integers(1, 7))
def test_rearranged_and_restored(doc_id, text, wide):
    source = frames.framed(text, wide)
    choice = frames.choose(doc_id, source.units, bool(frames.tag_places(source)))
    out = frames.rearranged(source, choice)
    form, _, _, want = plainly(doc_id, text)
    assert (choice.form, b"".join(out.each()).decode()) == (form, want)
    assert b"".join(frames.restored(out, form)).decode() == text
    assert out.units == len(want)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(0, 70), st.integers(0, 70), st.integers(1, 9))
def test_reading_a_span(text, a, b, wide):
    source = frames.framed(text, wide)
    assert b"".join(source.read(a, b)).decode() == text[a:b]
    assert len(list(source.touched(a, b))) <= max(0, b - a) // wide + 2


def test_marks_across_frames():
    for wide in (1, 2, 3, 4):
        source = frames.framed("é€<<P>x<<S>😀<M><P>", wide)
        assert frames.tag_places(source) == {b"<P>": 3, b"<S>": 8, b"<M>": 12}
    assert frames.tag_places(frames.framed("<P<S", 1)) == {}


def test_whole_frames_are_passed_on():
    source = frames.framed("abcdefghij" * 10, 10)
    out = frames.rearranged(source, frames.Choice("psm", 25, 25))
    assert [source.frame(k) for k in range(2)] == [out.frame(1), out.frame(2)]
    import zstandard

    stream = zstandard.ZstdDecompressor().stream_reader(bytes(out.data), read_across_frames=True).read()
    assert stream == b"<P>" + b"abcdefghij" * 2 + b"abcde<S>fghij" + b"abcdefghij" * 7 + b"<M>"


def test_documents(spark):
    rows = [(1, None), (2, ""), (3, "has <S> inside"), (None, "no id at all"), (4, "é" * 100_000 + "<P"), (4, "same id"), (4, "same id"), (-9, "😀 x")]
    rows += [(k, f"text number {k} " * (k % 7)) for k in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as frames", "1 as n", "'y' as form").repartition(3)
    got = frames.digest_outputs(frames.fill_in_middle(frames.store_frames(docs, frame_units=1000))).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for d, t in rows:
        form, a, m, out = plainly(d, t)
        want.append((d, len(t or ""), form, a, m, sha(out), sha(t or "")))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_spans_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "abcdefghij", 2, 5), (2, "xyz", 1, 99), (3, None, 0, 1), (4, "abc", None, 2)], "doc_id long, text string, a int, b int")
    stored = frames.store_frames(docs, frame_units=2).join(docs.drop("text"), "doc_id")
    assert {r.doc_id: r.span for r in frames.read_spans(stored, "a", "b").collect()} == {1: "cde", 2: "yz", 3: "", 4: None}
    assert frames.digest_outputs(frames.fill_in_middle(frames.store_frames(docs.limit(0)))).collect() == []


def test_damaged_frames_are_noticed():
    with pytest.raises(KeyError):
        list(frames.restored(frames.framed("no marks"), "psm"))
