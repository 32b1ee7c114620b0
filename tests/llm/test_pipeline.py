"""The pipeline's stages against their operators' own decisions, one stage after another."""

import random

import corpus_pipeline
import public_tokenizers
import sentencepiece
from coinloom.llm import decontam, toxicity, weighted_minhash
from coinloom.llm.queries import QUERIES
from test_native import base_spans


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    kept = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], small).write.parquet(str(tmp_path / str(k)))
        kept.append(spark.read.parquet(str(tmp_path / str(k))))
    ids = [sorted(r.doc_id for r in d.select("doc_id").collect()) for d in kept]
    labels = spark.read.parquet(f"{small}/labels.parquet")
    toxic = toxicity.toxicity(docs, labels).filter("predicted = 1")
    assert sorted(set(ids[0]) - set(ids[1])) == sorted(r.doc_id for r in toxic.collect())
    classes = weighted_minhash.near_duplicates(kept[1]).collect()
    assert ids[2] == sorted({r.class_id for r in classes})
    leaks = decontam.find_leaks(kept[2], spark.read.parquet(f"{small}/benchmark.parquet"))
    assert set(ids[2]) - set(ids[3]) == {r.doc_id for r in leaks.collect()}
    assert ids[3] == ids[4] == ids[5]
    assert all(d.columns == columns for d in kept[:5])
    before = {r.doc_id: r.text for r in kept[3].collect()}
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    tokens = {r.doc_id: r.ids for r in kept[5].collect()}
    for r in kept[4].collect():
        assert not base_spans(r.text) and (r.text == before[r.doc_id]) == (not base_spans(before[r.doc_id]))
        assert r.n_chars == len(r.text) and tokens[r.doc_id] == lib.encode(r.text)


def test_rows_without_ids(spark, small):
    rows = [(None, "a b c d e f", "en", "s", 1), (None, "a b c d e f", "en", "s", 1), (1, "q w e r t y", "en", "s", 1), (1, "q w e r t y", "en", "s", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, small).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == [(-1, ""), (-1, "a b c d e f"), (1, "q w e r t y")]


def test_registered(spark, small):
    assert QUERIES["pipeline"](spark, small).count() > 0


def test_no_base_span_is_left_in_a_masked_text(spark, small):
    """Adjacent, nested and overlapping kinds, and numbers that only what is masked kept from being valid."""
    parts = ["10.0.0.1", "a.b@c.de", "4111 1111 1111 1111", "+1 (234) 555-0100", "192.168.1.10-admin@example.com", "10.0.0.1@host.com", "7", "-", "x", "é", "1.2.3.4.5"]
    rng = random.Random(9)
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "-", "."]) for _ in range(rng.randint(1, 8))) for _ in range(1500)]
    texts += ["10.0.0.1 4111 1111 1111 1111", "mail 10.0.0.1@host.com", "192.168.1.10-admin.bob@example.com"]
    schema = "doc_id long, text string, lang string, found string, n_chars int, hits string"
    docs = spark.createDataFrame([(i, t, "en", "f", -1, None) for i, t in enumerate(texts)], schema)
    got = corpus_pipeline.mask_personal_data(spark, docs, small)
    assert got.schema == docs.schema
    for r in got.collect():
        assert base_spans(r.text) == [] and r.found == "f" and r.hits is None, texts[r.doc_id]
        assert (r.n_chars == -1) if r.text == texts[r.doc_id] else (r.n_chars == len(r.text))
