"""Toxic documents by multiple-instance learning: sentence scores, combined by noisy-or.

Only documents are labelled. A logistic model scores sentences; a document is toxic unless every one
of its sentences is clean, so its probability is one minus the product of the sentences' clean
probabilities. The gradient of the document likelihood reaches each sentence through that product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinloom.llm.common import filter_rows
from coinloom.llm.kernels import _BYTE, U64, Words, _power, mixed
from coinloom.llm.kernels import pieces as slices

FEATURE_BITS = 22
PREFIXES = (3, 4, 5, 6, 7, 8)
# The classifier is fitted on this many labelled documents at most.
TRAIN_DOCUMENTS = 12_000
_ENDS = np.zeros(256, dtype=np.int64)
_ENDS[[ord(c) for c in ".!?\n"]] = 1


def _instances(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, sentence of each word, feature slots of each word: the word and its first 3 to 8 bytes; -1: none)."""
    words = Words(texts)
    ends = np.cumsum(_ENDS[words.data]) if len(words.data) else np.zeros(0, np.int64)
    stop = ends[words.start]
    new = np.ones(len(words.hash), dtype=bool)
    new[1:] = (stop[1:] != stop[:-1]) | (words.doc[1:] != words.doc[:-1])
    sentence = np.cumsum(new) - 1
    up, down = _power(len(words.data) + 1)
    sums = np.zeros(len(words.data) + 1, dtype=U64)
    np.cumsum(_BYTE[words.data] * up[: len(words.data)], out=sums[1:])
    slots = np.full((len(PREFIXES) + 1, len(words.hash)), -1, dtype=np.int32)
    shift = U64(64 - FEATURE_BITS)
    slots[0] = (words.hash >> shift).astype(np.int32)
    for k, size in enumerate(PREFIXES):
        long = np.flatnonzero(words.end - words.start >= size)
        at = words.start[long]
        part = mixed((sums[at + size] - sums[at]) * down[at] + U64(size))
        slots[k + 1, long] = (part >> shift).astype(np.int32)
    return words, sentence, slots


@dataclass(frozen=True)
class Model:
    """Weights of the chosen feature slots, and the bias."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def sentences(self, texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
        """(words, sentence of each word, document of each sentence, score of each sentence)."""
        words, sentence, slots = _instances(texts)
        n = int(sentence[-1]) + 1 if len(sentence) else 0
        doc = np.zeros(n, np.int64)
        doc[sentence] = words.doc
        entry, which = _known(self.slots, sentence, slots)
        z = self.bias + np.bincount(entry, self.weights[which], minlength=n)
        return words, sentence, doc, 1 / (1 + np.exp(-z))


def _known(chosen: np.ndarray, sentence: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (sentence, index into chosen) of the features that are in the sorted array `chosen`."""
    if not len(chosen) or not len(sentence):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    there = np.zeros(1 << FEATURE_BITS, dtype=bool)
    there[chosen] = True
    row, col = np.nonzero(there[slots] & (slots >= 0))
    key = np.unique(sentence[col] * len(chosen) + np.searchsorted(chosen, slots[row, col]))
    return key // len(chosen), key % len(chosen)


def noisy_or(score: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """1 - product of (1 - score) over each document's sentences; 0 for a document without any."""
    return -np.expm1(np.bincount(doc, np.log1p(-np.minimum(score, 1 - 1e-12)), minlength=n))


def _parts(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Stretches of the texts that hold few rows and few bytes, each with the number of its first row."""
    at = 0
    for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text", 512):
        yield at, part.column(0)
        at += part.num_rows


def slope(
    p: np.ndarray, doc: np.ndarray, toxic: np.ndarray, entry: np.ndarray, which: np.ndarray, width: int
) -> np.ndarray:
    """Gradient of the documents' mean noisy-or log-likelihood by the weights, then the bias.

    `p` are the sentences' scores, `doc` their documents; `entry` and `which` are sentence and weight of
    every feature. A sentence of a document that is not toxic is pulled down by its score; one of a toxic
    document up by its share of what the document's other sentences leave unexplained.
    """
    n = len(toxic)
    whole = np.clip(noisy_or(p, doc, n), 1e-9, 1 - 1e-12)
    pull = np.where(toxic > 0, (1 - whole) / whole, -1.0)[doc] * p
    return np.append(np.bincount(which, pull[entry], minlength=width), pull.sum()) / max(n, 1)


def fit(texts: pa.Array, toxic: np.ndarray, steps: int = 300, rate: float = 0.1, decay: float = 1e-4) -> Model:
    """Fit on document labels (0 or 1).

    Features that come with toxic documents significantly more often than with others (log-likelihood
    ratio above twice the logarithm of the number of features, four toxic documents at least) get a
    weight of at least 0; Adam steps maximise the documents' noisy-or likelihood.
    """
    toxic = toxic.astype(np.float64)
    n, width = len(toxic), 1 << FEATURE_BITS
    pos, neg = np.zeros(width), np.zeros(width)
    for at, part in _parts(texts):
        words, _, slots = _instances(part)
        row = np.broadcast_to(words.doc, slots.shape)[slots >= 0]
        key = np.unique(row.astype(np.int64) * width + slots[slots >= 0])
        y = toxic[at + key // width]
        pos += np.bincount(key % width, y, minlength=width)
        neg += np.bincount(key % width, 1 - y, minlength=width)
    n1, n0 = toxic.sum(), n - toxic.sum()
    rate_all = (pos + neg) / max(n, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 2 * (
            np.where(pos > 0, pos * np.log(pos / (n1 * rate_all)), 0)
            + np.where(neg > 0, neg * np.log(neg / (n0 * rate_all)), 0)
        )
    limit = 2 * np.log(max(2, np.count_nonzero(pos + neg)))
    chosen = np.flatnonzero((gain > limit) & (pos >= 4) & (pos * n0 > neg * n1)) if n1 and n0 else np.zeros(0, np.int64)
    doc_of, entry, which, base = [], [], [], 0
    for at, part in _parts(texts):
        words, sentence, slots = _instances(part)
        m = int(sentence[-1]) + 1 if len(sentence) else 0
        doc = np.zeros(m, np.int64)
        doc[sentence] = words.doc
        e, w = _known(chosen, sentence, slots)
        doc_of.append(doc + at)
        entry.append(e + base)
        which.append(w)
        base += m
    doc, entry, which = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (doc_of, entry, which))
    weights, bias = np.full(len(chosen), 1.0), -6.0
    m1 = m2 = np.zeros(len(chosen) + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(bias + np.bincount(entry, weights[which], minlength=base))))
        g = slope(p, doc, toxic, entry, which, len(chosen))
        g[:-1] -= decay * weights
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        step = rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
        weights = np.maximum(weights + step[:-1], 0)
        bias = float(np.clip(bias + step[-1], -20, 0))
    return Model(chosen, weights, bias)


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCUMENTS) -> Model:
    """Fit on `labels` (doc_id, toxic) joined to `docs` (doc_id, text).

    The `most` labelled documents that come first by a hash of their id are used; the bound is a
    parameter, so the labels that are sent to the documents and the texts that meet in the fitting
    task are bounded too. Labels that are null, or of a null id, are ignored; of repeated ids the
    larger label and one text count. With no label of either class the model scores 0 nearly always.
    """
    picked = (
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")  # at most `most` rows of two numbers
        .dropDuplicates(["doc_id"])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        whole = pa.Table.from_batches(got).sort_by("doc_id")
        model = fit(
            pa.chunked_array(whole.column("text").chunks, pa.string()).combine_chunks().cast(pa.large_string()),
            whole.column("toxic").to_numpy(),
        )
        yield pa.RecordBatch.from_pydict(
            {
                "slots": pa.array([model.slots.tolist()], pa.list_(pa.int64())),
                "weights": pa.array([model.weights.tolist()], pa.list_(pa.float64())),
                "bias": pa.array([model.bias], pa.float64()),
            }
        )

    # One row; its arrays hold the chosen features of at most `most` documents.
    found = rows.coalesce(1).mapInArrow(run, "slots array<long>, weights array<double>, bias double").collect()
    if not found:
        return Model(np.zeros(0, np.int64), np.zeros(0), -20.0)
    return Model(np.array(found[0]["slots"], np.int64), np.array(found[0]["weights"]), found[0]["bias"])


def score_documents(docs: DataFrame, model: Model, located: bool = True) -> DataFrame:
    """`doc_id, score` of every row of `docs` and, if `located`, `offending`: (start, end, score) of each
    sentence with a score of 0.5 or more, in code points, from its first word to its last.

    Only the text counts; null and empty texts score 0. Extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, score double"
    if located:
        schema += ", offending array<struct<start:int,end:int,score:double>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4096, 1_000_000):
                words, sentence, doc, score = shared.value.sentences(part.column("text"))
                columns = [part.column("doc_id"), pa.array(noisy_or(score, doc, part.num_rows))]
                names = ["doc_id", "score"]
                if located:
                    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
                    spans = _offending(words, sentence, doc, score, part.num_rows)
                    columns, names = [*columns, pa.array(spans, kind)], [*names, "offending"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _offending(words: Words, sentence: np.ndarray, doc: np.ndarray, score: np.ndarray, n: int) -> list[list[dict]]:
    """Spans of the sentences with a score of 0.5 or more, for each document, by one running count of code points."""
    spans: list[list[dict]] = [[] for _ in range(n)]
    hits = np.flatnonzero(score >= 0.5)
    if not len(hits):
        return spans
    before = np.concatenate([[0], np.cumsum(words.data & 0xC0 != 0x80)])
    zero = before[words.offsets[doc[hits]]]
    start = before[words.start[np.searchsorted(sentence, hits)]] - zero
    end = before[words.end[np.searchsorted(sentence, hits, side="right") - 1]] - zero
    for d, a, b, s in zip(doc[hits].tolist(), start.tolist(), end.tolist(), score[hits].tolist(), strict=True):
        spans[d].append({"start": a, "end": b, "score": s})
    return spans


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` whose text scores below 0.5, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def clean(texts: pa.Array) -> np.ndarray:
        _, _, doc, score = shared.value.sentences(texts)
        return noisy_or(score, doc, len(texts)) < 0.5

    return filter_rows(docs, "text", clean)


def held_out() -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, held_out, score, predicted, offending` of every row of `docs`, learned outside the held-out rows.

    `offending` are the sentences that score 0.5 or more, as start:end in code points, comma-joined.
    """
    model = train(docs, labels.filter(~held_out()))
    scored = score_documents(docs, model)
    spans = F.transform("offending", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        F.array_join(spans, ",").alias("offending"),
    )
