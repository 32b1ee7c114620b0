"""Ranked lexical search: item vocabulary tiles times document impact tiles, by dense float64 products.

Documents are read once for each block of items and leave their counts of the block's terms behind.
Scores are whole numbers below 2^53 in every partial sum, so float64 products are exact in any order;
longer vocabularies are cut into tiles whose sums are added as 64-bit integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coinloom.llm.kernels import as_bytes
from coinloom.llm.kernels import pieces as slices
from coinloom.operators.scratch import staged

#: (item, term) rows of a block of items, in the mean; a block of one longer item may exceed it.
BLOCK_CELLS = 500_000
TILE_TERMS, TILE_DOCUMENTS = 1024, 256
IMPACT = 1_000_000  # no document's impact of a term reaches this
_EXACT = 1 << 53
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(terms of all texts in order, which text each belongs to): runs of ASCII letters, digits and other
    characters from U+0080 on, with A-Z lower-cased. Null counts as empty."""
    data, offsets = as_bytes(texts)
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    if len(at) < 2:
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64)
    # Runs of both kinds lie on end in the bytes: the terms are every run that begins inside one.
    runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(_LOWER[data])])
    held = np.flatnonzero(inside[at[:-1]])
    return runs.take(pa.array(held)), np.searchsorted(offsets, at[held], side="right") - 1


def item_terms(items: DataFrame) -> DataFrame:
    """`item_id, term`: the terms of each item, once each; rows of one item_id are one item."""
    kind = dict(items.dtypes)["item_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, doc = terms(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(doc)), found.cast(pa.binary())], ["item_id", "term"])

    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term binary").distinct()


def postings(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """`doc_id, n, terms, counts` of every document: how many terms it has, and which of the vocabulary, by place, how often."""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n bigint, terms array<int>, counts array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(vocabulary)
        for batch in batches:
            for part in slices(batch, "text"):
                found, doc = terms(part.column("text"))
                n = np.bincount(doc, minlength=part.num_rows)
                place = pc.fill_null(pc.index_in(found, vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                cells, counts = np.unique((doc * size + place)[place >= 0], return_counts=True)
                first = pa.array(np.searchsorted(cells, np.arange(part.num_rows + 1) * size).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(n, pa.int64()),
                        pa.ListArray.from_arrays(first, pa.array(cells % max(size, 1), pa.int32())),
                        pa.ListArray.from_arrays(first, pa.array(counts, pa.int64())),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def document_frequencies(held: DataFrame) -> DataFrame:
    """`term, df` of postings: each task sums up its own documents and sends one row a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(0, np.int64)
        for batch in batches:
            more = np.bincount(pc.list_flatten(batch.column(0)).to_numpy(zero_copy_only=False), minlength=len(sums))
            more[: len(sums)] += sums
            sums = more
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at], pa.int64())], ["term", "df"])

    return held.select("terms").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df"))


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


@dataclass
class Tile:
    """Some items: their places, and for each part of their vocabulary the terms and the weights of items by terms."""

    items: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray]]


def tiles(item: np.ndarray, term: np.ndarray, weights: np.ndarray) -> list[Tile]:
    """Items, in order, in tiles of about TILE_TERMS distinct terms; `item` ascends. Terms of weight 0 score nothing.

    A tile's vocabulary is cut wherever its weights times the largest impact would reach 2^53.
    """
    item, term = item[weights[term] > 0], term[weights[term] > 0]
    out: list[Tile] = []
    bounds = np.append(np.flatnonzero(np.diff(item, prepend=-1)), len(item))
    at = 0
    while at < len(bounds) - 1:
        seen: set[int] = set()
        stop = at
        while stop < len(bounds) - 1:
            own = term[bounds[stop] : bounds[stop + 1]].tolist()
            if stop > at and len(seen.union(own)) > TILE_TERMS:
                break
            seen.update(own)
            stop += 1
        lo, hi = bounds[at], bounds[stop]
        rows, row = np.unique(item[lo:hi], return_inverse=True)
        words, column = np.unique(term[lo:hi], return_inverse=True)
        part_of = np.maximum(np.arange(len(words)) // TILE_TERMS, (np.cumsum(weights[words]) * IMPACT) // (_EXACT // 2))
        parts = []
        for p in np.unique(part_of):
            first, last = np.searchsorted(part_of, [p, p + 1])
            matrix = np.zeros((len(rows), last - first))
            here = (column >= first) & (column < last)
            matrix[row[here], column[here] - first] = weights[words[column[here]]]
            parts.append((words[first:last], matrix))
        out.append(Tile(rows, parts))
        at = stop
    return out


class Best:
    """The best documents of every item so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, items: int, keep: int) -> None:
        self.keep = keep
        self.score = np.zeros((items, keep), np.int64)
        self.doc = np.zeros((items, keep), np.int64)
        self.void = np.ones((items, keep), np.int64)

    def take(self, items: np.ndarray, scores: np.ndarray, docs: np.ndarray, void: np.ndarray) -> None:
        """`scores`: items by documents. Whatever reaches an item's last kept score is compared by id as well."""
        floor = np.maximum(self.score[items, -1], 1)
        for k in np.flatnonzero((scores >= floor[:, None]).any(axis=1)):
            i, own = items[k], scores[k]
            at = np.flatnonzero(own >= floor[k])
            if len(at) > 4 * self.keep:
                least = np.partition(own[at], -self.keep)[-self.keep]
                at = at[own[at] >= least]
            score = np.concatenate([self.score[i], own[at]])
            doc = np.concatenate([self.doc[i], docs[at]])
            none = np.concatenate([self.void[i], void[at]])
            order = np.lexsort((doc, none, -score))[: self.keep]
            self.score[i], self.doc[i], self.void[i] = score[order], doc[order], none[order]


def _score(held: DataFrame, blocks: list[Tile], n_items: int, n_terms: int, n_docs: int, n_all: int, keep: int) -> DataFrame:
    """`item, score, doc_id`: of every task's documents the `keep` best for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n_items, keep)
        columns = [[np.full(n_terms, -1, np.int64) for _ in t.parts] for t in blocks]
        for places, tile in zip(columns, blocks, strict=True):
            for place, (words, _) in zip(places, tile.parts, strict=True):
                place[words] = np.arange(len(words))
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCUMENTS):
                part = batch.slice(at, TILE_DOCUMENTS)
                ids = part.column("doc_id")
                void = pc.is_null(ids).to_numpy(zero_copy_only=False).astype(np.int64)
                docs = pc.fill_null(ids, 0).to_numpy().astype(np.int64)
                sizes = pc.list_value_length(part.column("terms")).to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(part.num_rows), sizes)
                term = pc.list_flatten(part.column("terms")).to_numpy(zero_copy_only=False)
                tf = pc.list_flatten(part.column("counts")).to_numpy(zero_copy_only=False).astype(np.int64)
                m = np.array([10 + (90 * n * n_docs) // n_all for n in part.column("n").to_pylist()], np.int64)
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
                for places, tile in zip(columns, blocks, strict=True):
                    total = np.zeros((len(tile.items), part.num_rows), np.int64)
                    for place, (words, matrix) in zip(places, tile.parts, strict=True):
                        column = place[term]
                        here = np.flatnonzero(column >= 0)
                        if len(here):
                            dense = np.zeros((len(words), part.num_rows))
                            dense[column[here], doc[here]] = impact[here]
                            total += (matrix @ dense).astype(np.int64)
                    best.take(tile.items, total, docs, void)
        item, rank = np.nonzero(best.score > 0)
        none = best.void[item, rank].astype(bool)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(best.score[item, rank]), pa.array(best.doc[item, rank], pa.int64(), mask=none)],
            ["item", "score", "doc_id"],
        )

    return held.mapInArrow(run, "item bigint, score bigint, doc_id bigint")


def search(docs: DataFrame, items: DataFrame, keep: int = 10) -> DataFrame:
    """`item_id, rank, doc_id, score`: each item's `keep` best documents with a score above 0.

    Equal scores go by doc_id, a null id last; rows that share an id are documents of their own. Items
    without any term that some document has, empty and null ones among them, have no row; neither has
    anything an answer where no document has a term. Items are searched in blocks of about BLOCK_CELLS
    (item, term) rows, dealt by a hash of their id, so what the driver and the tasks hold of them is
    bounded however many there are; each block reads all documents once.
    """
    spark = docs.sparkSession
    cells = staged(item_terms(items))
    n_blocks = max(1, -(-cells.count() // BLOCK_CELLS))
    found = [_search_block(docs, cells.filter(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == k), keep) for k in range(n_blocks)]
    found = [f for f in found if f is not None]
    if not found:
        kinds = dict(items.dtypes)["item_id"], dict(docs.dtypes)["doc_id"]
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint")
    whole = found[0]
    for f in found[1:]:
        whole = whole.unionByName(f)
    return whole


def _search_block(docs: DataFrame, cells: DataFrame, keep: int) -> DataFrame | None:
    spark = docs.sparkSession
    rows = cells.orderBy(F.col("item_id").asc_nulls_first(), "term").toArrow()
    if not rows.num_rows:
        return None
    # A null term for the item's id is no member: ids are told apart by place.
    ids = rows.column("item_id").combine_chunks()
    coded = ids.dictionary_encode(null_encoding="encode")
    item = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    vocabulary = rows.column("term").cast(pa.large_binary()).combine_chunks().unique()
    term = pc.index_in(rows.column("term").cast(pa.large_binary()).combine_chunks(), vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    held = staged(postings(docs, vocabulary))
    n_docs, n_all = held.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    for r in document_frequencies(held).toLocalIterator():
        df[r["term"]] = r["df"]
    weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
    weights[df == 0] = 0
    order = np.argsort(item, kind="stable")
    blocks = tiles(item[order], term[order], weights)
    top = _score(held, blocks, len(coded.dictionary), len(vocabulary), n_docs, n_all, keep)
    nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = top.withColumn("rank", nth).filter(F.col("rank") <= keep)
    names = spark.createDataFrame(pa.table({"item": pa.array(range(len(coded.dictionary)), pa.int64()), "item_id": coded.dictionary}))
    return ranked.join(F.broadcast(names), "item").select(
        F.col("item_id").cast(dict(cells.dtypes)["item_id"]).alias("item_id"), "rank",
        F.col("doc_id").cast(dict(docs.dtypes)["doc_id"]).alias("doc_id"), "score",
    )
