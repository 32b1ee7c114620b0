"""Packing documents into sequences: best-fit decreasing, with a segment tree over remaining capacities.

Lengths lie in 1 .. capacity, so the placement is worked out on how many pieces there are of each
length, a table of at most `capacity` rows: pieces of one length and bins with the same room are alike,
and best-fit decreasing sends the next pieces of a length all to the bins with the least room that
still holds one. Such a step covers any number of bins. The bins, numbered, come out as runs; each
piece finds its bin by its number among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinloom.llm.byte_tokens import tokenizer
from coinloom.llm.kernels import pieces as slices
from coinloom.operators.scratch import staged

CAPACITY = 2048
_RANKS = 44  # bits of a piece's number in a key of length and number


class Room:
    """A segment tree over remaining capacities: which are held by open bins, and the least that fits."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, room: int, bins: int) -> None:
        at = room + self.size
        while at:
            self.open[at] += bins
            at //= 2

    def tightest(self, need: int) -> int | None:
        """The least capacity of `need` or more that an open bin has left."""
        at = need + self.size
        if self.open[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first number, first bin, pieces a bin, offset) of runs, for `counts` pieces of each length.

    From its first number on, up to the next run of that length, piece i of a run goes to bin
    `first bin + i // pieces`, at `offset + i % pieces * length`. A bin that takes a piece has the least
    room again as long as another one fits, so each bin is filled before the next one is touched:
    the bins are those of placing piece by piece. A run of bins is cut at most once a length and halves
    its room at least whenever it is used, so there are fewer than 3 * capacity * log2(capacity) runs.
    """
    room = Room(capacity)
    runs: dict[int, list[tuple[int, int]]] = {}
    made, plan = 0, []

    def keep(left: int, first: int, bins: int) -> None:
        if bins and left:
            runs.setdefault(left, []).append((first, bins))
            room.add(left, bins)

    for length in sorted(counts, reverse=True):
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length} does not fit into {capacity}")
        todo, number = counts[length], 0
        while todo:
            left = room.tightest(length)
            if left is None:
                left, first, bins = capacity, made, -(-todo // (capacity // length))
                made += bins
            else:
                first, bins = runs[left].pop()
                room.add(left, -bins)
            each = left // length
            full, over = divmod(todo, each)
            plan.append((length, number, first, each, capacity - left))
            if bins <= full:
                keep(left - each * length, first, bins)
                placed = bins * each
            else:
                keep(left - each * length, first, full)
                keep(left - over * length, first + full, 1 if over else 0)
                rest = full + (over > 0)
                keep(left, first + rest, bins - rest)
                placed = todo
            number += placed
            todo -= placed
    return plan


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of n tokens: whole ones, after a shorter first one where n leaves a rest."""
    rest = n % capacity
    return ([rest] if rest else []) + [capacity] * (n // capacity)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32` (and `ids`): each document's ids and an id 0, cut to the capacity.

    A null text is empty: its only id is 0. Ids may be null or repeat; other columns are left out.
    `path` names a tokenizer file that every executor can read.
    """
    schema = (
        f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start bigint, length bigint, ids_crc32 bigint"
        + (", ids array<bigint>" if with_ids else "")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        for batch in batches:
            for part in slices(batch, "text", 4096, 4_000_000):
                ids, counts = words.encode([t or "" for t in part.column("text").to_pylist()])
                ids = np.insert(ids, np.cumsum(counts), 0).astype("<u4")
                rows: list[tuple[int, int, int, int]] = []
                at, crcs, kept = 0, [], []
                for k, n in enumerate((counts + 1).tolist()):
                    start = 0
                    for piece, length in enumerate(cut_lengths(n, capacity)):
                        rows.append((k, piece, start, length))
                        own = ids[at : at + length]
                        crcs.append(zlib.crc32(own))
                        if with_ids:
                            kept.append(own.astype(np.int64))
                        start += length
                        at += length
                doc, piece, start, length = np.array(rows, np.int64).reshape(-1, 4).T
                columns = {
                    "doc_id": part.column("doc_id").take(pa.array(doc)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start),
                    "length": pa.array(length),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(kept, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def numbered(pieces: DataFrame, per_slot: int = 100_000) -> DataFrame:
    """`pieces` plus `number`: its place, from 0, among the pieces of its length.

    Each length is dealt by hash into slots, at least 64 and enough for about `per_slot` rows each, so a
    length that a third of all pieces has is no single task; a slot counts on from the sums of those before.
    Rows that are alike in every column may change places, and the result stays the same.
    """
    told = ["doc_id", "piece", "start", "ids_crc32"]
    slots = max(64, pieces.count() // per_slot)
    dealt = pieces.withColumn("_slot", F.pmod(F.xxhash64(*told), F.lit(slots)).cast("int"))
    before = Window.partitionBy("length").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("length", "_slot").agg(F.count("*").alias("_n"))
    sums = sums.select("length", "_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_slot").orderBy(*told)
    placed = dealt.withColumn("_place", F.row_number().over(inside) - 1)
    return placed.join(sums, ["length", "_slot"]).withColumn("number", F.col("_before") + F.col("_place")).drop("_slot", "_before", "_place")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` plus `sequence_id, offset`: bins by best-fit decreasing, places in a bin without gaps.

    `pieces` has `doc_id, piece, start, length, ids_crc32`, lengths from 1 to the capacity; it is written
    once, so that counting and placing see the same rows. The driver takes one row for each length, at
    most `capacity`, and every task the runs of `best_fit_decreasing`, whose number has a bound too.
    """
    kept = staged(pieces)
    counts = {r["length"]: r["count"] for r in kept.groupBy("length").count().collect()}
    plan = np.array(best_fit_decreasing(counts, capacity), np.int64).reshape(-1, 5)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    keys = (plan[:, 0] << _RANKS) + plan[:, 1]
    rows = numbered(kept)
    names = kept.columns
    types = dict(kept.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            k = np.searchsorted(keys, (length << _RANKS) + number, side="right") - 1
            _, first, bins, each, offset = plan[k].T
            nth = number - first
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(bins + nth // each), pa.array(offset + nth % each * length)], [*names, "sequence_id", "offset"]
            )

    schema = ", ".join(f"`{c}` {types[c]}" for c in names) + ", sequence_id bigint, offset bigint"
    return rows.select(*names, "number").mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """`sequence_id, ids, doc_ids, starts`: packed pieces with `ids`, laid end to end; one sequence is at most the capacity long."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts")
    )
