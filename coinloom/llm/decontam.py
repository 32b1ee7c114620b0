"""Benchmark passages in documents: q-gram lemma filter in diagonal bands, then banded alignment.

Benchmark items are cut into overlapping windows. If a stretch of a document is within k edits of a
window of m bytes, the two share at least m - q + 1 - k * q of the window's q-grams, and all of those
lie on diagonals that differ by at most k. So hits are counted in overlapping bands of diagonals; a
band that reaches the bound is aligned, within the band only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinloom.llm.common import filter_rows
from coinloom.llm.kernels import _BYTE, U64, Words, _power, mixed
from coinloom.llm.kernels import pieces as slices
from coinloom.operators.scratch import staged

Q = 10
WINDOW, STEP = 96, 48
# Edits allowed in a window, as a share of its bytes.
BUDGET = 0.08
# Benchmark text whose index is sent to the executors at once; a larger benchmark goes in several blocks. An
# index takes about 30 times its text: 13 bytes for each q-gram of two overlapping windows, and the windows.
BLOCK_BYTES = 2_000_000
_SIEVE_BITS = 22
# Hits of q-grams that are counted at once; texts with more are searched stretch by stretch.
MOST_HITS = 2_000_000


class Squeezed:
    """Texts as lower-cased words with one blank between them, and where each byte stood in `words.data`."""

    def __init__(self, texts: pa.Array) -> None:
        w = self.words = Words(texts)
        n = len(w.data)
        keep = np.zeros(n + 1, dtype=np.int8)
        np.add.at(keep, w.start, 1)
        np.add.at(keep, w.end, -1)
        inside = np.cumsum(keep[:n]).astype(bool) if n else np.zeros(0, bool)
        wide = w.end - w.start + 1
        # each word's bytes, then a blank; the blank stands where the word ended
        self.place = np.repeat(w.start - np.concatenate([[0], np.cumsum(wide)[:-1]]), wide) + np.arange(wide.sum()) if len(wide) else np.zeros(0, np.int64)
        blank = np.cumsum(wide) - 1 if len(wide) else np.zeros(0, np.int64)
        self.data = np.full(len(self.place), 32, np.uint8)
        letters = np.ones(len(self.place), bool)
        letters[blank] = False
        self.data[letters] = w.data[inside]
        self.doc = np.repeat(w.doc, wide)
        self.first = np.searchsorted(self.doc, np.arange(len(w.offsets)))

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of every q-gram inside one text; the blank behind the last word belongs to no gram."""
        n = len(self.data)
        if n < Q:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        up, down = _power(n + 1)
        sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(_BYTE[self.data] * up[:n], out=sums[1:])
        start = np.arange(n - Q + 1)
        stop = self.first[1:][self.doc[: n - Q + 1]] - 1
        start = start[start + Q <= stop]
        return start, mixed((sums[start + Q] - sums[start]) * down[start])


@dataclass(frozen=True)
class Index:
    """Windows of one block of the benchmark and a sorted list of their q-grams."""

    items: np.ndarray
    windows: list[bytes]
    grams: np.ndarray
    owner: np.ndarray
    at: np.ndarray
    sieve: np.ndarray
    edits: np.ndarray
    need: np.ndarray

    @staticmethod
    def build(ids: list[int], texts: list[str]) -> Index:
        s = Squeezed(pa.array(texts, pa.large_string()))
        items, windows = [], []
        for i, key in enumerate(ids):
            body = s.data[s.first[i] : max(s.first[i], s.first[i + 1] - 1)].tobytes()
            starts = [0, *range(STEP, len(body) - WINDOW, STEP), max(0, len(body) - WINDOW)]
            for a in dict.fromkeys(starts):
                if len(body[a : a + WINDOW]) >= Q:
                    items.append(key)
                    windows.append(body[a : a + WINDOW])
        size = np.array([len(w) for w in windows], dtype=np.int64)
        edits = (size * BUDGET).astype(np.int64)
        lengths = np.maximum(size - Q + 1, 0)
        owner = np.repeat(np.arange(len(windows)), lengths)
        at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        data = np.frombuffer(b"".join(windows), np.uint8)
        up, down = _power(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
        start = (np.cumsum(size) - size)[owner] + at if len(size) else np.zeros(0, np.int64)
        grams = mixed((sums[start + Q] - sums[start]) * down[start])
        order = np.argsort(grams, kind="stable")
        sieve = np.zeros(1 << _SIEVE_BITS, dtype=bool)
        sieve[(grams >> U64(64 - _SIEVE_BITS)).astype(np.int64)] = True
        return Index(
            np.array(items, dtype=np.int64), windows, grams[order], owner[order].astype(np.int32), at[order].astype(np.uint8), sieve, edits,
            np.maximum(1, size - Q + 1 - edits * Q),
        )

    def search(self, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start, end, edits) of every window found; places are code points of the text."""
        s = Squeezed(texts)
        start, hashes = s.grams()
        maybe = np.flatnonzero(self.sieve[(hashes >> U64(64 - _SIEVE_BITS)).astype(np.int64)])
        start, hashes = start[maybe], hashes[maybe]
        low, high = np.searchsorted(self.grams, hashes), np.searchsorted(self.grams, hashes, side="right")
        hit = np.flatnonzero(high > low)
        start, low, many = start[hit], low[hit], (high - low)[hit]
        out: dict[tuple[int, int, int], tuple[int, int, int, int, int]] = {}
        sums = np.concatenate([[0], np.cumsum(many)])
        i = 0
        while i < len(start):
            # As many places as hold MOST_HITS, but 512 at least; the next stretch overlaps by more than a window.
            j = max(int(np.searchsorted(sums, sums[i] + MOST_HITS, side="right")) - 1, int(np.searchsorted(start, start[i] + 512)))
            j = min(j, len(start))
            for first in range(0, int(sums[j] - sums[i]), MOST_HITS) if sums[j] - sums[i] > MOST_HITS else (None,):
                owners = None
                if first is not None:
                    parts = -(-int(sums[j] - sums[i]) // MOST_HITS)
                    p = first // MOST_HITS
                    owners = (p * len(self.windows) // parts, (p + 1) * len(self.windows) // parts)
                self._found(s, start[i:j], low[i:j], many[i:j], owners, out)
            if j == len(start):
                break
            i = max(i + 1, int(np.searchsorted(start, start[j] - 2 * WINDOW)))
        return list(out.values())

    def _found(
        self, s: Squeezed, start: np.ndarray, low: np.ndarray, many: np.ndarray, owners: tuple[int, int] | None, out: dict
    ) -> None:
        """Windows (of a range of them) that hits at these places vote for and alignment confirms, into `out`."""
        if owners is None:
            row = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            place, owner = np.repeat(start, many), self.owner[row].astype(np.int64)
        else:
            rows, places = [], []
            for a in range(0, len(start), 4096):  # hits of other windows are never held for more than a few places
                part = slice(a, a + 4096)
                for p, x, n in zip(start[part].tolist(), low[part].tolist(), many[part].tolist(), strict=True):
                    own = np.flatnonzero((self.owner[x : x + n] >= owners[0]) & (self.owner[x : x + n] < owners[1])) + x
                    rows.append(own)
                    places.append(np.full(len(own), p))
            row, place = np.concatenate(rows), np.concatenate(places)
            owner = self.owner[row].astype(np.int64)
        if not len(place):
            return
        gram_at = self.at[row].astype(np.int64)
        k = np.maximum(self.edits[owner], 1)
        # The diagonal, counted over the whole batch: a shift of texts against each other keeps them apart.
        band = (place - gram_at + WINDOW) // k
        counted_in = np.concatenate([band, band - 1])  # bands of 2k diagonals, overlapping by k
        who, gram, text = np.tile(owner, 2), np.tile(gram_at, 2), np.tile(s.doc[place], 2)
        spot = np.tile(place, 2)
        order = np.lexsort((gram, counted_in, who, text))
        key = np.stack([text[order], who[order], counted_in[order]])
        grams_in = gram[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (key[:, 1:] != key[:, :-1]).any(0)
        heads = np.flatnonzero(fresh)
        distinct = fresh.copy()
        distinct[1:] |= grams_in[1:] != grams_in[:-1]
        votes = np.add.reduceat(distinct.astype(np.int64), heads)
        for h in heads[votes >= self.need[key[1, heads]]]:
            t, w, b = (int(x) for x in key[:, h])
            found = self._align(s, t, w, b, int(spot[order[h]] - grams_in[h]))
            if found:
                a, z, e = found
                a, z = s.place[a], s.place[z - 1] + 1
                head = s.words.offsets[t]
                chars = lambda to, head=head: int(np.count_nonzero(s.words.data[head:to] & 0xC0 != 0x80))
                best = out.get((t, w, chars(a) // WINDOW))
                if best is None or e < best[4]:
                    out[t, w, chars(a) // WINDOW] = (t, int(self.items[w]), chars(a), chars(z), e)

    def _align(self, s: Squeezed, text: int, window: int, band: int, diagonal: int) -> tuple[int, int, int] | None:
        """(start, end, edits) of the best stretch of the text within the band, if its edits fit the budget."""
        w, k = np.frombuffer(self.windows[window], np.uint8), int(self.edits[window])
        first, last = int(s.first[text]), int(s.first[text + 1]) - 1
        m = len(w)
        if first <= diagonal and diagonal + m <= last and (s.data[diagonal : diagonal + m] == w).all():
            return diagonal, diagonal + m, 0
        wide = max(k, 1)
        lowest = band * wide - WINDOW - k  # diagonals lowest .. lowest + width - 1
        width = 2 * wide + 2 * k
        big = m + width + 1
        d = np.arange(width)
        row = np.where((lowest + d >= first) & (lowest + d <= last), 0, big)
        origin = lowest + d
        for i in range(m):
            j = lowest + d + i  # place of the text byte that a diagonal step takes
            inside = (j >= first) & (j < last)
            same = np.zeros(width, bool)
            same[inside] = s.data[j[inside]] == w[i]
            step = np.where(inside, row + ~same, big)
            skip = np.append(row[1:], big) + 1  # the window's byte is missing in the text
            take_skip = skip < step
            new = np.where(take_skip, skip, step)
            source = np.where(take_skip, np.append(origin[1:], 0), origin)
            run = new - d  # an extra byte in the text: move right for one edit each
            low = np.minimum.accumulate(run)
            at = np.maximum.accumulate(np.where(run == low, d, 0))
            row, origin = low + d, source[at]
            row = np.where(lowest + d + i + 1 <= last, row, big)
        best = int(np.argmin(row))
        if row[best] > k:
            return None
        a, z = int(origin[best]), lowest + best + m
        return (a, z, int(row[best])) if first <= a < z <= last else None


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[Index, bool]]:
    """Indexes of blocks of the benchmark, each of about `block_bytes` of text at most, and whether it is the last.

    One block at a time is on the driver. Items go to blocks by a hash, twice as many as would fit
    exactly; an item longer than a block is a block's whole share.
    """
    rows = benchmark.filter("item_id is not null and text is not null").select("item_id", "text").distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = 1 if total <= block_bytes else 2 * -(-total // block_bytes)
    for b in range(blocks):
        got = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        yield Index.build([r["item_id"] for r in got], [r["text"] for r in got]), b == blocks - 1


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`doc_id, item_id, start, end, edits`: windows of benchmark items found in documents.

    One row per (row of docs, window, stretch); places are code points of the document's text, end
    exclusive, case, punctuation and white space being ignored in the comparison. Null or empty
    texts and items of fewer than ten bytes of words never match. Rows of equal doc_id are separate
    rows. Every document is searched against the whole benchmark, one block of it after another.
    """
    found = None
    for index, last in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        part = _scan(docs, shared)
        if found is None and last:
            return part
        part = staged(part)
        shared.unpersist()
        found = part if found is None else found.unionByName(part)
    return found


def _scan(docs: DataFrame, shared) -> DataFrame:
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4096, 1_000_000):
                hits = shared.value.search(part.column("text"))
                if hits:
                    t, item, a, z, e = zip(*hits, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(t)), pa.array(item, pa.int64())]
                        + [pa.array(x, pa.int32()) for x in (a, z, e)],
                        ["doc_id", "item_id", "start", "end", "edits"],
                    )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, item_id long, start int, end int, edits int"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`doc_id, item_id, n_windows, start, end, edits` of every document and item it leaks.

    `start` and `end` enclose all stretches, `edits` is the most that any of them needed.
    """
    return find_leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_windows"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.max("edits").alias("edits"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of `docs` in which no window of the benchmark is found, with all their columns."""

    def clean(shared) -> Callable[[pa.Array], np.ndarray]:
        def keep(texts: pa.Array) -> np.ndarray:
            ok = np.ones(len(texts), dtype=bool)
            ok[[h[0] for h in shared.value.search(texts)]] = False
            return ok

        return keep

    for k, (index, last) in enumerate(_blocks(benchmark, block_bytes)):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = filter_rows(docs, "text", clean(shared))
        if k or not last:
            docs = staged(docs)
            shared.unpersist()
    return docs
