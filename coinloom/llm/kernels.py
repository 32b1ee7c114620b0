"""Array kernels over the UTF-8 bytes of a batch of texts: words, hashes, shingles.

All functions work on a whole Arrow batch at once; none depends on Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_SEED = np.random.default_rng(20240607)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a multiply-and-shift finaliser)."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        inverse = U64(pow(int(_BASE), -1, 1 << 64))
        for name, b in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, b, dtype=U64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts on end, and the n + 1 offsets. Null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of a batch: maximal runs of letters, digits, underscores and non-ASCII characters, lower-cased.

    `start`, `end`: byte places in `data`; `doc`: which text; `first`: n + 1 offsets of each text's
    words; `hash`: 64 bits for each word.
    """

    def __init__(self, texts: pa.Array) -> None:
        lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
        self.data, self.offsets = as_bytes(lowered)
        n = len(self.data)
        inside = _IN_WORD[self.data]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        at = self.offsets[1:-1]
        at = at[(at > 0) & (at < n)]
        opens[at] = inside[at]
        closes[at - 1] = inside[at - 1]
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.doc = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))
        up, down = _power(n + 1)
        sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(_BYTE[self.data] * up[:n], out=sums[1:])
        self.hash = mixed((sums[self.end] - sums[self.start]) * down[self.start])


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of every run of `size` words; a shorter text with words gives one shingle of all of them."""
    h, n = words.hash, len(words.hash)
    counts = np.diff(words.first)
    mult = [U64(pow(0xD6E8FEB86659FD93, k + 1, 1 << 64)) for k in range(size)]
    whole = np.zeros(max(0, n - size + 1), dtype=U64)
    for k in range(size):
        whole += h[k : k + len(whole)] * mult[k]
    last = words.first[1:] - size  # last starting word of each text
    starts = np.arange(len(whole))
    fits = starts <= last[words.doc[: len(whole)]]
    docs, hashes = words.doc[: len(whole)][fits], whole[fits]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        lone = np.zeros(len(short), dtype=U64)
        for k in range(size - 1):
            has = counts[short] > k
            lone[has] += h[words.first[short[has]] + k] * mult[k]
        docs, hashes = np.concatenate([docs, short]), np.concatenate([hashes, lone])
    return docs, mixed(hashes)


def counted(docs: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, 48-bit hash), sorted, and how often each occurs. At most 65,536 docs in a batch."""
    key = (docs.astype(U64) << U64(48)) | (hashes >> U64(16))
    key.sort()
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(key)))
    key = key[at]
    return (key >> U64(48)).astype(np.int64), key & U64((1 << 48) - 1), times


def pieces(batch: pa.RecordBatch, column: str, most_rows: int = 4096, most_bytes: int = 1_000_000):
    """Split a batch into slices that hold few rows and few bytes of a text column; one long text may exceed that."""
    n, at = batch.num_rows, 0
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    while at < n:
        limit = (ends[at - 1] if at else 0) + most_bytes
        stop = int(min(n, at + most_rows, max(at + 1, np.searchsorted(ends, limit, side="right"))))
        yield batch.slice(at, stop - at)
        at = stop
