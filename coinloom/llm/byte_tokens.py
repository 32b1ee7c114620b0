"""Byte-level BPE ids of whole texts, as the `tokenizers` library gives them.

Byte-pair merges never cross the borders between words (letters, digits, marks, white space), so a
batch of texts is cut into words at once, each distinct word goes through the library once, and the
ids of the texts are gathered from those of their words. Which class a character has is asked of the
library's own splitter.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE, LETTER, DIGIT, MARK = 0, 1, 2, 3
#: Words kept with their ids in a Python worker; beyond, the rarer half goes.
MOST_WORDS = 500_000
STRETCH = 4_000_000
_S, _T, _M, _D, _R, _E, _V, _L = (ord(c) for c in "stmdrevl")


class ByteTokenizer:
    """A byte-level tokenizer without normaliser, added prefix or post-processor; others are refused."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            said = f.read()
        spec = json.loads(said)
        split = spec["pre_tokenizer"] or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if not plain or spec["normalizer"] or spec["post_processor"] or spec["truncation"] or spec["padding"]:
            raise ValueError("only byte-level tokenizers without normaliser, prefix and post-processor")
        self.library = Tokenizer.from_str(said)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.classes = np.full(0x110000, 255, np.uint8)
        self._learn(np.arange(128))
        self.place: dict[bytes, int] = {}
        self.flat, self.length, self.uses = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, points: np.ndarray) -> None:
        """Ask the splitter which class each code point joins."""
        split = self.library.pre_tokenizer.pre_tokenize_str
        for p in points.tolist():
            kinds = [k for k, c in ((LETTER, "a"), (DIGIT, "1"), (MARK, "!")) if len(split(c + chr(p))) == 1]
            self.classes[p] = kinds[0] if kinds else SPACE

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, how many each text has). Long texts are read in stretches."""
        ids: list[np.ndarray] = []
        counts = np.zeros(len(texts), np.int64)
        batch: list[tuple[int, str]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if batch:
                found, n = self._words([t for _, t in batch])
                ids.append(found)
                np.add.at(counts, [k for k, _ in batch], n)
                batch.clear()
                size = 0

        for k, text in enumerate(texts):
            if any(s in text for s in self.special):
                flush()
                found = np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
                ids.append(found)
                counts[k] = len(found)
                continue
            for part in _stretches(text):
                batch.append((k, part))
                size += len(part)
                if size >= STRETCH:
                    flush()
        flush()
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint32)), counts

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole = "".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        if not whole:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        kind = self.classes[points]
        if (kind == 255).any():
            self._learn(np.unique(points[kind == 255]))
            kind = self.classes[points]
        begins = np.zeros(len(points) + 1, bool)
        begins[0] = True
        begins[ends] = True
        starts = _word_starts(points, kind, begins)
        at = np.flatnonzero(starts[:-1])
        raw = whole.encode()
        offsets = np.append(at, len(raw))
        if len(raw) != len(points):
            offsets[:-1] = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)[at]
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)]
        ).dictionary_encode()
        place = self._places(words.dictionary.to_pylist())[words.indices.to_numpy()]
        first = np.cumsum(self.length) - self.length
        n = self.length[place]
        stop = np.cumsum(n)
        ids = self.flat[np.arange(stop[-1]) + np.repeat(first[place] - (stop - n), n)]
        words_before = np.searchsorted(at, ends)
        tokens_before = np.concatenate([[0], stop])[words_before]
        return ids, np.diff(tokens_before, prepend=0)

    def _places(self, words: list[bytes]) -> np.ndarray:
        """Where the store keeps each of these distinct words; new ones go through the library first."""
        at = np.fromiter((self.place.get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(self.place) + len(new) > MOST_WORDS and self.place:
            self._forget()
            return self._places(words)
        # Small lots: an encoding of the library is many times as large as its ids.
        for lot in np.array_split(new, -(-len(new) // 4096) or 1):
            if not len(lot):
                continue
            own = [words[k] for k in lot.tolist()]
            said = self.library.encode([w.decode() for w in own], is_pretokenized=True, add_special_tokens=False)
            at[lot] = np.arange(len(self.length), len(self.length) + len(own))
            self.place.update(zip(own, at[lot].tolist(), strict=True))
            self.length = np.concatenate([self.length, np.bincount(np.array(said.word_ids, np.int64), minlength=len(own))])
            self.flat = np.concatenate([self.flat, np.array(said.ids, np.uint32)])
        self.uses = np.concatenate([self.uses, np.zeros(len(self.length) - len(self.uses), np.int64)])
        self.uses[at] += 1
        return at

    def _forget(self) -> None:
        """Keep the half of the words that most batches had."""
        keep = np.zeros(len(self.length), bool)
        keep[np.argsort(-self.uses, kind="stable")[: MOST_WORDS // 2]] = len(self.place) > MOST_WORDS // 2
        self.flat = self.flat[np.repeat(keep, self.length)]
        moved = np.cumsum(keep) - 1
        self.place = {w: int(moved[k]) for w, k in self.place.items() if keep[k]}
        self.length, self.uses = self.length[keep], self.uses[keep] // 2


def _stretches(text: str) -> list[str]:
    """A text cut where a space follows something else than white space: no word spans such a place."""
    out, at = [], 0
    while len(text) - at > STRETCH:
        cut = at + STRETCH
        while cut < len(text) and not (text[cut] == " " and not text[cut - 1].isspace()):
            cut += 1
        if cut >= len(text):
            break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def _word_starts(points: np.ndarray, kind: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where words begin: runs of one class, with one space before; 's 't 're 've 'm 'll 'd stand alone.

    Of white space before something else, the last character stands alone or, if a plain space, goes
    with what follows.
    """
    n = len(points)
    starts = begins.copy()
    starts[1:n] |= kind[1:] != kind[:-1]
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begins[1:n])
    starts[last] = True
    starts[last + 1] = points[last] != 32
    short = np.flatnonzero((points[: n - 1] == 39) & starts[: n - 1] & (kind[1:] == LETTER) & ~begins[1:n])
    one = points[short + 1]
    single = np.isin(one, (_S, _T, _M, _D))
    two = short[~single & (short + 2 < n)]
    a, b = points[two + 1], points[two + 2]
    double = ((((a == _R) | (a == _V)) & (b == _E)) | ((a == _L) & (b == _L))) & ~begins[two + 2]
    for where, wide in ((short[single], 2), (two[double], 3)):
        starts[where + 1] = False
        starts[where + wide] |= True
    return starts


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)
