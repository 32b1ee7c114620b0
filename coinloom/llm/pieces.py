"""SentencePiece ids with the original bytes of every piece.

The model's own normaliser runs here, by longest prefix through its compiled character map, and
records for each normalised byte where it came from; the library then segments the normalised text
(its own normaliser switched off), and the lengths of the pieces, laid over that record, give every
piece's span in the original text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinloom.llm.kernels import pieces as slices

SPACE = "▁".encode()


class CharacterMap:
    """A compiled character map: a double-array trie of prefixes, and their replacements."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist() if blob else []
        self.out = blob[4 + size :] if blob else b""

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest prefix of text[at:] in the map."""
        units, found = self.units, None

        def jump(unit: int) -> int:
            return (unit >> 10) << ((unit & 0x200) >> 6)

        node = jump(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units) or units[node] & 0x800000FF != text[i]:
                break
            unit = units[node]
            node ^= jump(unit)
            if unit >> 8 & 1:
                found = (units[node] & 0x7FFFFFFF, i + 1 - at)
        if found is None:
            return None
        start = found[0]
        return self.out[start : self.out.index(b"\0", start)], found[1]


class Normaliser:
    """Normalise as a model says, with the original place of every normalised byte."""

    def __init__(self, spec) -> None:
        self.map = CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None
        self.prefix, self.trim, self.mark = (
            spec.add_dummy_prefix,
            spec.remove_extra_whitespaces,
            SPACE if spec.escape_whitespaces else b" ",
        )

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, n + 1 places): byte i comes from original bytes place[i] up to the next greater place."""
        raw = text.encode()
        if not raw:
            return b"", np.zeros(1, np.int64)
        return self._plain(raw) if self.map is None and not self.trim else self._mapped(raw)

    def _plain(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        body = raw.replace(b" ", self.mark)
        head = self.mark if self.prefix else b""
        wide = np.where(np.frombuffer(raw, np.uint8) == 32, len(self.mark), 1)
        places = np.repeat(np.arange(len(raw)), wide)
        return head + body, np.concatenate([np.zeros(len(head), np.int64), places, [len(raw)]])

    def _mapped(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        out, places, at, n = bytearray(), [], 0, len(raw)

        def next_piece(i: int) -> tuple[bytes, int]:
            found = self.map.longest(raw, i) if self.map else None
            if found:
                return found
            k = 1 + (raw[i] >= 0xC0) + (raw[i] >= 0xE0) + (raw[i] >= 0xF0)
            return raw[i : i + k], k

        while self.trim and at < n:
            piece, k = next_piece(at)
            if piece != b" ":
                break
            at += k
        if at >= n:
            return b"", np.full(1, n)
        if self.prefix:
            out += self.mark
            places += [at] * len(self.mark)
        spaced = self.trim
        while at < n:
            piece, k = next_piece(at)
            if spaced and self.trim:
                piece = piece.lstrip(b" ")
            if piece:
                for c in piece:
                    add = self.mark if c == 32 else bytes((c,))
                    out += add
                    places += [at] * len(add)
                spaced = piece.endswith(b" ")
            at += k
            if not self.trim:
                spaced = False
        if self.trim:
            while out.endswith(self.mark):
                del out[-len(self.mark) :]
                at = places[-len(self.mark)]
                del places[-len(self.mark) :]
        return bytes(out), np.array([*places, at], dtype=np.int64)


class Encoder:
    """Encode and decode with one model file. Models with user-defined symbols are refused."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            blob = f.read()
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(blob)
        if any(p.type == p.USER_DEFINED for p in model.pieces):
            raise ValueError("models with user-defined symbols are not supported")
        self.normalise = Normaliser(model.normalizer_spec)
        self.width = np.array(
            [1 if p.type == p.BYTE else len(p.piece.encode()) for p in model.pieces], dtype=np.int64
        )
        self.unknown = {i for i, p in enumerate(model.pieces) if p.type == p.UNKNOWN}
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=blob)
        spec = model.normalizer_spec
        spec.precompiled_charsmap, spec.name = b"", "identity"
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.names = [str(i) for i in range(len(model.pieces))]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """(ids, start, end) of each text: original byte spans of its pieces, end exclusive.

        A piece that begins inside a replaced or marked character spans the whole of it; the added
        first mark has an empty span of its own at 0.
        """
        normal = [self.normalise(t) for t in texts]
        found = self.segmenter.encode([n.decode() for n, _ in normal], num_threads=1)
        for ids, (norm, places) in zip(found, normal, strict=True):
            wide = self.width[ids] if ids else np.zeros(0, np.int64)
            if wide.sum() != len(norm):
                wide = self._with_unknown(ids, norm)
            ends = np.cumsum(wide)
            yield ids, places[ends - wide], places[ends]

    def _with_unknown(self, ids: list[int], norm: bytes) -> np.ndarray:
        """Widths where unknown pieces stand for stretches between known ones."""
        shown = self.segmenter.encode(norm.decode(), out_type=str)
        wide = self.width[ids]
        for k, i in enumerate(ids):
            if i in self.unknown:
                wide[k] = len(shown[k].encode())
        if wide.sum() != len(norm):
            raise ValueError("pieces do not cover the normalised text")
        return wide


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_documents(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key, ids, starts, ends` for every row: the ids of its whole text and each piece's byte span.

    A null text counts as empty and has no piece. Keys may be null or repeat; rows stay separate.
    Other columns are ignored. `model` is a path that every executor can read.
    """
    schema = f"{key} {dict(docs.dtypes)[key]}, ids array<int>, starts array<int>, ends array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(model)
        for batch in batches:
            for part in slices(batch, text):
                rows = list(enc.encode([t or "" for t in part.column(text).to_pylist()]))
                columns = [pa.array([r[k] for r in rows], pa.list_(pa.int32())) for k in range(3)]
                yield pa.RecordBatch.from_arrays([part.column(key), *columns], [key, "ids", "starts", "ends"])

    return docs.select(key, text).mapInArrow(run, schema)


def digest_documents(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256, covered_bytes` (and `ids`) of every whole text.

    The ids and spans come from `Encoder.encode` and are digested where they are made, so that the
    long arrays never leave the task. `covered_bytes` is where the last piece's span ends.
    """
    schema = (
        f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string, "
        "covered_bytes long" + (", ids array<int>" if with_ids else "")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(model)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for part in slices(batch, "text", 256, 1_000_000):
                n, ids_sha, text_sha, covered, kept = [], [], [], [], []
                for ids, _, ends in enc.encode([t or "" for t in part.column("text").to_pylist()]):
                    n.append(len(ids))
                    ids_sha.append(sha(",".join([enc.names[i] for i in ids]).encode()))
                    text_sha.append(sha(enc.decoder.decode(ids).encode()))
                    covered.append(int(ends[-1]) if len(ends) else 0)
                    if with_ids:
                        kept.append(np.array(ids, dtype=np.int32))
                columns = {
                    "doc_id": part.column("doc_id"),
                    "n_tokens": pa.array(n, pa.int64()),
                    "ids_sha256": pa.array(ids_sha, pa.string()),
                    "decoded_sha256": pa.array(text_sha, pa.string()),
                    "covered_bytes": pa.array(covered, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(kept, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col("doc_id"), F.col("text")).mapInArrow(run, schema)
