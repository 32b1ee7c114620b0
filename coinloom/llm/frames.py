"""Fill-in-middle over seekable compressed texts.

A text is kept as independent zstandard frames with running counts of code points and bytes, so any
stretch of it can be read by opening the frames that it touches. Rearranging a text around a middle
opens the two frames that hold the cuts and passes all others on as they are; the result is again
such a run of frames (on end they are one valid zstandard stream), and digests read it frame by frame.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from coinloom.llm.kernels import pieces as slices

FRAME_UNITS = 16_384
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TAGS = (PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode())
_COLUMNS = "frames binary, unit_ends array<bigint>, byte_ends array<bigint>"
_packer, _opener = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _units(raw: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(raw.decode())


@dataclass
class Frames:
    """Frames on end, and where each one stops in code points and in compressed bytes."""

    data: bytes | bytearray = field(default_factory=bytearray)
    unit_ends: list[int] = field(default_factory=list)
    byte_ends: list[int] = field(default_factory=list)

    @property
    def units(self) -> int:
        return self.unit_ends[-1] if self.unit_ends else 0

    def add(self, raw: bytes) -> None:
        """One frame of its own for these UTF-8 bytes; none for no bytes."""
        if raw:
            self._append(_packer.compress(raw), _units(raw))

    def _append(self, frame: bytes, units: int) -> None:
        self.data += frame
        self.unit_ends.append(self.units + units)
        self.byte_ends.append(len(self.data))

    def _bounds(self, k: int) -> tuple[int, int, int, int]:
        """First and last unit, first and last byte of frame k."""
        return (self.unit_ends[k - 1] if k else 0, self.unit_ends[k], self.byte_ends[k - 1] if k else 0, self.byte_ends[k])

    def frame(self, k: int) -> bytes:
        """Frame k as it is kept."""
        _, _, lo, hi = self._bounds(k)
        return bytes(memoryview(self.data)[lo:hi])

    def open(self, k: int) -> bytes:
        """The UTF-8 bytes in frame k."""
        return _opener.decompress(self.frame(k))

    def each(self) -> Iterator[bytes]:
        return map(self.open, range(len(self.unit_ends)))

    def touched(self, start: int, stop: int) -> Iterator[tuple[int, int, int]]:
        """(frame, first, last unit within it) of the frames that code points start to stop touch."""
        k = bisect_right(self.unit_ends, start)
        while start < stop and k < len(self.unit_ends):
            lo, hi, _, _ = self._bounds(k)
            yield k, max(start, lo) - lo, min(stop, hi) - lo
            k += 1
            start = hi

    def read(self, start: int, stop: int) -> Iterator[bytes]:
        """The UTF-8 bytes of code points start to stop, opening no other frame than theirs."""
        for k, a, b in self.touched(start, stop):
            raw = self.open(k)
            lo, hi, _, _ = self._bounds(k)
            yield raw if b - a == hi - lo else raw.decode()[a:b].encode()

    def copy(self, source: Frames, start: int, stop: int) -> None:
        """Append code points start to stop of `source`: whole frames as they are, cut ones anew."""
        for k, a, b in source.touched(start, stop):
            lo, hi, _, _ = source._bounds(k)
            if b - a == hi - lo:
                self._append(source.frame(k), hi - lo)
            else:
                self.add(source.open(k).decode()[a:b].encode())


def framed(text: str | None, frame_units: int = FRAME_UNITS) -> Frames:
    """A text as frames of at most `frame_units` code points; null counts as empty, which has no frame."""
    out, text = Frames(), text or ""
    for at in range(0, len(text), frame_units):
        out.add(text[at : at + frame_units].encode())
    return out


def tag_places(frames: Frames) -> dict[bytes, int]:
    """The first place, in code points, of each of the three marks that occurs, also across frames."""
    found: dict[bytes, int] = {}
    rest, done = b"", 0
    for raw in frames.each():
        joined = rest + raw
        for tag in TAGS:
            if tag not in found and (at := joined.find(tag)) >= 0:
                # What a mark has in common with the rest of the frame before is ASCII: a unit a byte.
                found[tag] = done + (_units(raw[: at - len(rest)]) if at >= len(rest) else at - len(rest))
        done += _units(raw)
        # Two bytes carry the start of a mark; cut inside a character they match nothing.
        rest = joined[-2:]
    return found


@dataclass
class Choice:
    form: str
    first: int
    second: int


def choose(doc_id: int | None, n: int, marked: bool) -> Choice:
    """Form and cuts of a document of n code points, from a hash of its id; a null id hashes as no digits."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or marked or h3 % 100 >= 90:
        return Choice("plain", first, second)
    return Choice("spm" if h4 % 100 < 20 else "psm", first, second)


def rearranged(source: Frames, choice: Choice) -> Frames:
    """The output of a document: `<P>` prefix `<S>` suffix `<M>` middle, suffix first under spm, or as it is."""
    if choice.form == "plain":
        return source
    prefix, middle, suffix = (0, choice.first), (choice.first, choice.second), (choice.second, source.units)
    parts = [(PREFIX, prefix), (SUFFIX, suffix)]
    out = Frames()
    for tag, (start, stop) in [*(parts if choice.form == "psm" else parts[::-1]), (MIDDLE, middle)]:
        out.add(tag.encode())
        out.copy(source, start, stop)
    return out


def restored(output: Frames, form: str) -> Iterator[bytes]:
    """The document's bytes, read from its output by the places of the marks."""
    if form == "plain":
        yield from output.each()
        return
    at = tag_places(output)
    p, s, m = (at[t] for t in TAGS)
    wide = len(PREFIX)
    prefix, suffix = ((p + wide, s), (s + wide, m)) if form == "psm" else ((p + wide, m), (s + wide, p))
    for start, stop in (prefix, (m + wide, output.units), suffix):
        yield from output.read(start, stop)


def _read(part: pa.RecordBatch) -> list[Frames]:
    columns = (part.column(c).to_pylist() for c in ("frames", "unit_ends", "byte_ends"))
    return [Frames(*row) for row in zip(*columns, strict=True)]


def _written(frames: list[Frames]) -> dict[str, pa.Array]:
    return {
        "frames": pa.array([bytes(f.data) for f in frames], pa.binary()),
        "unit_ends": pa.array([f.unit_ends for f in frames], pa.list_(pa.int64())),
        "byte_ends": pa.array([f.byte_ends for f in frames], pa.list_(pa.int64())),
    }


def store_frames(docs: DataFrame, key: str = "doc_id", text: str = "text", frame_units: int = FRAME_UNITS) -> DataFrame:
    """`key, frames, unit_ends, byte_ends`: every whole text as independent frames with running counts.

    A null or empty text has no frame. Keys may be null or repeat; rows stay separate, other columns
    are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, 512):
                rows = [framed(t, frame_units) for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_pydict({key: part.column(key), **_written(rows)})

    return docs.select(key, text).mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, {_COLUMNS}")


def fill_in_middle(stored: DataFrame) -> DataFrame:
    """`doc_id, n, form, prefix_chars, middle_chars` and the output as frames, for rows of `store_frames`.

    A text that holds a mark already, an empty one and a tenth of the others stay plain, with null
    prefix and middle. Cuts may fall on the ends, so prefix, middle or suffix may be empty.
    """
    schema = f"doc_id {dict(stored.dtypes)['doc_id']}, n bigint, form string, prefix_chars bigint, middle_chars bigint, {_COLUMNS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "frames", 512):
                sources = _read(part)
                picks = [choose(d, f.units, bool(tag_places(f))) for d, f in zip(part.column("doc_id").to_pylist(), sources, strict=True)]
                cut = [None if c.form == "plain" else (c.first, c.second - c.first) for c in picks]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n": pa.array([f.units for f in sources], pa.int64()),
                        "form": pa.array([c.form for c in picks], pa.string()),
                        "prefix_chars": pa.array([c and c[0] for c in cut], pa.int64()),
                        "middle_chars": pa.array([c and c[1] for c in cut], pa.int64()),
                        **_written([rearranged(f, c) for f, c in zip(sources, picks, strict=True)]),
                    }
                )

    return stored.select("doc_id", "frames", "unit_ends", "byte_ends").mapInArrow(run, schema)


def digest_outputs(outputs: DataFrame) -> DataFrame:
    """Rows of `fill_in_middle` with `output_sha256, restored_sha256` in place of the frames, one frame in memory at a time."""
    told = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    types = dict(outputs.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in told) + ", output_sha256 string, restored_sha256 string"

    def sha(parts: Iterator[bytes]) -> str:
        digest = hashlib.sha256()
        for raw in parts:
            digest.update(raw)
        return digest.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "frames", 512):
                rows = _read(part)
                back = [sha(restored(f, form)) for f, form in zip(rows, part.column("form").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {c: part.column(c) for c in told}
                    | {"output_sha256": pa.array([sha(f.each()) for f in rows], pa.string()), "restored_sha256": pa.array(back, pa.string())}
                )

    return outputs.select(*told, "frames", "unit_ends", "byte_ends").mapInArrow(run, schema)


def read_spans(stored: DataFrame, start: str, stop: str) -> DataFrame:
    """Rows of stored texts plus `span`: the code points from column `start` up to `stop`, by opening the frames they touch.

    Bounds beyond the text are cut to it; a null bound gives a null span.
    """
    kept = [c for c in stored.columns if c not in ("frames", "unit_ends", "byte_ends")]
    types = dict(stored.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "frames", 512):
                bounds = zip(part.column(start).to_pylist(), part.column(stop).to_pylist(), strict=True)
                spans = [None if a is None or b is None else b"".join(f.read(max(a, 0), b)).decode() for f, (a, b) in zip(_read(part), bounds, strict=True)]
                yield pa.RecordBatch.from_pydict({c: part.column(c) for c in kept} | {"span": pa.array(spans, pa.string())})

    return stored.mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in kept) + ", span string")
