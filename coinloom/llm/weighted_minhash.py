"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. Document frequencies of all shingles go into a count-min sketch of fixed size.
2. Every text gets 48 consistent weighted samples and 12 band keys of 4 samples.
3. In each bucket of a band the first text leads those that agree with it in enough samples; every text
   is verified against the leader that it agrees with best, by exact weighted Jaccard similarity.
   These links, one a text at most, give first components.
4. Texts of a bucket that agree with one of another component meet there with their shingles; they are
   decided by exact weighted Jaccard similarity inside the group, which hands out only the links that
   join components, fewer than it has members.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinloom.llm.kernels import U64, Words, counted, mixed, shingles
from coinloom.llm.kernels import pieces as slices
from coinloom.llm.pairs import blocked_members, dealt, run_groups, sized
from coinloom.operators.components import connected_components
from coinloom.operators.scratch import staged

SHINGLE = 5
SKETCH_BITS = 18
CHUNK = 4096
BANDS, ROWS = 12, 4
SAMPLES = BANDS * ROWS
# Of 48 samples, how many must agree before a pair is verified: at a similarity of 0.8 fewer than 29
# agree in 1 of 2,000 pairs. Pairs with SURE or more are tried first.
AGREE, SURE = 29, 42
# A shingle's weight is its count times 1 (it stands in every document) to 1 + IDF_GAIN (it stands in
# at most one of RARE documents, or in one).
IDF_GAIN, RARE = 0.25, 4096
# Words of 64 bits of the sketch of the texts that are fetched.
LIKELY_WORDS = 1 << 18
# Members and bytes of text of a block of a bucket; two blocks meet in a task.
BLOCK, BLOCK_BYTES = 2048, 8_000_000


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = U64((1 << SKETCH_BITS) - 1)
    return (hashes & low).astype(np.int64), ((hashes >> U64(24)) & low).astype(np.int64)


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return counted(*shingles(Words(texts), SHINGLE))


@dataclass(frozen=True)
class Frequencies:
    """A count-min sketch of document frequencies (two rows of 2^18 counters) as weights."""

    weights: np.ndarray
    documents: int

    @staticmethod
    def of(counts: np.ndarray, n: int) -> Frequencies:
        """From the counters of n documents: less what other shingles add to a counter on average.

        Weights go by the share of documents that hold a shingle, and so does what the sketch can
        tell apart; neither changes as the corpus grows.
        """
        width = counts.shape[1]
        others = (counts.sum(1, keepdims=True) - counts) / (width - 1)
        share = np.clip(counts - others, 1, max(n, 1)) / max(n, 1)
        fall = -np.log(share) / np.log(max(2, min(n, RARE)))
        return Frequencies((1 + IDF_GAIN * np.clip(fall, 0, 1)).astype(np.float32), n)

    def idf(self, hashes: np.ndarray) -> np.ndarray:
        """1 to 1 + IDF_GAIN. The smaller counter means the larger weight."""
        a, b = _slots(hashes)
        return np.maximum(self.weights[0][a], self.weights[1][b])


def document_frequencies(texts: DataFrame, text: str = "text") -> Frequencies:
    """Count every shingle of every row once a text; the sketch, not the shingles, reaches the driver.

    Its size is fixed: 2 x 2^18 counters, 4 MB.
    """
    width = 1 << SKETCH_BITS
    schema = "part int, salt int, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((2, width), np.int64), 0
        for batch in batches:
            for part in slices(batch, text):
                _, hashes, _ = _features(part.column(text))
                for row, slot in enumerate(_slots(hashes)):
                    total[row] += np.bincount(slot, minlength=width)
                n += part.num_rows
        if n:
            blobs = [x.astype(np.int64).tobytes() for x in total.reshape(-1, CHUNK)] + [np.int64(n).tobytes()]
            salt = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(range(len(blobs)), pa.int32()),
                    "salt": pa.array([salt] * len(blobs), pa.int32()),
                    "counts": pa.array(blobs, pa.binary()),
                }
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for p, s, c in zip(*(batch.column(k).to_pylist() for k in ("part", "salt", "counts")), strict=True):
                have = sums.get((p, s))
                sums[p, s] = np.frombuffer(c, np.int64) + (0 if have is None else have)
        if sums:
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([p for p, _ in sums], pa.int32()),
                    "salt": pa.array([s for _, s in sums], pa.int32()),
                    "counts": pa.array([x.tobytes() for x in sums.values()], pa.binary()),
                }
            )

    partial = texts.select(text).mapInArrow(count, schema)
    salted = partial.repartition("part", "salt").mapInArrow(add, schema)
    summed = salted.withColumn("salt", F.lit(0)).repartition("part").mapInArrow(add, schema)
    rows = {r["part"]: np.frombuffer(r["counts"], np.int64) for r in summed.collect()}  # fixed number of rows
    n_chunks = 2 * width // CHUNK
    n = int(rows[n_chunks][0]) if rows else 0
    table = np.concatenate([rows[i] for i in range(n_chunks)]).reshape(2, width) if rows else np.zeros((2, width))
    return Frequencies.of(table, n)


def _random_tables() -> tuple[np.ndarray, ...]:
    """r and c of Gamma(2, 1) and beta of U(0, 1) for 2^16 values of a hash, and an odd multiplier per sample."""
    rng = np.random.default_rng(97)
    u = rng.random((5, 1 << 16))
    r = -np.log(u[0] * u[1])
    c = np.log(-np.log(u[2] * u[3]))
    odd = rng.integers(1, 2**62, SAMPLES, dtype=np.int64).astype(U64) * U64(2) + U64(1)
    return r.astype(np.float32), (1 / r).astype(np.float32), c.astype(np.float32), u[4].astype(np.float32), odd


_tables: list[tuple[np.ndarray, ...]] = []


def samples(docs: np.ndarray, hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct docs, their samples as uint32, a column for each); rows must be sorted by doc."""
    if not _tables:
        _tables.append(_random_tables())
    r, r_inv, ln_c, beta, odd = _tables[0]
    new = np.ones(len(docs), dtype=bool)
    new[1:] = docs[1:] != docs[:-1]
    at = np.flatnonzero(new)
    out = np.empty((len(at), SAMPLES), dtype=np.uint32)
    if not len(at):
        return docs[at], out
    ln_w = np.log(weights).astype(np.float32)
    name = (hashes ^ (hashes >> U64(20))).astype(np.uint32)
    for k in range(SAMPLES):
        i = ((hashes * odd[k]) >> U64(48)).astype(np.int32)
        rk, bk = r[i], beta[i]
        t = np.floor(ln_w * r_inv[i] + bk)
        ln_a = ln_c[i] - rk * (t - bk + np.float32(1))
        bits = ln_a.view(np.int32)
        order = (bits ^ ((bits >> 31) | np.int32(-(2**31)))).view(np.uint32)
        pick = name + t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1)
        best = np.minimum.reduceat((order.astype(U64) << U64(32)) | pick, at)
        out[:, k] = best.astype(np.uint32)
    return docs[at], out


def signatures(docs: DataFrame, frequencies: Frequencies) -> DataFrame:
    """`doc_id, print, bands, sig` of every row; texts without words have null bands and sig."""
    shared = docs.sparkSession.sparkContext.broadcast(frequencies)
    kind = dict(docs.dtypes)["doc_id"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = shared.value
        for batch in batches:
            for part in slices(batch, "text", 4096, 1_000_000):
                where, hashes, times = _features(part.column("text"))
                have, sig = samples(where, hashes, times * freq.idf(hashes))
                wide = sig.reshape(len(have), BANDS, ROWS).astype(U64)
                keys = np.zeros((len(have), BANDS), U64)
                for k in range(ROWS):
                    keys = mixed(keys + wide[:, :, k] + U64(0x9E3779B97F4A7C15))
                keys = mixed(keys + np.arange(BANDS, dtype=U64))
                bands: list = [None] * part.num_rows
                sigs: list = [None] * part.num_rows
                short = _short(sig)
                for j, d in enumerate(have.tolist()):
                    bands[d] = keys[j].view(np.int64)
                    sigs[d] = short[j].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("print"),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(sigs, pa.binary()),
                    ],
                    ["doc_id", "print", "bands", "sig"],
                )

    return docs.select("doc_id", "print", "text").mapInArrow(
        sign, f"doc_id {kind}, print string, bands array<long>, sig binary"
    )


def _short(sig: np.ndarray) -> np.ndarray:
    """One byte of each sample."""
    return (sig ^ (sig >> np.uint32(16)) ^ (sig >> np.uint32(8))).astype(np.uint8)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


GROUP = ["bucket", "_bi", "_bj"]


def _bands(group: pa.RecordBatch) -> tuple[np.ndarray, int]:
    """The band keys of a group's members, and which band the group belongs to."""
    bands = group.column("bands").flatten().to_numpy().reshape(group.num_rows, BANDS)
    return bands, int(np.flatnonzero(bands[0] == group.column("bucket")[0].as_py())[0])


def _leaders(members: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, one for a node b at most: the leader that b agrees with best.

    The leaders of a group are its smallest node, the smallest of those that do not agree with it, and
    so on.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, ...]] = []

        def work(group: pa.RecordBatch) -> None:
            node, sig = group.column("node").to_numpy(), _matrix(group.column("sig"))
            while len(node) > 1:
                same = (sig[1:] == sig[0]).sum(1)
                near = same >= AGREE
                if near.any():
                    out.append((np.full(int(near.sum()), node[0]), node[1:][near], same[near]))
                node, sig = node[1:][~near], sig[1:][~near]

        for _ in run_groups(batches, GROUP, work):
            if out:
                columns = [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)]
                out.clear()
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "same"])

    met = dealt(blocked_members(members, "bucket", "node"), "bucket", "node")
    best = F.max(F.struct("same", (-F.col("a")).alias("low"))).alias("m")
    return met.mapInArrow(find, "a long, b long, same long").groupBy("b").agg(best).select((-F.col("m.low")).alias("a"), "b")


def _open_places(members: DataFrame) -> DataFrame:
    """`bucket, node` of nodes whose samples agree with those of a node of another component in a bucket.

    Two nodes that meet in several bands count in the first of them only.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def work(group: pa.RecordBatch) -> None:
            comp = group.column("component").to_numpy()
            if (comp == comp[0]).all():
                return
            node, sig = group.column("node").to_numpy(), _matrix(group.column("sig"))
            bands, here = _bands(group)
            touched = np.zeros(len(node), bool)
            for i in range(len(node) - 1):
                other = np.flatnonzero(comp[i + 1 :] != comp[i]) + i + 1
                near = other[(sig[other] == sig[i]).sum(1) >= AGREE]
                near = near[~(bands[near, :here] == bands[i, :here]).any(1)]
                touched[near] = True
                touched[i] |= len(near) > 0
            if touched.any():
                bucket = group.column("bucket").to_numpy()
                out.append((bucket[touched], node[touched]))

        for _ in run_groups(batches, GROUP, work):
            if out:
                columns = [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)]
                out.clear()
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "node"])

    met = dealt(blocked_members(members, "bucket", "node"), "bucket", "node")
    return met.mapInArrow(find, "bucket long, node long").distinct()


def _decided(groups: DataFrame, frequencies: Frequencies, threshold: float) -> DataFrame:
    """(a, b) of links that join different components, decided inside the groups by exact similarity.

    A group of m nodes gives fewer than m links: pairs that links found so far have joined are passed
    over, and so are pairs that meet in an earlier band or whose total weights lie too far apart.
    """
    shared = groups.sparkSession.sparkContext.broadcast(frequencies)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []

        def work(group: pa.RecordBatch) -> None:
            comp = group.column("component").to_numpy()
            if (comp == comp[0]).all():
                return
            node, sig = group.column("node").to_numpy(), _matrix(group.column("sig"))
            part = np.unique(comp, return_inverse=True)[1]
            bands, here = _bands(group)
            sets = ShingleSets(group.column("text"), shared.value)
            for low, high in ((SURE, SAMPLES + 1), (AGREE, SURE)):
                for i in range(len(node) - 1):
                    other = np.flatnonzero(part[i + 1 :] != part[i]) + i + 1
                    same = (sig[other] == sig[i]).sum(1)
                    near = (same >= low) & (same < high)
                    other, same = other[near], same[near]
                    light, heavy = np.minimum(sets.total[i], sets.total[other]), np.maximum(sets.total[i], sets.total[other])
                    fits = (light >= (threshold - 1e-6) * heavy) & ~(bands[other, :here] == bands[i, :here]).any(1)
                    other = other[fits][np.argsort(-same[fits], kind="stable")]
                    while len(other):  # the likeliest first; what they join needs no further look
                        tried, other = other[:32], other[32:]
                        for j in tried[sets.similarity(i, tried) >= threshold - 1e-9]:
                            if part[j] != part[i]:
                                out.append((int(node[i]), int(node[j])))
                                part[part == part[j]] = part[i]
                        other = other[part[other] != part[i]]

        for _ in run_groups(batches, GROUP, work):
            if out:
                a, b = np.array(out, np.int64).T
                out.clear()
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return groups.mapInArrow(find, "a long, b long").distinct()


class ShingleSets:
    """Weighted shingle sets of a group's texts: sorted 48-bit hashes and weights, text after text."""

    def __init__(self, texts: pa.Array, frequencies: Frequencies) -> None:
        hashes, weights, counts = [], [], []
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            where, h, times = _features(part.column("text"))
            hashes.append(h)
            weights.append(times * frequencies.idf(h).astype(np.float64))
            counts.append(np.bincount(where, minlength=part.num_rows))
        self.hashes, self.weights, self.count = (np.concatenate(x) for x in (hashes, weights, counts))
        self.first = np.cumsum(self.count) - self.count
        owner = np.repeat(np.arange(len(self.count)), self.count)
        self.total = np.bincount(owner, self.weights, minlength=len(self.count))

    def similarity(self, one: int, others: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of one text with others."""
        own = slice(self.first[one], self.first[one] + self.count[one])
        h, w, n = self.hashes[own], self.weights[own], self.count[others]
        if not len(h):
            return np.zeros(len(others))
        owner = np.repeat(np.arange(len(others)), n)
        row = np.arange(n.sum()) + np.repeat(self.first[others] - (np.cumsum(n) - n), n)
        at = np.minimum(np.searchsorted(h, self.hashes[row]), len(h) - 1)
        low = np.where(h[at] == self.hashes[row], np.minimum(w[at], self.weights[row]), 0.0)
        low = np.bincount(owner, low, minlength=len(others))
        return low / (self.total[one] + self.total[others] - low)


def _verified(pairs: DataFrame, texts: DataFrame, frequencies: Frequencies, threshold: float, each: int = 64) -> DataFrame:
    """(a, b) of the pairs whose weighted Jaccard similarity reaches the threshold.

    A node's text is sent once for every `each` partners; a task holds one text's shingles and the
    batch at hand.
    """
    shared = texts.sparkSession.sparkContext.broadcast(frequencies)
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / each).alias("_k"))
    todo = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), F.col("_k")).alias("chunk"), "b")
    lefts = todo.select("a", "chunk").distinct().join(texts, F.col("a") == F.col("node"))
    rights = todo.join(texts, F.col("b") == F.col("node"))
    lined = (
        lefts.select("a", "chunk", F.lit(None).cast("long").alias("b"), "text")
        .unionByName(rights.select("a", "chunk", "b", "text"))
        .repartition("a", "chunk")
        .sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = shared.value
        left: tuple[np.ndarray, np.ndarray] = (np.zeros(0, U64), np.zeros(0))
        for batch in batches:
            for part in slices(batch, "text"):
                where, hashes, times = _features(part.column("text"))
                weights = times * freq.idf(hashes).astype(np.float64)
                bounds = np.searchsorted(where, np.arange(part.num_rows + 1))
                hit_a, hit_b = [], []
                for i, (a, b) in enumerate(
                    zip(part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True)
                ):
                    own = slice(bounds[i], bounds[i + 1])
                    h, w = hashes[own], weights[own]
                    if b is None:
                        left = (h.copy(), w.copy())
                    elif _jaccard(*left, h, w) >= threshold - 1e-9:
                        hit_a.append(a)
                        hit_b.append(b)
                if hit_a:
                    yield pa.RecordBatch.from_pydict({"a": pa.array(hit_a, pa.int64()), "b": pa.array(hit_b, pa.int64())})

    return lined.mapInArrow(verify, "a long, b long")


def _jaccard(h1: np.ndarray, w1: np.ndarray, h2: np.ndarray, w2: np.ndarray) -> float:
    if not len(h1) or not len(h2):
        return 0.0
    at = np.minimum(np.searchsorted(h1, h2), len(h1) - 1)
    same = h1[at] == h2
    low = np.minimum(w1[at[same]], w2[same]).sum()
    return float(low / (w1.sum() + w2.sum() - low))


def likely(rows: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """`rows` without most of those whose keys are not in `wanted`, and with all whose keys are.

    One bit a key of `wanted` in a sketch of fixed size, at most LIKELY_WORDS words, which is broadcast;
    so a join that follows shuffles few rows that it drops.
    """
    h = F.xxhash64(*keys)
    bit = F.call_function("shiftrightunsigned", h, F.lit(40)).bitwiseAND(F.lit(63)).cast("int")
    placed = {"_word": F.pmod(h, F.lit(LIKELY_WORDS)), "_bit": F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)}
    held = staged(wanted.select(*(c.alias(n) for n, c in placed.items())).groupBy("_word").agg(F.bit_or("_bit").alias("_held")))
    met = rows.withColumns(placed).join(F.broadcast(held), "_word")
    return met.filter(F.col("_bit").bitwiseAND(F.col("_held")) != 0).select(*rows.columns)


def nameless_class(text: Column) -> Column:
    """The negative class id of texts that have no doc_id."""
    return -2 - F.shiftrightunsigned(F.xxhash64(F.md5(text)), 1)


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """`doc_id, class_id, kept` for every row of `docs` (doc_id, text).

    A class is a component of links; two texts link if the weighted Jaccard similarity of their
    TF-IDF five-word shingles is at least `threshold`, or if they are equal. `class_id` is the
    smallest doc_id of the class, `kept` marks the row that stays (that doc_id).

    A null text counts as empty; empty texts are equal to each other, and a text without words links
    with equal texts only. Rows that share a doc_id share a class. Rows whose doc_id is null belong
    to their text's class; if all its ids are null, the class gets a negative id from a hash of the
    text and no row of it is marked as kept but the null ones. Extra columns are ignored; an empty
    table gives an empty table.
    """
    base = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("print", F.md5("text"))
    frequencies = document_frequencies(base)
    signed = staged(signatures(base, frequencies))
    nameless = -2 - F.shiftrightunsigned(F.xxhash64("print"), 1)
    nodes = staged(
        signed.groupBy("print")
        .agg(F.min("doc_id").alias("low"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
        .select("print", F.coalesce(F.col("low"), nameless).cast("long").alias("node"), "bands", "sig")
    )
    keys = nodes.filter("bands is not null").select("node", F.explode("bands").alias("bucket"))
    members = staged(sized(keys, "bucket", "node"))
    wanted = members.select("node").distinct()
    near = staged(nodes.join(wanted, "node", "left_semi"))
    named = base.select(F.coalesce(F.col("doc_id"), nameless).cast("long").alias("node"), "print", "text")
    fetched = near.select("node", "print")
    texts = staged(
        likely(named, fetched, "node", "print").join(fetched, ["node", "print"]).groupBy("node").agg(F.first("text").alias("text"))
    )
    links = staged(_verified(staged(_leaders(members.join(near.select("node", "sig"), "node"))), texts, frequencies, threshold))
    found = staged(connected_components(links, "a", "b"))
    marked = staged(
        near.join(found, "node", "left").select("node", "sig", "bands", F.coalesce("component", "node").alias("component"))
    )
    still_open = staged(_open_places(members.join(marked, "node")))
    long = texts.select("node", F.octet_length("text").alias("size"))
    met = blocked_members(
        sized(still_open.join(long, "node"), "bucket", "node", "size"), "bucket", "node", BLOCK, most=BLOCK_BYTES
    )
    groups = dealt(met.join(marked, "node").join(texts, "node"), "bucket", "node")
    more = staged(_decided(groups, frequencies, threshold))
    whole = connected_components(links.unionByName(more), "a", "b")
    classes = (
        nodes.select("print", "node")
        .join(whole, "node", "left")
        .select("print", F.coalesce("component", "node").alias("class_id"))
    )
    return signed.select("doc_id", "print").join(classes, "print").select(
        "doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id") < 0).alias("kept")
    )
