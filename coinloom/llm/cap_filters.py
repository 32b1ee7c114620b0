"""Near-duplicate vectors by spherical-cap filters from random product codes.

A vector is rotated and cut in two halves; each half has a random code of unit vectors, and a pair of
codewords is a filter direction. A vector is list-decoded to all directions whose inner product with
it passes a threshold. Near vectors exceed many of the same directions, so vectors of one label are
joined on directions and compared exactly there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinloom.llm.pairs import blocked_members, dealt, run_groups, sized
from coinloom.operators.components import connected_components
from coinloom.operators.scratch import staged

# Directions that a vector exceeds, on average: so many for each factor of ten in the largest label above 1,000
# vectors, and for 10,000 at least. Caps shrink as labels grow, so that CROWD vectors of one lie under a direction;
# the longer lists keep the chance that a link shares no direction alike.
LIST, CROWD = 24, 256
# A vector with fewer directions above the threshold gets its best ones, so many.
PROBES = 100
BLOCK = 2048


@dataclass(frozen=True)
class ProductCode:
    rotation: np.ndarray
    first: np.ndarray
    second: np.ndarray
    threshold: float
    least: int

    @staticmethod
    def fitted(dim: int, vectors: int) -> ProductCode:
        """A code for labels of `vectors` members at most: the more vectors, the more and the smaller caps.

        The threshold is set so that random unit vectors exceed a list's length of directions on
        average; a vector that exceeds fewer gets that many of its best ones. It is found from PROBES of
        them by counting, which takes about as many steps as a half has codewords: the square root of
        `vectors`.
        """
        rng = np.random.default_rng(1729)
        half = max(1, (dim + 1) // 2)
        size = int(np.ceil(LIST * max(1.0, np.log10(max(vectors, 1)) - 3)))
        width = max(1, int(np.ceil(np.sqrt(size * vectors / CROWD))))
        unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
        rotation = np.linalg.qr(rng.standard_normal((2 * half, 2 * half)))[0]
        first, second = (unit(rng.standard_normal((width, half))) for _ in range(2))
        probe = unit(rng.standard_normal((PROBES, 2 * half)))
        cuts = []
        for a, b in zip(probe[:, :half] @ first.T, probe[:, half:] @ second.T, strict=True):
            b = np.sort(b)
            low, high = -2.0, 2.0
            for _ in range(30):
                middle = (low + high) / 2
                above = (len(b) - np.searchsorted(b, middle - a)).sum()
                low, high = (middle, high) if above > size else (low, middle)
            cuts.append(low)
        return ProductCode(rotation, first, second, float(np.mean(cuts)), size)

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Sorted numbers of all directions that each unit vector exceeds.

        A vector that exceeds fewer than `least` gets its best ones, so many.
        """
        half = self.first.shape[1]
        wide = np.zeros((len(unit), 2 * half))
        wide[:, : unit.shape[1]] = unit
        turned = wide @ self.rotation
        out = []
        for a, b in zip(turned[:, :half] @ self.first.T, turned[:, half:] @ self.second.T, strict=True):
            best = (np.sort(a)[-self.least :, None] + np.sort(b)[None, -self.least :]).ravel()
            nth = min(self.least, len(best))
            cut = min(self.threshold, np.partition(best, -nth)[-nth])
            i, j = np.flatnonzero(a >= cut - b.max()), np.flatnonzero(b >= cut - a.max())
            x, y = np.nonzero(a[i][:, None] + b[j][None, :] >= cut)
            out.append(np.sort(i[x] * len(self.second) + j[y]))
        return out


def _decoded(vectors: DataFrame, code: ProductCode, dim: int) -> DataFrame:
    """`uid, rep, many, label, vec (binary), lists` for distinct vectors."""
    shared = vectors.sparkSession.sparkContext.broadcast(code)
    single = dict(vectors.dtypes)["embedding"] == "array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                column = part.column("embedding").cast(pa.large_list(pa.float64()))
                sizes = np.diff(column.offsets.to_numpy())
                whole = np.zeros((part.num_rows, dim))
                whole[np.arange(dim)[None, :] < sizes[:, None]] = column.flatten().to_numpy()
                kept = whole.astype(np.float32 if single else np.float64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("uid"),
                        part.column("rep"),
                        part.column("many"),
                        part.column("label"),
                        pa.array([v.tobytes() for v in kept], pa.binary()),
                        pa.array(shared.value.decode(_unit(whole)), pa.list_(pa.int64())),
                    ],
                    ["uid", "rep", "many", "label", "vec", "lists"],
                )

    kind = dict(vectors.dtypes)["label"]
    return vectors.mapInArrow(run, f"uid long, rep long, many long, label {kind}, vec binary, lists array<long>")


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors.astype(np.float64) / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _links(group: pa.RecordBatch, threshold: float, single: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, links each gets here, root of each in this group's link graph).

    A pair that shares several directions counts under the smallest of them only.
    """
    node, many = group.column("rep").to_numpy(), group.column("many").to_numpy()
    own = group.column("_own").to_numpy()
    n, here = len(node), int(group.column("direction")[0].as_py())
    kind = np.float32 if single else np.float64
    unit = _unit(np.frombuffer(b"".join(group.column("vec").to_pylist()), kind).reshape(n, -1))
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    if (own != own[0]).any():
        near &= own[:, None] != own[None, :]
    root = np.arange(n)
    counts = np.zeros(n, np.int64)
    linked = np.flatnonzero(near.any(1))
    if not len(linked):
        return node, counts, node
    free = np.ones(n, bool)
    for i in linked:
        if free[i]:
            free[i] = False
            front = near[i] & free
            while front.any():
                free[front] = False
                root[front] = i
                front = near[front].any(0) & free
    lists = group.column("lists")
    flat, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(n), sizes)
    lower = flat < here
    shown, column = np.unique(flat[lower], return_inverse=True)
    counted = near
    if len(shown):
        has = np.zeros((n, len(shown)), np.float32)
        has[row[lower], column] = 1
        counted = near & (has @ has.T == 0)
    return node, counted @ many, node[root]


def vector_links(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """`vec_id, n_links, component_id, kept` for every row of `vectors` (vec_id, label, embedding).

    Rows link if their labels are equal and not null and the cosine of their vectors, in double
    precision, is at least `threshold`. Vectors that are null, zero, or hold null or non-finite
    components link with nothing, nor do rows without a vec_id (their component is null, and they
    are not kept). A shorter vector counts as filled up with zeros. Equal vectors are compared once
    and are each other's links. Where a vec_id repeats, each of its rows gets its own vector's result. Extra
    columns are ignored, an empty table gives an empty table.
    """
    rows = vectors.select("vec_id", "label", "embedding")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", finite)
        & F.exists("embedding", lambda x: x != 0)
    )
    groups = staged(
        rows.filter(sound)
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").cast("long").alias("rep"), F.count("*").alias("many"))
        .withColumn("uid", F.monotonically_increasing_id())
    )
    shape = groups.groupBy("label").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d"))
    most, dim = shape.agg(F.max("n"), F.max("d")).first()
    code = ProductCode.fitted(dim or 1, most or 1)
    decoded = staged(_decoded(groups, code, dim or 1))
    slim = decoded.select("uid", "label", F.explode("lists").alias("direction")).withColumn(
        "bucket", F.xxhash64("label", "direction")
    )
    met = blocked_members(sized(slim, "bucket", "uid"), "bucket", "uid", BLOCK, alone=True)
    grouped = dealt(met.drop("label").join(decoded, "uid"), "bucket", "uid")

    single = dict(rows.dtypes)["embedding"] == "array<float>"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, ...]] = []

        def work(group: pa.RecordBatch) -> None:
            # A bucket is a hash of label and direction: members of another pair of them are set apart.
            labels = group.column("label").to_numpy(zero_copy_only=False)
            places = group.column("direction").to_numpy()
            if (labels == labels[0]).all() and (places == places[0]).all():
                parts = [group]
            else:
                kinds = {*zip(labels.tolist(), places.tolist(), strict=True)}
                parts = [group.filter(pa.array((labels == x) & (places == y))) for x, y in kinds]
            for part in parts:
                node, counts, root = _links(part, threshold, single)
                some = (counts > 0) | (root != node)
                if some.any():
                    out.append((part.column("uid").to_numpy()[some], node[some], counts[some], root[some]))

        for _ in run_groups(batches, ["bucket", "_bi", "_bj"], work):
            if out:
                columns = [np.concatenate(x) for x in zip(*out, strict=True)]
                out.clear()
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["uid", "rep", "links", "root"])

    found = staged(grouped.mapInArrow(find, "uid long, rep long, links long, root long"))
    counts = found.groupBy("uid").agg(F.sum("links").alias("links"))
    joined = connected_components(found.select("rep", "root").distinct(), "rep", "root")
    each = (
        groups.join(counts, "uid", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label",
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", F.col("vec_id").cast("long")))
    return (
        rows.withColumn("label", F.when(sound, F.col("label")))
        .join(each, ["label", "embedding"], "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
