"""Joining the members of a bucket without sending a whole bucket to one task or all its pairs to anyone."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sized(rows: DataFrame, bucket: str, ident: str, size: str | None = None, salts: int = 16) -> DataFrame:
    """Rows of buckets with two members or more, `_n`, how many the bucket has, and with `size` its sum as `_size`.

    Members are counted in `salts` parts of each bucket and joined to the total by part, so that no
    task reads more than a share of a hot bucket.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(ident), F.lit(salts)))
    sums = [F.count("*").alias("_n")] + ([F.sum(size).alias("_size")] if size else [])
    parts = salted.groupBy(bucket, "_salt").agg(*sums)
    whole = [F.sum("_n").alias("_n")] + ([F.sum("_size").alias("_size")] if size else [])
    known = parts.select(bucket, "_salt").join(parts.groupBy(bucket).agg(*whole).filter("_n > 1"), bucket)
    return salted.join(known, [bucket, "_salt"]).drop("_salt")


def blocked_members(
    rows: DataFrame, bucket: str, ident: str, block: int = 4096, alone: bool = False, most: int | None = None
) -> DataFrame:
    """Rows of `sized`, dealt out so that any two members of a bucket meet in one group.

    A bucket of more than `block` members, or of a `_size` above `most`, is split by a hash of `ident`
    into blocks, and every two blocks meet in a group of their own (`_bi`, `_bj`): no group holds more
    than about 2 * block rows, and no member is left out. With `alone`, each block has a group to
    itself too, and `_own` tells a member's block, so that pairs can be counted once: those of one
    block where it is alone, those across blocks where the two meet. `dealt` gives the result its
    place in the cluster.
    """
    share = F.col("_n") / block
    blocks = F.ceil(share if most is None else F.greatest(share, F.col("_size") / most)).cast("int")
    spread = rows.withColumn("_blocks", blocks)
    own = F.pmod(F.xxhash64(ident), F.col("_blocks")).cast("int")
    meet = F.when(
        F.col("_blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    ).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda j: F.lit(alone) | (j != own)),
            lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")),
        )
    )
    kept = [c for c in rows.columns if c not in ("_n", "_size")]
    return spread.withColumn("_meet", F.explode(meet)).select(
        *kept, F.col("_meet.i").alias("_bi"), F.col("_meet.j").alias("_bj"), own.alias("_own")
    )


def dealt(members: DataFrame, bucket: str, ident: str) -> DataFrame:
    """Groups of `blocked_members` side by side, in order: what `run_groups` reads."""
    keys = [bucket, "_bi", "_bj"]
    return members.repartition(*keys).sortWithinPartitions(*keys, ident)


def run_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], work: Callable[[pa.RecordBatch], None]
) -> Iterator[None]:
    """Call `work` once for each run of equal keys in a sorted stream; yields after each batch.

    Only the last, possibly unfinished run of a batch is carried on.
    """
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest:
            batch = pa.Table.from_batches([*rest, batch]).combine_chunks().to_batches()[0]
        new = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= v[1:] != v[:-1]
        edges = np.flatnonzero(new)
        at = 0
        for stop in edges:
            work(batch.slice(at, stop - at))
            at = stop
        rest = [batch.slice(at)]
        yield
    for last in rest:
        work(last)
    yield
