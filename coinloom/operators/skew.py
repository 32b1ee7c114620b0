"""Joins in which one key may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a key, per side, that one task is meant to join.
BLOCK = 20_000


def dealt(
    left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, block: int = BLOCK, parts: int = 64
) -> tuple[DataFrame, DataFrame]:
    """Both sides with two more key columns, `_i` and `_j`, for an inner join on `keys`, `_i` and `_j`.

    A key with more than `block` rows on a side is dealt into blocks of about `block` rows by a hash of
    the id, and each row meets the blocks of the other side: the join has the same pairs, each once, but
    no task reads a key whole. Rows of other keys pass once. The sizes are counted over all rows, and
    those of large keys are joined back in `parts` parts. Rows with a null key are kept as they are.
    """
    count = lambda df, n: df.groupBy(*keys).agg(F.ceil(F.count("*") / block).alias(n))
    sizes = count(left, "_m").join(count(right, "_n"), keys, "full").fillna(1, ["_m", "_n"]).filter("_m > 1 or _n > 1")
    large = sizes.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def side(df: DataFrame, ident: str, own: str, other: str, at: str, meets: str) -> DataFrame:
        blocks: Column = F.coalesce(own, F.lit(1))
        sized = df.withColumn("_part", F.pmod(F.xxhash64(ident), F.lit(parts)).cast("int")).join(large, [*keys, "_part"], "left")
        placed = sized.withColumn(at, F.pmod(F.xxhash64(F.lit(1), ident), blocks).cast("int"))
        return placed.withColumn(meets, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)).cast("int") - 1))).drop("_part", "_m", "_n")

    return side(left, left_id, "_m", "_n", "_i", "_j"), side(right, right_id, "_n", "_m", "_j", "_i")
