"""Insert-if-absent into a huge table: Bloom filters beside key ranges say where old rows need not be read.

The table lies in folders by range of the key's hash, and beside each range lies a blocked Bloom filter:
64-bit words, in each of which a key sets four bits of one word. A key whose bits are not all there is
surely new. Only for the others the ranges that they fall into are read and joined exactly. New rows
are appended; nothing old is written again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coinloom.operators.scratch import bucketed, staged

ROWS_PER_RANGE = 1_000_000
KEYS_PER_WORD = 4


def _placed(keys: list[str], ranges: int, words: int) -> list[Column]:
    """Range, word and bits of a key."""
    where, bits = F.xxhash64(*keys), F.xxhash64(F.lit("bits"), *keys)
    four = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.call_function("shiftrightunsigned", bits, F.lit(6 * k)).bitwiseAND(F.lit(63)).cast("int")) for k in range(4)]
    mask = four[0].bitwiseOR(four[1]).bitwiseOR(four[2]).bitwiseOR(four[3])
    return [
        F.pmod(where, F.lit(ranges)).cast("int").alias("range"),
        F.pmod(F.xxhash64(F.lit("word"), *keys), F.lit(words)).cast("int").alias("word"),
        mask.alias("mask"),
    ]


@dataclass(frozen=True)
class RangedTable:
    """A table of one row per key under `root`; `ranges` and `words` (of each range's filter) never change."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    layout: str
    ranges: int
    words: int

    @classmethod
    def create(
        cls, rows: DataFrame, root: str, keys: list[str], expected: int | None = None, rows_per_range: int = ROWS_PER_RANGE
    ) -> RangedTable:
        """Write `rows`, whose keys are unique, laid out for `expected` rows or for as many as there are."""
        size = max(expected or rows.count(), 1)
        ranges = -(-size // rows_per_range)
        words = max(1, -(-size // ranges) // KEYS_PER_WORD)
        layout = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
        table = cls(rows.sparkSession, root, tuple(keys), layout, ranges, words)
        table._append(rows)
        return table

    def _place(self, rows: DataFrame) -> DataFrame:
        return rows.select("*", *_placed(list(self.keys), self.ranges, self.words))

    def _append(self, rows: DataFrame) -> None:
        """Filters first: if the rows then do not come, a filter says too much, never too little."""
        placed = self._place(rows)
        filters = placed.groupBy("range", "word").agg(F.bit_or("mask").alias("mask"))
        filters.repartition("range").sortWithinPartitions("range", "word").write.mode("append").option("compression", "zstd").partitionBy("range").parquet(f"{self.root}/filters")
        kept = placed.drop("word", "mask").repartition("range").sortWithinPartitions("range", *self.keys)
        kept.write.mode("append").option("compression", "zstd").partitionBy("range").parquet(f"{self.root}/rows")

    def rows(self) -> DataFrame:
        return self.spark.read.schema(f"{self.layout}, range int").parquet(f"{self.root}/rows")

    def read(self) -> DataFrame:
        return self.rows().drop("range")

    def possible(self, placed: DataFrame) -> DataFrame:
        """Those of `placed` whose key the filters do not rule out."""
        filters = self.spark.read.schema("word int, mask bigint, range int").parquet(f"{self.root}/filters")
        whole = filters.groupBy("range", "word").agg(F.bit_or("mask").alias("_held"))
        return placed.join(whole, ["range", "word"]).filter(F.col("mask").bitwiseAND(F.col("_held")) == F.col("mask")).drop("_held")

    def insert(self, new: DataFrame) -> tuple[DataFrame, list[int]]:
        """Append the rows of `new` whose key is not there, one a key; gives them and the ranges that were read.

        Of rows with one key any counts. If an insert breaks off it may be done again. New rows are dealt by key
        once; ranges, words and bits are made of the keys where they are needed.
        """
        keys = list(self.keys)
        once = bucketed(new.dropDuplicates(keys), *keys)
        # One number a range at most.
        maybe = self.possible(self._place(once.select(*keys)).select("range", "word", "mask"))
        read = sorted(r["range"] for r in maybe.select("range").distinct().collect())
        there = self.rows().filter(F.col("range").isin(read)).select(*keys)
        fresh = staged(once.join(there, keys, "left_anti")) if read else once
        self._append(fresh)
        return fresh, read
