"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coinloom.llm.kernels import pieces as slices


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and hand it to `body`, inside one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_starts(lengths: Column) -> Column:
    """Exclusive running sum of an array of ints, in about n to the power 1.5 steps.

    Sums of blocks of about sqrt(n) elements come first, so that no element adds up more than
    one block and the block sums before it.
    """

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def by_block(values: Column) -> Column:
        n = F.size(values)
        step = F.ceil(F.sqrt(n.cast("double"))).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), ((n - 1) / step).cast("int")),
            lambda j: total(F.slice(values, j * step + 1, step)),
        )
        return let(
            blocks,
            lambda b: let(
                F.transform(b, lambda _, j: total(F.slice(b, F.lit(1), j))),
                lambda before: F.transform(
                    values,
                    lambda _, i: F.element_at(before, (i / step).cast("int") + 1)
                    + total(F.slice(values, (i / step).cast("int") * step + 1, F.pmod(i, step))),
                ),
            ),
        )

    return let(lengths, lambda v: F.when(F.size(v) > 0, by_block(v)).otherwise(F.array().cast("array<int>")))


def filter_rows(
    rows: DataFrame, column: str, keep: Callable[[pa.Array], np.ndarray], most_bytes: int = 1_000_000
) -> DataFrame:
    """Rows of `rows` for which `keep`, given a stretch of the text column, says True; all columns stay as they are.

    Columns are passed by place, so any names will do, even repeated ones or names with dots.
    """
    at = rows.columns.index(column)
    placed = rows.toDF(*(f"c{i}" for i in range(len(rows.columns))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, f"c{at}", 4096, most_bytes):
                yield part.filter(pa.array(keep(part.column(at)), pa.bool_()))

    return placed.mapInArrow(run, placed.schema).toDF(*rows.columns)
