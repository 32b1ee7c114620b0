"""Contiguous, byte-balanced shards from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinloom.operators.scratch import staged


def assign_shards(rows: DataFrame, weight: Column, order: list[str], shards: int) -> DataFrame:
    """Cut all rows, in the order of the columns `order`, into `shards` runs of near equal weight.

    Returns every column of `rows` plus `shard` (0-based) and `slot` (gapless from 0 in a shard).
    A row belongs to the shard that holds the middle of its own stretch of the global prefix sum,
    so a boundary is off by half a row at most; the shards are contiguous in the order.

    The rows are range-partitioned once (a row number breaks ties, so equal rows spread too) and
    written to the shared scratch folder; sums of each partition, a prefix over those few sums, and
    a running sum inside each partition then give the global position without a global sort in one
    task. The weight must be positive; null order values come first; repeated rows are separate
    rows; an empty table gives an empty table. Columns are passed by place, so any names will do.
    """
    columns = [f"c{i}" for i in range(len(rows.columns))]
    keyed = rows.select("*", weight.cast("long")).toDF(*columns, "_weight").withColumn("_row", F.monotonically_increasing_id())
    keys = [*(columns[rows.columns.index(k)] for k in order), "_row"]
    ranged = (
        keyed.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
        .drop("_row")
    )
    fixed = staged(ranged)
    # One row for each partition: a table of a few rows, whatever the size of the input.
    parts = fixed.groupBy("_part").agg(F.sum("_weight").alias("_w"), F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_part",
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_w0"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.sum("_w").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy("_at")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        fixed.select(
            "*", F.sum("_weight").over(running).alias("_end"), F.row_number().over(inside).alias("_nth")
        )
        .join(offsets, "_part")
        .withColumn("_twice_mid", 2 * (F.col("_w0") + F.col("_end")) - F.col("_weight"))
        .withColumn("shard", F.expr(f"cast(least({shards - 1}, (_twice_mid * {shards}) div (2 * _total)) as int)"))
        .withColumn("_rank", F.col("_n0") + F.col("_nth") - 1)
    )
    firsts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return (
        placed.join(F.broadcast(firsts), "shard")  # one row for each shard
        .withColumn("slot", F.col("_rank") - F.col("_first"))
        .select(*columns, "shard", "slot")
        .toDF(*rows.columns, "shard", "slot")
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """`doc_id, size, text_crc32, law, shard, slot, grown_shard` for every row of `docs`.

    The size is the text's UTF-8 bytes plus 1; a null text counts no byte and has the checksum of
    an empty one. Documents are laid out by `doc_id` (nulls first), then checksum and size; equal
    rows are interchangeable. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return assign_shards(slim, F.col("size"), ["doc_id", "text_crc32", "size"], shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
