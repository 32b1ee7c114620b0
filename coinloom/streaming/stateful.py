"""Balances kept up to date by a stream with state: each micro-batch reads its own rows and nothing older.

The stream's state is keyed by coin: it keeps the first output and the first spend of a coin, each with
the micro-batch that brought it, so that each output and each spend is sent on exactly once, however
often and in whichever order blocks come; a spend that comes before its output waits for it. It is an
aggregate of built-in functions, kept in RocksDB: no row and no call to the state goes through Python.
What is sent on, the moves, is added up by address and transaction in a store of runs (`levels`), so
that an address's transactions are counted once; balances are read from there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from coinloom.functions.scalars import packed, type_rank, unpacked
from coinloom.sources.schemas import TYPE_ORDER
from coinloom.streaming.levels import Rule, Store

# Ids are `packed`.
COIN_EVENTS = "txid binary, idx int, kind string, address string, address_type string, amount bigint, other binary, height int, at bigint"
MOVES = T.StructType(
    [
        T.StructField("address", T.StringType()), T.StructField("txid", T.BinaryType()), T.StructField("address_type", T.StringType()),
        T.StructField("height", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("at", "sats", "coins")),
    ]
)
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: The number of the micro-batch among a task's local properties.
_BATCH_ID = "streaming.sql.batchId"


def coin_events(outs: DataFrame, spends: DataFrame) -> DataFrame:
    """What happens to coins in some blocks: `outs` (with height and received_time) and `spends`."""
    none = F.lit(None).cast("binary")
    made = outs.select(
        packed(F.col("txid")).alias("txid"), "idx", F.lit("out").alias("kind"), "address", "address_type", "amount", none.alias("other"), "height",
        F.unix_micros("received_time").alias("at"),
    )
    used = spends.select(
        packed(F.col("prev_txid")).alias("txid"), F.col("prev_vout").alias("idx"), F.lit("spend").alias("kind"), F.lit(None).cast("string").alias("address"),
        F.lit(None).cast("string").alias("address_type"), F.lit(None).cast("bigint").alias("amount"), packed(F.col("spending_txid")).alias("other"),
        F.col("spent_height").alias("height"), F.unix_micros("spent_time").alias("at"),
    )
    return made.unionByName(used)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number `n` of their micro-batch, which stays if the micro-batch is done again."""
    n = int(TaskContext.get().getLocalProperty(_BATCH_ID))
    for batch in batches:
        yield batch.append_column("n", pa.array([n] * batch.num_rows, pa.int64()))


def _coins(events: DataFrame) -> DataFrame:
    """`txid, idx, out, spend, n`: the first output and spend of each coin, and the last micro-batch that had rows of it.

    Of the rows of one micro-batch the least counts.
    """
    made, used = F.struct("n", "height", "at", "address", "address_type", "amount"), F.struct("n", "height", "other", "at")
    return events.groupBy("txid", "idx").agg(
        F.min(F.when(F.col("kind") == "out", made)).alias("out"), F.min(F.when(F.col("kind") == "spend", used)).alias("spend"), F.max("n").alias("n")
    )


def _moves(coins: DataFrame) -> DataFrame:
    """What the micro-batch n of the coins that it changed sends on: outputs that are new, spends once they and their outputs are there."""
    made = F.struct(
        "out.address", "txid", "out.address_type", "out.height", "out.at", F.col("out.amount").alias("sats"), F.lit(1).cast("bigint").alias("coins")
    )
    used = F.struct(
        "out.address", F.col("spend.other").alias("txid"), "out.address_type", "spend.height", "spend.at", (-F.col("out.amount")).alias("sats"),
        F.lit(-1).cast("bigint").alias("coins"),
    )
    news = F.array(
        F.when(F.col("out.n") == F.col("n"), made),
        F.when(F.col("out").isNotNull() & F.col("spend").isNotNull() & (F.greatest("out.n", "spend.n") == F.col("n")), used),
    )
    return coins.select(F.explode(news).alias("m")).filter("m is not null").select("m.*")


def _sums(spark: SparkSession, state: str) -> Store:
    """Moves added up by address and transaction."""
    parts = {
        "kind": (type_rank(F.col("address_type")), False), "coins": (F.col("coins"), None),
        "received": (F.greatest(F.col("sats"), F.lit(0)), None), "spent": (F.greatest(-F.col("sats"), F.lit(0)), None),
        "first": (F.col("at"), True), "last": (F.col("at"), False), "height": (F.col("height"), False),
    }
    return Store(spark, f"{state}/sums", {"moves": Rule(MOVES, ["address", "txid"], parts, [])})


def follow_balances(spark: SparkSession, events: str, state: str, files_per_batch: int = 64) -> StreamingQuery:
    """Take the event files (COIN_EVENTS) under `events` that are new since the last call, then stop.

    `state` keeps the progress, the state and the sums; a micro-batch's moves are a run of their own, the same
    again if it comes again. Runs of earlier calls are merged first, so no reader may still be at them.
    """
    sums = _sums(spark, state)
    sums.compact()
    sums.vacuum()
    news = spark.readStream.schema(COIN_EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(f"{events}/batch=*")
    coins = _coins(news.mapInArrow(_numbered, f"{COIN_EVENTS}, n bigint"))

    def add(rows: DataFrame, n: int) -> None:
        _sums(rows.sparkSession, state).add(n, {"moves": _moves(rows)})

    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        return (
            coins.writeStream.outputMode("update").foreachBatch(add)
            .option("checkpointLocation", f"{state}/progress")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(_STORE, before)


def balances_now(spark: SparkSession, state: str) -> DataFrame:
    """Every address's balance, counts, times and sums as of the last micro-batch."""
    add = lambda c, name: F.sum(c).alias(name)
    return _sums(spark, state).merged("moves").groupBy("address").agg(
        F.element_at(F.array(*map(F.lit, TYPE_ORDER)), F.max("kind").cast("int")).alias("address_type"),
        (F.sum("received") - F.sum("spent")).alias("balance_sats"), add("coins", "utxo_count"),
        F.count("*").alias("tx_count"), add("received", "total_received_sats"), add("spent", "total_spent_sats"),
        F.timestamp_micros(F.min("first")).alias("first_seen"), F.timestamp_micros(F.max("last")).alias("last_seen"),
        F.max("height").alias("last_height"),
    )


def spends_waiting(spark: SparkSession, state: str) -> DataFrame:
    """`prev_txid, prev_vout, spending_txid, spent_height`: spends whose output no block has brought yet, of a coin's the first."""
    kept = spark.read.format("statestore").load(f"{state}/progress")
    # The state names its values by function: they are told apart by place.
    out = "struct<n:bigint,height:int,at:bigint,address:string,address_type:string,amount:bigint>"
    values = kept.select("key", F.col("value").cast(f"struct<out:{out},spend:struct<n:bigint,height:int,other:binary,at:bigint>,n:bigint>").alias("c"))
    return values.filter("c.out is null").select(
        unpacked(F.col("key.txid")).alias("prev_txid"), F.col("key.idx").alias("prev_vout"),
        unpacked(F.col("c.spend.other")).alias("spending_txid"), F.col("c.spend.height").alias("spent_height"),
    )
