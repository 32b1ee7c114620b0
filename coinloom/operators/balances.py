"""Address balances: of all addresses, of a watch list, and by steps of blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinloom.functions.scalars import type_rank

COIN = ["txid", "idx"]

#: Heights whose steps of one address are summed in one task.
STRETCH = 1_024


def coins(io: DataFrame, spends: DataFrame) -> DataFrame:
    """Outputs with `spending_txid`, `spent_height` of the edge that spends them, null while unspent."""
    edge = spends.select(
        F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("idx"), "spending_txid", "spent_height"
    )
    return io.filter("io_type = 'out'").join(edge, COIN, "left")


def unspent(io: DataFrame, spends: DataFrame) -> DataFrame:
    return coins(io, spends).filter("spending_txid is null").drop("spending_txid", "spent_height")


def build_balances(io: DataFrame, spends: DataFrame) -> DataFrame:
    """Balance of every address: one join, one aggregate. The type is the latest in declaration order."""
    free = F.col("spending_txid").isNull()
    return (
        coins(io, spends)
        .filter("address is not null")
        .groupBy("address")
        .agg(
            F.max_by("address_type", type_rank(F.col("address_type"))).alias("address_type"),
            F.coalesce(F.sum(F.when(free, F.col("amount"))), F.lit(0)).alias("balance_sats"),
            F.count_if(free).alias("utxo_count"),
            F.coalesce(F.sum("amount"), F.lit(0)).alias("total_received_sats"),
            F.coalesce(F.sum(F.when(~free, F.col("amount"))), F.lit(0)).alias("total_spent_sats"),
        )
    )


def balance_summary(balances: DataFrame) -> DataFrame:
    return balances.agg(
        F.count("*").alias("addresses"),
        F.count_if(F.col("balance_sats") > 0).alias("funded"),
        F.coalesce(F.sum("balance_sats"), F.lit(0)).alias("total_sats"),
    )


def recompute_watch(watch: DataFrame, io: DataFrame, spends: DataFrame, tx: DataFrame) -> DataFrame:
    """Exact state of the watched addresses. Those without any output stay as they are."""
    own = coins(io.join(watch.select("address"), "address", "left_semi"), spends)
    free = F.col("spending_txid").isNull()
    sums = own.groupBy("address").agg(
        F.coalesce(F.sum(F.when(free, F.col("amount"))), F.lit(0)).alias("b"), F.count_if(free).alias("u")
    )
    events = (
        own.select("address", F.explode(F.array("txid", "spending_txid")).alias("t")).filter("t is not null").distinct()
    )
    times = (
        events.join(tx.select(F.col("txid").alias("t"), "received_time"), "t", "left")
        .groupBy("address")
        .agg(F.count("*").alias("n"), F.min("received_time").alias("lo"), F.max("received_time").alias("hi"))
    )
    state = sums.join(times, "address")
    new = {"balance_sats": "b", "utxo_count": "u", "tx_count": "n", "first_seen": "lo", "last_seen": "hi"}
    joined = watch.join(state, "address", "left")
    for column, fresh in new.items():
        joined = joined.withColumn(column, F.coalesce(fresh, column))
    return joined.select(watch.columns)


def block_deltas(
    watch: DataFrame, io: DataFrame, spends: DataFrame, tx: DataFrame, new: Callable[[DataFrame], DataFrame] | None = None,
    ident: Callable[[str], Column] = F.col,
) -> DataFrame:
    """`height, address, delta_sats, delta_utxos, delta_txs, rep_txid`: what each block changes.

    Credits and debits are one list of events, so nothing is collected for a busy address. `new` may
    pick the events that count: it adds a column of that name to events (height, made, address, ...),
    where `made` is the height that the coin comes from. A transaction counts for an address unless
    another of its events there is old. `ident` makes ids of the column `txid` where the tables hold keys.
    """
    watched = watch.select("address")
    outs = (
        io.filter("io_type = 'out'").join(watched, "address", "left_semi").select("txid", "idx", "address", "amount")
        .join(tx.select("txid", F.col("height").alias("made")), "txid", "left")
    )
    credit = outs.filter("made is not null").select(
        F.col("made").alias("height"), "made", "address", "txid", F.col("amount").alias("sats"), F.lit(1).alias("coin")
    )
    debit = outs.join(
        spends.select(F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("idx"), "spending_txid", "spent_height"), COIN
    ).select(
        F.col("spent_height").alias("height"), "made", "address", F.col("spending_txid").alias("txid"),
        (-F.col("amount")).alias("sats"), F.lit(-1).alias("coin"),
    )
    events = credit.unionByName(debit)
    events = events.withColumn("new", F.lit(True)) if new is None else new(events)
    each = (
        events.groupBy("height", "address", "txid")
        .agg(
            F.sum(F.when(F.col("new"), F.col("sats"))).alias("sats"),
            F.sum(F.when(F.col("new"), F.col("coin"))).alias("coin"),
            F.bool_and("new").alias("first"),
            F.bool_or("new").alias("new"),
        )
        .filter("new")
    )
    return each.groupBy("height", "address").agg(
        F.sum("sats").alias("delta_sats"),
        F.sum("coin").alias("delta_utxos"),
        F.count_if("first").alias("delta_txs"),
        F.min(ident("txid")).alias("rep_txid"),
    )


def apply_deltas(watch: DataFrame, deltas: DataFrame, blocks: DataFrame, ready: DataFrame | None = None, stretch: int = STRETCH) -> DataFrame:
    """Watched addresses after all blocks in `deltas`, in order of height, as if one by one.

    A balance never falls below 0: with S the running sum from the start, the clamped value is
    S - min(0, the least S so far). `ready` (height) limits the blocks. Sums run inside stretches of
    `stretch` heights, then over an address's stretches, so a hot address is no single sort.
    """
    steps = deltas if ready is None else deltas.join(ready.select("height"), "height", "left_semi")
    steps = steps.join(blocks.select("height", "block_time"), "height").join(watch.select("address"), "address", "left_semi")
    inside = Window.partitionBy("address", "_stretch").orderBy("height").rowsBetween(Window.unboundedPreceding, 0)
    running = steps.withColumn("_stretch", F.floor(F.col("height") / stretch)).select(
        "*", F.sum("delta_sats").over(inside).alias("b"), F.sum("delta_utxos").over(inside).alias("u")
    )
    stretches = running.groupBy("address", "_stretch").agg(
        F.sum("delta_sats").alias("d"),
        F.min("b").alias("b"),
        F.sum("delta_utxos").alias("e"),
        F.min("u").alias("u"),
        F.sum("delta_txs").alias("n"),
        F.min("block_time").alias("lo"),
        F.max("block_time").alias("hi"),
        F.max("height").cast("int").alias("h"),
        F.max_by("rep_txid", "height").alias("rep"),
    )
    before = Window.partitionBy("address").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.withColumns({
        "b": F.col("b") + F.coalesce(F.sum("d").over(before), F.lit(0)),
        "u": F.col("u") + F.coalesce(F.sum("e").over(before), F.lit(0)),
    })
    final = carried.groupBy("address").agg(
        F.sum("d").alias("_d"),
        F.min("b").alias("_least_b"),
        F.sum("e").alias("_e"),
        F.min("u").alias("_least_u"),
        F.sum("n").alias("_n"),
        F.min("lo").alias("_lo"),
        F.max("hi").alias("_hi"),
        F.max("h").alias("_h"),
        F.max_by("rep", "h").alias("_rep"),
    )
    out = watch.join(final, "address", "left")
    clamped = lambda c, d, least: F.col(c) + F.col(d) - F.least(F.lit(0), F.col(c) + F.col(least))
    rules = {
        "balance_sats": F.coalesce(clamped("balance_sats", "_d", "_least_b"), "balance_sats"),
        "utxo_count": F.coalesce(clamped("utxo_count", "_e", "_least_u"), "utxo_count"),
        "tx_count": F.coalesce(F.col("tx_count") + F.col("_n"), "tx_count"),
        "first_seen": F.least("first_seen", "_lo"),
        "last_seen": F.greatest("last_seen", "_hi"),
        "last_scanned_height": F.greatest("last_scanned_height", "_h"),
        "last_scanned_time": F.greatest("last_scanned_time", "_hi"),
        "last_scanned_txid": F.coalesce("_rep", "last_scanned_txid"),
    }
    for column, rule in rules.items():
        out = out.withColumn(column, rule)
    return out.select(watch.columns)


def address_totals(io: DataFrame) -> DataFrame:
    """Received (outputs) and sent (inputs) of every address."""
    return io.filter("address is not null").groupBy("address").agg(
        F.coalesce(F.sum(F.expr("if(io_type = 'out', amount, null)")), F.lit(0)).alias("received_sats"),
        F.coalesce(F.sum(F.expr("if(io_type = 'in', amount, null)")), F.lit(0)).alias("sent_sats"),
    )


def output_counts(io: DataFrame) -> DataFrame:
    """All outputs of every address, spent or not: the measure of a hub."""
    return io.filter("io_type = 'out' and address is not null").groupBy("address").agg(F.count("*").alias("n_outputs"))


def activity_ledger(io: DataFrame, tx: DataFrame) -> DataFrame:
    """One row per transaction, address and direction."""
    return (
        io.join(tx.select("txid", "block_hash", "received_time"), "txid")
        .groupBy("txid", "address", "io_type", "block_hash", "received_time")
        .agg(F.sum("amount").alias("amount"))
    )
