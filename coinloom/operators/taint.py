"""Taint to the end of all walks, each coin settled once, in topological layers of the spend graph.

A transaction is worked out when all of its inputs that anything tainted leads to are settled, so the
layers are those of the longest path. Each layer joins only what has just been settled to the part of
the graph that can be reached, and is written once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinloom.operators.forensics import poison, same_coins
from coinloom.operators.scratch import bucketed, staged

COIN = ["txid", "idx"]


def by_layers(
    start: DataFrame, io: DataFrame, spends: DataFrame, first: Callable[[DataFrame], DataFrame],
    step: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    """Rows (txid, idx, ..., layer) of all coins that `start` (txid, idx) leads to.

    `first` gives the rows of start coins. `step` takes the settled rows of all tainted inputs of some
    transactions, as `txid, vin, ...`, and those of the start coins, and gives the rows of all their
    outputs. A start coin of a transaction that is itself reached is settled with that transaction.
    """
    start = bucketed(start.select(*COIN).distinct(), "txid")
    reached = poison(start, io, spends).select(*COIN)
    edge = spends.select(F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("idx"), F.col("spending_txid").alias("next"), F.col("spending_vin").alias("vin"))
    # Read in every layer, so each lies by what it is joined on there.
    used = bucketed(reached.join(edge, COIN), *COIN)
    need = bucketed(used.groupBy(F.col("next").alias("txid")).agg(F.count("*").alias("_need")), "txid")
    own = bucketed(first(start), "txid")
    settled = own.join(need, "txid", "left_anti")
    whole, waiting, layer = settled.withColumn("layer", F.lit(0)), None, 0
    while True:
        new = settled.join(used, COIN).drop(*COIN).withColumnRenamed("next", "txid")
        waiting = staged(new if waiting is None else waiting.unionByName(new))
        ready = waiting.groupBy("txid").agg(F.count_distinct("vin").alias("_have")).join(need, "txid").filter("_have = _need").select("txid")
        inputs = staged(waiting.join(ready, "txid", "left_semi"))
        if inputs.isEmpty():
            return whole
        layer += 1
        settled = staged(step(inputs, own))
        whole = whole.unionByName(settled.withColumn("layer", F.lit(layer)))
        waiting = waiting.join(inputs.select("txid").distinct(), "txid", "left_anti")


def haircut_totals(start: DataFrame, io: DataFrame, spends: DataFrame, tx: DataFrame) -> DataFrame:
    """`txid, idx, tainted_milli, layer`: the haircut taint of every coin that the start coins lead to.

    A start coin holds its amount, in thousandths of a satoshi, and what reaches it besides; an output
    gets its share of the taint of all inputs of its transaction, cut once. Null where the inputs'
    total is null or 0. Up to the cutting it is the sum of `forensics.haircut_taint` over all hops.
    """
    outs = io.filter("io_type = 'out'").select("txid", "idx", "amount")
    totals = tx.select("txid", F.nullif("total_in", F.lit(0)).alias("total_in"))
    share = F.expr("(cast(amount as decimal(16,0)) * cast(put as decimal(19,0))) div cast(total_in as decimal(19,0))")

    def first(start: DataFrame) -> DataFrame:
        return same_coins(outs, start, "inner").select(*COIN, (F.col("amount") * 1000).alias("tainted_milli"))

    def step(inputs: DataFrame, own: DataFrame) -> DataFrame:
        put = inputs.groupBy("txid").agg(F.sum("tainted_milli").alias("put"))
        base = own.withColumnRenamed("tainted_milli", "_base")
        rows = same_coins(put.join(totals, "txid").join(outs, "txid"), base, "left")
        return rows.select(*COIN, F.when(F.col("_base").isNull(), share).otherwise(F.col("_base") + F.coalesce(share, F.lit(0))).alias("tainted_milli"))

    return by_layers(start, io, spends, first, step)


def ordered_intervals(start: DataFrame, io: DataFrame, spends: DataFrame, last_first: bool = False) -> DataFrame:
    """`txid, idx, lo, hi, layer`: which stretches of each coin are tainted, first in first out over all transactions.

    Inputs are laid end to end by place, outputs as well, and a stretch goes where it lies; beyond the
    outputs it is lost as fee. With `last_first` the inputs are laid in reverse, each from its end, as a
    stack. Start coins are tainted whole. Stretches that touch are one. A coin that is reached without
    a tainted stretch has one row with lo = hi = 0. Stretches and outputs of one transaction meet each
    other, so that work is bounded by what a block may hold.
    """
    outs = io.filter("io_type = 'out'").select("txid", "idx", "amount")

    def laid(rows: DataFrame, order: Column) -> DataFrame:
        up_to = Window.partitionBy("txid").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("_end", F.sum("amount").over(up_to)).withColumn("_at", F.col("_end") - F.col("amount"))

    def first(start: DataFrame) -> DataFrame:
        return same_coins(outs, start, "inner").select(*COIN, F.lit(0).cast("bigint").alias("lo"), F.col("amount").alias("hi"))

    def step(inputs: DataFrame, own: DataFrame) -> DataFrame:
        these = inputs.select("txid").distinct()
        ins = io.filter("io_type = 'in'").join(these, "txid", "left_semi").select("txid", F.col("idx").alias("vin"), "amount")
        placed = laid(ins, F.desc("vin") if last_first else F.asc("vin"))
        a, b = ("amount - hi", "amount - lo") if last_first else ("lo", "hi")
        on_line = inputs.filter("hi > lo").join(placed, ["txid", "vin"]).selectExpr("txid", f"_at + {a} as lo", f"_at + {b} as hi")
        paid = laid(outs.join(these, "txid", "left_semi"), F.asc("idx"))
        meets = (F.col("s.txid") == F.col("p.txid")) & (F.col("s.lo") < F.col("p._end")) & (F.col("s.hi") > F.col("p._at"))
        # greatest and least pass over nulls: rows without a stretch are told by s.lo.
        cut = paid.alias("p").join(touching(on_line, ["txid"]).alias("s"), meets, "left").select(
            "p.txid", "p.idx",
            F.when(F.col("s.lo").isNull(), 0).otherwise(F.greatest(F.col("s.lo"), F.col("p._at")) - F.col("p._at")).cast("bigint").alias("lo"),
            F.when(F.col("s.lo").isNull(), 0).otherwise(F.least(F.col("s.hi"), F.col("p._end")) - F.col("p._at")).cast("bigint").alias("hi"),
        )
        whole = own.join(these, "txid", "left_semi")
        return same_coins(cut, whole.select(*COIN), "left_anti").unionByName(whole)

    return by_layers(start, io, spends, first, step)


def touching(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Stretches (keys, lo, hi) with those that touch or overlap made one."""
    order = Window.partitionBy(*keys).orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("lo") > before), 1).otherwise(0)
    runs = rows.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_run")


def ordered_totals(start: DataFrame, io: DataFrame, spends: DataFrame, last_first: bool = False) -> DataFrame:
    """`txid, idx, tainted`: satoshis of each coin that first-in-first-out (or last-in) order taints, if any."""
    stretches = ordered_intervals(start, io, spends, last_first)
    return stretches.groupBy(*COIN).agg(F.sum(F.col("hi") - F.col("lo")).alias("tainted")).filter("tainted > 0")
