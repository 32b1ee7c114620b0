"""Further analyses of a ledger: clusters, change, taint, patterns, ages, prices."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinloom.functions.scalars import hop_confidence
from coinloom.operators.balances import coins
from coinloom.operators.components import connected_components
from coinloom.operators.scratch import bucketed, staged
from coinloom.operators.skew import BLOCK, dealt

DUST = 546


def departures(io: DataFrame, spends: DataFrame) -> DataFrame:
    """`address, spending_txid, sats`: what each address put into each transaction."""
    return (
        coins(io, spends).filter("spending_txid is not null").groupBy("address", "spending_txid").agg(F.sum("amount").alias("sats"))
    )


def price_at(rows: DataFrame, time: str, prices: DataFrame, currency: str) -> DataFrame:
    """`rows` plus `price`: the latest price at or before each row's time.

    Prices become steps inside a day, the first of them carried from the days before, and rows meet
    the steps of their day. Of prices at one time the largest counts. Only the days, never the rows,
    pass through one window.
    """
    p = prices.filter(F.col("currency") == currency).select(F.col("ts").alias("_lo"), "price", F.to_date("ts").alias("_day"))
    wanted = rows.select(F.to_date(time).alias("_day")).filter("_day is not null").distinct()
    last = p.groupBy("_day").agg(F.max_by("price", F.struct("_lo", "price")).alias("_last"))
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = wanted.join(last, "_day", "full").select(
        F.col("_day").cast("timestamp").alias("_lo"), F.last("_last", ignorenulls=True).over(before).alias("price"), "_day"
    )
    steps = carried.filter("price is not null").withColumn("_k", F.lit(0)).unionByName(p.withColumn("_k", F.lit(1)))
    inside = Window.partitionBy("_day").orderBy("_lo", "_k", "price")
    steps = steps.withColumn("_hi", F.lead("_lo").over(inside)).drop("_k")
    left = rows.withColumn("_at", F.col(time)).withColumn("_on", F.to_date(time))
    within = (F.col("_on") == F.col("_day")) & (F.col("_at") >= F.col("_lo")) & (F.col("_hi").isNull() | (F.col("_at") < F.col("_hi")))
    return left.join(steps, within, "left").select(*rows.columns, "price")


def fiat_values(
    io: DataFrame, tx: DataFrame, prices: DataFrame, currency: str = "USD", priced: Callable[..., DataFrame] = price_at
) -> DataFrame:
    """`value`: amount times price, exact, rounded once to millionths. `priced` is `price_at` or `price_merge`."""
    outs = io.filter("io_type = 'out'").join(tx.select("txid", "received_time"), "txid").select("txid", "idx", "amount", "received_time")
    exact = F.expr("cast(round(cast(amount as decimal(16,0)) * cast(price as decimal(18,8)), -2) / 100 as bigint)")
    return priced(outs, "received_time", prices, currency).withColumn("value", exact / F.lit(1e6))


def price_merge(rows: DataFrame, time: str, prices: DataFrame, currency: str, parts: int | None = None) -> DataFrame:
    """`rows` plus `price` as `price_at` gives it, by merging both sides in order of time.

    Rows and prices are dealt together into ranges of time, a price before the rows of its moment, and
    written once with the range each lies in; rows of one moment may be split over ranges. Inside a
    range the last price seen is carried on, and the first rows take the last price of the ranges
    before: one row a range passes through a window. Each row is compared once, however many prices a
    day has, and a range is a share of all rows, however many one day has.
    """
    p = prices.filter(F.col("currency") == currency).groupBy("ts").agg(F.max("price").alias("price"))
    none = F.lit(None).cast(dict(p.dtypes)["price"])
    names = [f"_{i}" for i in range(len(rows.columns))]
    left = rows.withColumn("_ts", F.col(time)).toDF(*names, "_ts")
    marked = left.select("_ts", F.lit(1).alias("_kind"), F.xxhash64("_ts", *names).alias("_tie"), F.struct(*names).alias("_row"), none.alias("_price"))
    step = p.select(F.col("ts").alias("_ts"), F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_tie"), F.lit(None).cast(marked.schema["_row"].dataType).alias("_row"), F.col("price").alias("_price"))
    both = marked.filter("_ts is not null").unionByName(step)
    order = ["_ts", "_kind", "_tie"]
    dealt = both.repartitionByRange(*([parts] if parts else []), *order)
    merged = staged(dealt.withColumn("_part", F.spark_partition_id()))
    tails = merged.filter("_kind = 0").groupBy("_part").agg(F.max_by("_price", "_ts").alias("_tail"))
    every = merged.select("_part").distinct().join(tails, "_part", "left")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("_part", F.last("_tail", ignorenulls=True).over(before).alias("_carried"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    priced = merged.withColumn("_in", F.last("_price", ignorenulls=True).over(inside)).filter("_kind = 1").join(carried, "_part")
    timeless = marked.filter("_ts is null").select("_row", none.alias("price"))
    found = priced.select("_row", F.coalesce("_in", "_carried").alias("price")).unionByName(timeless)
    return found.select("_row.*", "price").toDF(*rows.columns, "price")


def match_amounts(left: DataFrame, right: DataFrame, tolerance: int, seconds: int, block: int = BLOCK) -> DataFrame:
    """Pairs of a left row and a later right row (id, sats, ts) with amounts within `tolerance` below and
    times within `seconds`: both are cut to cells, and a left row looks into its own and the next cells.

    A popular amount makes one cell large; cells of more than `block` rows on a side are joined by
    pairs of blocks. Rows without an amount or a time match nothing.
    """
    cell = lambda c, w: F.floor(F.col(c) / w)
    at = F.unix_timestamp("ts")
    a = left.select(F.col("id").alias("left_id"), F.col("sats").alias("s1"), at.alias("t1"))
    b = right.select(F.col("id").alias("right_id"), F.col("sats").alias("s2"), at.alias("t2"))
    a = a.withColumn("cs", F.explode(F.array(cell("s1", tolerance + 1), cell("s1", tolerance + 1) - 1)))
    a = a.withColumn("ct", F.explode(F.array(cell("t1", seconds + 1), cell("t1", seconds + 1) + 1)))
    b = b.withColumn("cs", cell("s2", tolerance + 1)).withColumn("ct", cell("t2", seconds + 1))
    near = (F.col("s1") - F.col("s2")).between(0, tolerance) & (F.col("t2") - F.col("t1")).between(0, seconds)
    a, b = dealt(a.dropna(subset=["cs", "ct"]), b.dropna(subset=["cs", "ct"]), ["cs", "ct"], "left_id", "right_id", block)
    return a.join(b, ["cs", "ct", "_i", "_j"]).filter(near).select(
        "left_id", "right_id", (F.col("s1") - F.col("s2")).alias("gap_sats"), (F.col("t2") - F.col("t1")).alias("gap_s")
    )


def mixing_shape(io: DataFrame, least: int = 3) -> DataFrame:
    """`txid, equal_outputs, n_in, is_mix, anonymity`: many equal outputs, and as many inputs at least."""
    outs = io.filter("io_type = 'out'").groupBy("txid", "amount").agg(F.count("*").alias("n"))
    top = outs.groupBy("txid").agg(F.max("n").alias("equal_outputs"))
    ins = io.filter("io_type = 'in'").groupBy("txid").agg(F.count("*").alias("n_in"))
    return top.join(ins, "txid", "left").fillna(0, ["n_in"]).select(
        "txid", "equal_outputs", "n_in",
        ((F.col("equal_outputs") >= least) & (F.col("n_in") >= F.col("equal_outputs"))).alias("is_mix"),
        (F.lit(1.0) / F.col("equal_outputs")).alias("anonymity"),
    )


def wallet_clusters(io: DataFrame, mixes: DataFrame | None = None) -> DataFrame:
    """`node, component`: addresses joined by common inputs, transitively, mixing transactions left out."""
    ins = io.filter("io_type = 'in' and address is not null").select("txid", "address").distinct()
    if mixes is not None:
        ins = ins.join(mixes.filter("is_mix").select("txid"), "txid", "left_anti")
    low = ins.groupBy("txid").agg(F.min("address").alias("first"))
    return connected_components(ins.join(low, "txid").select("first", "address"), "first", "address")


def cluster_changes(labels: DataFrame, io: DataFrame, mixes: DataFrame | None = None) -> DataFrame:
    """`node, component` rows that transactions in `io` add to or change in `labels` (node, component), and no others.

    The new star edges are contracted to the components that their addresses have; the components of
    that small graph say which labels give way to which, and only the members of those are relabelled.
    A component is called after its smallest node, so the result is that of a run over everything.
    """
    ins = io.filter("io_type = 'in' and address is not null").select("txid", "address").distinct()
    if mixes is not None:
        ins = ins.join(mixes.filter("is_mix").select("txid"), "txid", "left_anti")
    low = ins.groupBy("txid").agg(F.min("address").alias("first"))
    star = ins.join(low, "txid").select("first", "address").filter("first != address").distinct()
    asked = star.select(F.explode(F.array("first", "address")).alias("node")).distinct()
    known = staged(asked.join(labels, "node", "left").withColumn("at", F.coalesce("component", "node")))
    at = lambda c: known.select(F.col("node").alias(c), F.col("at").alias(f"{c}_at"))
    small = star.join(at("first"), "first").join(at("address"), "address").select("first_at", "address_at")
    moved = staged(connected_components(small, "first_at", "address_at"))
    into = moved.select(F.col("node").alias("at"), F.col("component").alias("to"))
    fresh = known.filter("component is null").join(into, "at", "left").select("node", F.coalesce("to", "at").alias("component"))
    gave_way = into.filter("at != to").select(F.col("at").alias("component"), "to")
    changed = labels.join(gave_way, "component").select("node", F.col("to").alias("component"))
    return fresh.unionByName(changed)


def with_changes(labels: DataFrame, changes: DataFrame) -> DataFrame:
    """`labels` with rows of `changes` in place of those of the same node, and its new ones."""
    return labels.join(changes.select("node"), "node", "left_anti").unionByName(changes)


def address_reuse(io: DataFrame) -> DataFrame:
    """`address, n_tx`: addresses paid by more than one transaction."""
    return io.filter("io_type = 'out'").groupBy("address").agg(F.count_distinct("txid").alias("n_tx")).filter("n_tx > 1")


def change_scores(io: DataFrame, spends: DataFrame, tx: DataFrame) -> DataFrame:
    """Signs that an output is change, one column each, and their weighted sum.

    fresh: first use of the address; same_type: the type of the inputs; odd_amount: no round number;
    covers: smaller than every input; returns: an input address again; last: in the last place.
    """
    at = tx.select("txid", "height")
    first = io.join(at, "txid").groupBy("address").agg(F.min("height").alias("first_height"))
    ins = io.filter("io_type = 'in'")
    inputs = ins.groupBy("txid").agg(
        F.min("amount").alias("least_in"), F.max("address_type").alias("in_type"), F.count_distinct("address_type").alias("n_types")
    )
    own = ins.select("txid", "address").distinct().withColumn("returns", F.lit(1))
    last = io.filter("io_type = 'out'").groupBy("txid").agg(F.max("idx").alias("last_idx"))
    flag = lambda c: F.when(c, 1).otherwise(0)
    rows = (
        io.filter("io_type = 'out'").join(at, "txid").join(first, "address").join(inputs, "txid").join(last, "txid")
        .join(own, ["txid", "address"], "left")
        .select(
            "txid", "idx", "address",
            flag(F.col("first_height") == F.col("height")).alias("fresh"),
            flag((F.col("n_types") == 1) & (F.col("in_type") == F.col("address_type"))).alias("same_type"),
            flag(F.col("amount") % 10_000 != 0).alias("odd_amount"),
            flag(F.col("amount") < F.col("least_in")).alias("covers"),
            F.coalesce("returns", F.lit(0)).alias("returns"),
            flag(F.col("idx") == F.col("last_idx")).alias("last"),
        )
    )
    score = 2 * F.col("fresh") + 2 * F.col("same_type") + F.col("odd_amount") + 2 * F.col("covers") + 4 * F.col("returns") + F.col("last")
    return rows.withColumn("score", score)


def poison(start: DataFrame, io: DataFrame, spends: DataFrame, hops: int | None = None) -> DataFrame:
    """`txid, idx, hop`: coins that anything tainted (txid, idx) leads to, at their first hop; all of them without `hops`."""
    # A transaction that is reached taints all its outputs, so the walk goes over transactions. Only what is
    # reached is shuffled, not the tables: outputs lie by transaction, spends by coin.
    outs = io.filter("io_type = 'out'").select("txid", "idx")
    edge = spends.select(F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("idx"), F.col("spending_txid").alias("next"))
    start = bucketed(start.select("txid", "idx").distinct(), "txid")
    at, whole = start.join(edge, ["txid", "idx"]).select(F.col("next").alias("txid")).distinct(), None
    for hop in itertools.count(1) if hops is None else range(1, hops + 1):
        at = staged((at if whole is None else at.join(whole, "txid", "left_anti")).withColumn("hop", F.lit(hop)))
        if at.isEmpty():
            break
        whole = at if whole is None else whole.unionByName(at)
        at = outs.join(at, "txid").join(edge, ["txid", "idx"]).select(F.col("next").alias("txid")).distinct()
    coins = start.withColumn("hop", F.lit(0))
    if whole is None:
        return coins
    return coins.unionByName(same_coins(outs.join(whole, "txid"), start, "left_anti").select("txid", "idx", "hop"))


def same_coins(rows: DataFrame, coins: DataFrame, how: str) -> DataFrame:
    """`rows` joined to `coins` on (txid, idx), where both lie by txid: only that is a key, so neither is dealt by coin.

    Rows of one transaction meet all of its coins, so that work is bounded by what a transaction may hold.
    """
    coins = coins.withColumnsRenamed({"txid": "_txid", "idx": "_idx"})
    place = (F.col("idx") >= F.col("_idx")) & (F.col("idx") <= F.col("_idx"))
    return rows.join(coins, (F.col("txid") == F.col("_txid")) & place, how).drop("_txid", "_idx")


def haircut_taint(
    start: DataFrame, io: DataFrame, spends: DataFrame, tx: DataFrame, hops: int | None = None
) -> DataFrame:
    """`txid, idx, hop, tainted_milli`: at each hop, an output's share of the tainted input of its transaction.

    In thousandths of a satoshi, cut at each hop; null where the inputs' total is null or 0. Without
    `hops` until no coin is left.
    """
    outs = io.filter("io_type = 'out'").select("txid", "idx", "amount")
    edge = spends.select(F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("idx"), "spending_txid")
    totals = tx.select("txid", F.nullif("total_in", F.lit(0)).alias("total_in"))
    at = same_coins(outs, start.select("txid", "idx").distinct(), "left_semi").select(
        "txid", "idx", F.lit(0).alias("hop"), (F.col("amount") * 1000).alias("tainted_milli")
    )
    share = F.expr("(cast(amount as decimal(16,0)) * cast(put as decimal(19,0))) div cast(total_in as decimal(19,0))")
    whole = at
    for hop in itertools.count(1) if hops is None else range(1, hops + 1):
        put = at.join(edge, ["txid", "idx"]).groupBy(F.col("spending_txid").alias("txid")).agg(F.sum("tainted_milli").alias("put"))
        at = staged(
            put.join(totals, "txid").join(outs, "txid").select("txid", "idx", F.lit(hop).alias("hop"), share.alias("tainted_milli"))
        )
        if at.isEmpty():
            break
        whole = whole.unionByName(at)
    return whole


def ordered_taint(tainted: DataFrame, io: DataFrame, spends: DataFrame, last_first: bool = False) -> DataFrame:
    """`txid, idx, tainted`: first-in-first-out (or last-in) assignment of inputs to outputs in each transaction.

    Inputs and outputs are laid end to end; an output takes the taint of the inputs that it overlaps.
    """
    ins = io.filter("io_type = 'in'").select("txid", "idx", "amount")
    order = F.desc("idx") if last_first else F.asc("idx")
    side = Window.partitionBy("txid").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    laid_in = ins.withColumn("hi", F.sum("amount").over(side)).withColumn("lo", F.col("hi") - F.col("amount"))
    edge = spends.select(
        F.col("prev_txid").alias("p"), F.col("prev_vout").alias("v"), F.col("spending_txid").alias("txid"), F.col("spending_vin").alias("idx")
    )
    marked = edge.join(tainted.select(F.col("txid").alias("p"), F.col("idx").alias("v")).distinct(), ["p", "v"], "left_semi")
    bad = laid_in.join(marked.select("txid", "idx"), ["txid", "idx"], "left_semi").select("txid", "lo", "hi")
    out_side = Window.partitionBy("txid").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    outs = io.filter("io_type = 'out'").select("txid", "idx", "amount")
    laid_out = outs.withColumn("ohi", F.sum("amount").over(out_side)).withColumn("olo", F.col("ohi") - F.col("amount"))
    overlap = F.least("hi", "ohi") - F.greatest("lo", "olo")
    return (
        laid_out.join(bad, "txid").filter(overlap > 0).groupBy("txid", "idx").agg(F.sum(overlap).alias("tainted"))
    )


def peel_chains(io: DataFrame, spends: DataFrame, max_rounds: int = 40) -> DataFrame:
    """`txid, length`: how many transactions of two outputs, one of them much larger and spent on, follow each other.

    Every round a chain's pointer takes over the pointer where it ends, so lengths double.
    """
    outs = io.filter("io_type = 'out'")
    shape = outs.groupBy("txid").agg(
        F.count("*").alias("n"), F.max("amount").alias("big"), F.sum("amount").alias("whole"), F.max_by("idx", F.struct("amount", "idx")).alias("idx")
    ).filter((F.col("n") == 2) & (F.col("big") * 2 > F.col("whole")))
    edge = spends.select(F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("idx"), F.col("spending_txid").alias("next"))
    step = shape.join(edge, ["txid", "idx"]).join(shape.select(F.col("txid").alias("next")), "next", "left_semi").select("txid", "next")
    ends = staged(
        shape.select("txid").join(step, "txid", "left")
        .select("txid", F.coalesce("next", "txid").alias("at"), F.when(F.col("next").isNull(), 0).otherwise(1).cast("long").alias("steps"))
    )
    for _ in range(max_rounds):
        on = ends.select(F.col("txid").alias("at"), F.col("at").alias("_to"), F.col("steps").alias("_more"))
        ends = staged(ends.join(on, "at").select("txid", F.col("_to").alias("at"), (F.col("steps") + F.col("_more")).alias("steps"), (F.col("_more") > 0).alias("_on")))
        if ends.filter("_on").isEmpty():
            return ends.select("txid", (F.col("steps") + 1).alias("length"))
        ends = ends.drop("_on")
    raise RuntimeError("transactions spend each other in a circle")


def dust(io: DataFrame, spends: DataFrame, limit: int = DUST) -> DataFrame:
    """Outputs below the limit, whether spent, and with how many other inputs."""
    inputs = spends.groupBy("spending_txid").agg(F.count("*").alias("n_inputs"))
    return (
        coins(io, spends).filter(F.col("amount") < limit).join(inputs, "spending_txid", "left")
        .select("txid", "idx", "address", "amount", "spending_txid", F.coalesce("n_inputs", F.lit(0)).alias("n_inputs"))
    )


def degrees(io: DataFrame, spends: DataFrame) -> DataFrame:
    """In and out degree and turnover of each address: transactions that pay it and that it spends in."""
    return coins(io, spends).groupBy("address").agg(
        F.count_distinct("txid").alias("in_degree"),
        F.count_distinct("spending_txid").alias("out_degree"),
        F.sum("amount").alias("turnover"),
    )


def deposit_addresses(io: DataFrame, spends: DataFrame, tags: DataFrame, category: str = "exchange") -> DataFrame:
    """Addresses paid once and swept once into a transaction that pays a tagged address."""
    once = coins(io, spends).groupBy("address").agg(
        F.count("*").alias("n"), F.max("spending_txid").alias("swept"), F.sum("amount").alias("sats")
    ).filter("n = 1 and swept is not null")
    tagged = tags.filter(F.col("category") == category).select("address").distinct()
    pays = io.filter("io_type = 'out'").join(tagged, "address", "left_semi").select(F.col("txid").alias("swept")).distinct()
    own = tagged.withColumnRenamed("address", "_t")
    return once.join(pays, "swept", "left_semi").join(own, F.col("address") == F.col("_t"), "left_anti").select("address", "swept", "sats")


def coin_age(io: DataFrame, spends: DataFrame, tx: DataFrame) -> DataFrame:
    """`height, spent_sats, coin_days`: days since each spent coin was made, times its amount."""
    made = tx.select("txid", F.col("received_time").alias("made"))
    spent = coins(io, spends).filter("spending_txid is not null").join(made, "txid")
    at = spends.select(F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("idx"), "spent_time")
    days = F.datediff("spent_time", "made")
    return (
        spent.join(at, ["txid", "idx"]).groupBy(F.col("spent_height").alias("height"))
        .agg(F.sum("amount").alias("spent_sats"), F.sum(F.col("amount").cast("decimal(20,0)") * days.cast("decimal(10,0)")).cast("decimal(38,0)").cast("string").alias("coin_days"))
    )


def hours_of_day(io: DataFrame, tx: DataFrame) -> DataFrame:
    return (
        io.filter("io_type = 'in'").join(tx.select("txid", "received_time"), "txid").groupBy("address", F.hour("received_time").alias("hour"))
        .agg(F.count_distinct("txid").alias("n_tx"))
    )


#: Periods that behaviour is held against, in seconds: a day, a week, four weeks.
PERIODS = (86_400, 7 * 86_400, 28 * 86_400)


def periodicity(events: DataFrame, periods: tuple[int, ...] = PERIODS, least: int = 5) -> DataFrame:
    """`address, period_s, n_events, score`: how strongly each address's events (address, ts) keep to each period.

    Every event is a point on a circle of the period's length; `score` is Rayleigh's: the squared length
    of the summed points over their number, 0 for evenly spread events and their number if all fall on
    one phase. Chance passes a score of s with a probability of about exp(-s). Points are rounded to
    millionths, so sums are whole numbers that combine on the map side: a busy address is no single
    task. Addresses with fewer than `least` events are left out.
    """
    seconds = F.unix_timestamp("ts")
    timed = events.filter("address is not null and ts is not null").select("address", seconds.alias("t"))
    each = timed.select("address", "t", F.explode(F.array(*(F.lit(p).cast("bigint") for p in periods))).alias("period_s"))
    angle = F.lit(2 * math.pi) * (F.pmod("t", "period_s").cast("double") / F.col("period_s").cast("double"))
    whole = lambda f: F.round(f(angle) * 1e6).cast("bigint")
    sums = each.groupBy("address", "period_s").agg(F.count("*").alias("n_events"), F.sum(whole(F.cos)).alias("x"), F.sum(whole(F.sin)).alias("y"))
    x, y, n = (F.col(c).cast("double") for c in ("x", "y", "n_events"))
    return sums.filter(F.col("n_events") >= least).select("address", "period_s", "n_events", ((x * x + y * y) / (n * 1e12)).alias("score"))


def spending_times(io: DataFrame, tx: DataFrame) -> DataFrame:
    """`address, ts`: when each address spent, once for each transaction."""
    spent = io.filter("io_type = 'in' and address is not null").select("address", "txid").distinct()
    return spent.join(tx.select("txid", F.col("received_time").alias("ts")), "txid").select("address", "ts")


def first_funding(io: DataFrame, tx: DataFrame, ident: Callable[[str], Column] = F.col, name: Callable[[str], Column] = F.col) -> DataFrame:
    """`address, txid, first_time, sats, funder`: the first payment to each address and its largest input's address.

    Of payments at one time that of the lowest id counts; `ident` makes ids of the column `txid` where the
    tables hold keys, and `name` addresses of the column `address` where they hold codes.
    """
    paid = io.filter("io_type = 'out'").join(tx.select("txid", "received_time"), "txid").groupBy("address", "txid", "received_time").agg(F.sum("amount").alias("sats"))
    first = paid.groupBy("address").agg(F.min(F.struct("received_time", ident("txid").alias("_id"), "txid", "sats")).alias("f")).select(
        "address", "f.txid", F.col("f.received_time").alias("first_time"), "f.sats"
    )
    funder = io.filter("io_type = 'in'").groupBy("txid").agg(F.max(F.struct("amount", name("address").alias("_name"), "address")).alias("m")).select("txid", F.col("m.address").alias("funder"))
    return first.join(funder, "txid", "left").select("address", "txid", "first_time", "sats", "funder")


def fees(tx: DataFrame) -> DataFrame:
    """Inputs minus outputs of transactions that have inputs."""
    return tx.filter("total_in > 0").select("txid", "height", (F.col("total_in") - F.col("total_out")).alias("fee_sats"))


def path_confidence(hops: Column) -> Column:
    """Product of the confidences of hops 0 .. hops - 1."""
    steps = F.filter(F.sequence(F.lit(0), F.greatest(hops - 1, F.lit(0))), lambda d: d < hops)
    return F.aggregate(steps, F.lit(1.0), lambda a, d: a * hop_confidence(d))
