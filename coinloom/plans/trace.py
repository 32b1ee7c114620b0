"""Following value through the spend graph: edges of a frontier, wallet clusters, bounded breadth-first graphs.

Every step takes a frame of addresses, not one address; a level of the search is one set of joins.
"""

from __future__ import annotations

import itertools
import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinloom.functions.scalars import attribution, category_rank, hop_confidence, rounded_long, signed_level, to_coins
from coinloom.operators.balances import output_counts
from coinloom.operators.scratch import bucketed, staged

# Fixed value: addresses with more outputs are not followed.
HUB_OUTPUTS = 20_000


@dataclass(frozen=True)
class Limits:
    depth: int = 3
    fanout: int = 10
    max_nodes: int = 750
    max_coins: int | None = 2_000
    hub_outputs: int = HUB_OUTPUTS
    cluster_txs: int | None = 2_000
    cluster_addresses: int | None = 8_000


def _ranked(edges: DataFrame, fanout: int | None, name: Callable[[str], Column]) -> DataFrame:
    order = Window.partitionBy("address").orderBy(F.desc_nulls_last("value_sats"), name("other"))
    ranked = edges.withColumn("rank", F.row_number().over(order))
    return ranked if fanout is None else ranked.filter(F.col("rank") <= fanout)


def first_rows(rows: DataFrame, by: str, order: list[Column | str], most: int, ident: list[str], parts: int = 64) -> DataFrame:
    """The first `most` rows of each `by`, in two steps: of each of `parts` parts by a hash of `ident`, then of those.

    No task sorts more than a part of a key, or `most` rows of every part, however many rows a key has.
    """
    part = rows.withColumn("_part", F.pmod(F.xxhash64(*ident), F.lit(parts)))
    for keys in ([by, "_part"], [by]):
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        part = part.withColumn("_n", nth).filter(F.col("_n") <= most).drop("_n")
    return part.drop("_part")


def outgoing_edges(
    frontier: DataFrame, io: DataFrame, spends: DataFrame, tx: DataFrame,
    fanout: int | None = 10, max_coins: int | None = 2_000, name: Callable[[str], Column] = F.col,
) -> DataFrame:
    """Recipients of the value that each address of `frontier` (address) sent, weighted by haircut.

    Of an address only its `max_coins` largest outputs are followed (ties by txid, idx). A recipient
    gets of each spending transaction its share of what the address put in, in thousandths of a
    satoshi, cut, then summed and rounded; null where the transaction's input total is null or 0.
    `single_input`: every transaction had one input. Recipients of equal value are ranked by address;
    `name` makes addresses of codes where the tables hold those.
    """
    outs = io.filter("io_type = 'out' and address is not null")
    own = outs.join(frontier.select("address").distinct(), "address", "left_semi").select("address", "txid", "idx", "amount")
    if max_coins is not None:
        own = first_rows(own, "address", [F.desc("amount"), "txid", "idx"], max_coins, ["txid", "idx"])
    edge = spends.select(F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("idx"), "spending_txid")
    spent = own.join(edge, ["txid", "idx"]).groupBy("address", "spending_txid").agg(F.sum("amount").alias("u_in"))
    used = spent.select("spending_txid").distinct()
    inputs = spends.join(used, "spending_txid", "left_semi").groupBy("spending_txid").agg(F.count("*").alias("n_inputs"))
    paid = (
        outs.select(F.col("txid").alias("spending_txid"), F.col("address").alias("other"), "amount")
        .join(used, "spending_txid", "left_semi")
        .groupBy("spending_txid", "other")
        .agg(F.sum("amount").alias("v_out"))
    )
    milli = F.expr(
        "(cast(v_out * 1000 as decimal(19,0)) * cast(u_in as decimal(16,0))) div cast(nullif(total_in, 0) as decimal(19,0))"
    )
    # Flows are dealt by their edge once, before the distinct count, which would deal them by transaction too.
    flows = (
        spent.join(inputs, "spending_txid")
        .join(tx.select(F.col("txid").alias("spending_txid"), "total_in", "received_time"), "spending_txid")
        .join(paid, "spending_txid")
        .select("address", "other", "spending_txid", "received_time", milli.alias("milli"), (F.col("n_inputs") == 1).alias("single"))
    )
    edges = (
        flows.repartition("address", "other")
        .groupBy("address", "other")
        .agg(
            F.sum("milli").alias("value_milli"),
            F.count_distinct("spending_txid").alias("tx_count"),
            F.min("received_time").alias("first_seen"),
            F.max("received_time").alias("last_seen"),
            F.bool_and("single").alias("single_input"),
        )
        .withColumn("value_sats", rounded_long(F.col("value_milli").cast("decimal(30,0)") / F.lit(1000)))
    )
    return _ranked(edges, fanout, name)


def incoming_edges(
    frontier: DataFrame, io: DataFrame, spends: DataFrame, tx: DataFrame,
    fanout: int | None = 10, max_coins: int | None = 2_000, haircut: bool = False, name: Callable[[str], Column] = F.col,
) -> DataFrame:
    """Funders of each address of `frontier`: inputs of the transactions that paid it, in full.

    Of an address at most `max_coins` such transactions (lowest ids) count. With `haircut` an input
    counts by the address's share of the transaction's outputs.
    """
    got = (
        io.filter("io_type = 'out'")
        .join(frontier.select("address").distinct(), "address", "left_semi")
        .groupBy("address", "txid")
        .agg(F.sum("amount").alias("u_out"))
    )
    if max_coins is not None:
        got = first_rows(got, "address", ["txid"], max_coins, ["txid"])
    used = got.select(F.col("txid").alias("spending_txid")).distinct()
    counts = (
        spends.join(used, "spending_txid", "left_semi").groupBy(F.col("spending_txid").alias("txid")).agg(F.count("*").alias("n_inputs"))
    )
    share = F.expr("cast(amount as decimal(18,0)) * cast(u_out as decimal(18,0)) div cast(nullif(total_out, 0) as decimal(18,0))")
    funders = io.filter("io_type = 'in' and address is not null").select("txid", F.col("address").alias("other"), "amount")
    flows = (
        got.join(funders, "txid")
        .join(tx.select("txid", "total_out", "received_time"), "txid")
        .join(counts, "txid", "left")
        .select(
            "address", "other", "txid", "received_time", (share if haircut else F.col("amount")).alias("sats"),
            (F.coalesce("n_inputs", F.lit(1)) == 1).alias("single"),
        )
    )
    edges = (
        flows.repartition("address", "other")
        .groupBy("address", "other")
        .agg(
            F.sum("sats").alias("value_sats"),
            F.count_distinct("txid").alias("tx_count"),
            F.min("received_time").alias("first_seen"),
            F.max("received_time").alias("last_seen"),
            F.bool_and("single").alias("single_input"),
        )
    )
    return _ranked(edges, fanout, name)


def co_spent(
    origins: DataFrame, io: DataFrame, spends: DataFrame, tx_cap: int | None = 2_000, addr_cap: int | None = 8_000
) -> DataFrame:
    """`origin, address`: one round of common inputs, with the origin itself; not transitive on purpose.

    The caps take the lowest transaction ids and addresses; None takes all.
    """
    outs = io.filter("io_type = 'out'").join(
        origins.select(F.col("origin").alias("address")).distinct(), "address", "left_semi"
    )
    edge = spends.select(F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("idx"), "spending_txid")
    used = outs.join(edge, ["txid", "idx"]).select(F.col("address").alias("origin"), F.col("spending_txid").alias("txid")).distinct()
    if tx_cap is not None:
        used = first_rows(used, "origin", ["txid"], tx_cap, ["txid"])
    ins = io.filter("io_type = 'in' and address is not null").select("txid", "address")
    near = used.join(ins, "txid").select("origin", "address").distinct()
    if addr_cap is not None:
        near = first_rows(near, "origin", ["address"], addr_cap, ["address"])
    return near.unionByName(origins.select("origin", F.col("origin").alias("address"))).distinct()


def best_tags(tags: DataFrame) -> DataFrame:
    """One tag of each address: by category, then confidence (null last), then source."""
    order = Window.partitionBy("address").orderBy(
        category_rank(F.col("category")), F.desc_nulls_last("confidence"), "source"
    )
    return tags.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")


@dataclass(frozen=True)
class Graph:
    """Nodes and edges of one or many origins (column `origin`)."""

    nodes: DataFrame
    edges: DataFrame
    cluster: DataFrame
    incoming: DataFrame


def size_warning(limits: Limits) -> str | None:
    """A remark if the search may reach the cap on nodes."""
    most = limits.fanout**limits.depth
    if most <= limits.max_nodes:
        return None
    text = f"up to {most} nodes at depth {limits.depth}, cut at {limits.max_nodes}"
    logging.getLogger(__name__).warning(text)
    return text


def build_graph(
    origins: DataFrame, io: DataFrame, spends: DataFrame, tx: DataFrame, tags: DataFrame | None = None,
    limits: Limits = Limits(), direction: str = "out", cluster: bool = True, name: Callable[[str], Column] = F.col,
) -> Graph:
    """Breadth-first graphs of `origins` (origin), level by level, for all origins at once.

    A node is expanded once in each direction if its depth is below the limit, it is no hub (the
    origin may be one) and not in the origin's cluster. The first discovery fixes depth and side;
    the outgoing pass goes first. The cap on nodes keeps the edges up to and with the one that brings
    the last node; it ends a pass, and the incoming pass still takes its first edge. The origin's
    cluster is that of `co_spent` under the limits' two caps.
    """
    size_warning(limits)
    origins = staged(origins.select("origin").distinct())
    members = staged(co_spent(origins, io, spends, limits.cluster_txs, limits.cluster_addresses) if cluster else origins.select("origin", F.col("origin").alias("address")))
    nodes = origins.select(
        "origin", F.col("origin").alias("address"), F.lit(0).alias("depth"), F.lit("origin").alias("side"),
        F.lit(False).alias("truncated"), F.lit(None).cast("string").alias("parent"),
    )
    edges = None
    cut_marks = []
    for side in ["out", "in"] if direction == "both" else [direction]:
        frontier = origins.select("origin", F.col("origin").alias("address"), F.lit(0).cast("long").alias("ord"))
        seen = frontier.select("origin", "address")
        for depth in range(limits.depth):
            hubs = _hubs(frontier, io, limits.hub_outputs)
            open_nodes = frontier.join(hubs, "address", "left_anti").unionByName(
                frontier.join(hubs, "address", "left_semi").filter("address = origin")
            )
            step = outgoing_edges if side == "out" else incoming_edges
            found = step(open_nodes, io, spends, tx, limits.fanout, limits.max_coins, name=name)
            level = open_nodes.join(found.drop("value_milli"), "address").withColumn("rank", F.col("rank").cast("long"))
            level = _capped(level, nodes, limits.max_nodes, depth == 0)
            level = staged(level.withColumn("depth", F.lit(depth)).withColumn("dir", F.lit(side)))
            full = level.groupBy("origin", "address").agg(F.count("*").alias("n")).filter(F.col("n") >= limits.fanout)
            cut_marks.append(full.select("origin", "address"))
            new = (
                level.join(nodes.select("origin", F.col("address").alias("other")), ["origin", "other"], "left_anti")
                .groupBy("origin", "other")
                .agg(F.min_by("address", F.struct("ord", "rank")).alias("parent"))
                .select(
                    "origin", F.col("other").alias("address"), F.lit(depth + 1).alias("depth"), F.lit(side).alias("side"),
                    F.lit(False).alias("truncated"), "parent",
                )
            )
            nodes = staged(nodes.unionByName(new))
            edges = level if edges is None else edges.unionByName(level)
            reached = (
                level.groupBy("origin", "other").agg(F.min(F.struct("ord", "rank")).alias("at"))
                .select("origin", F.col("other").alias("address"), "at")
                .join(seen, ["origin", "address"], "left_anti")
                .join(members, ["origin", "address"], "left_anti")
            )
            order = Window.partitionBy("origin").orderBy("at")
            frontier = staged(
                reached.select("origin", "address", F.row_number().over(order).cast("long").alias("ord"))
            )
            seen = seen.unionByName(frontier.select("origin", "address"))
            if depth + 1 == limits.depth or frontier.isEmpty():
                break
    marks = cut_marks[0]
    for m in cut_marks[1:]:
        marks = marks.unionByName(m)
    return Graph(
        staged(_node_frame(nodes, marks.distinct(), members, limits.hub_outputs, io, tags)),
        _edge_frame(edges, members),
        members,
        _edge_frame_incoming(origins, members, io, spends, tx, limits, name),
    )


def _hubs(rows: DataFrame, io: DataFrame, most: int) -> DataFrame:
    """Those addresses of `rows` that have more than `most` outputs."""
    wanted = rows.select("address").distinct()
    return output_counts(io.join(wanted, "address", "left_semi")).filter(F.col("n_outputs") > most).select("address")


def _capped(level: DataFrame, nodes: DataFrame, most: int, first_level: bool) -> DataFrame:
    """Edges up to and with the one that makes the number of nodes reach the cap; the first edge of a pass always.

    Edges are numbered in the order of the search; each origin has at most fanout times its frontier.
    """
    known = nodes.groupBy("origin").agg(F.count("*").alias("_have"))
    old = nodes.select("origin", F.col("address").alias("other"), F.lit(True).alias("_old"))
    order = Window.partitionBy("origin").orderBy("ord", "rank")
    first = Window.partitionBy("origin", "other").orderBy("ord", "rank")
    return (
        level.join(old, ["origin", "other"], "left")
        .join(known, "origin")
        .withColumn("_new", F.when(F.col("_old").isNull() & (F.row_number().over(first) == 1), 1).otherwise(0))
        .withColumn("_before", F.coalesce(F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_nth", F.row_number().over(order))
        .filter((F.col("_have") + F.col("_before") < most) | (F.lit(first_level) & (F.col("_nth") == 1)))
        .drop("_have", "_old", "_new", "_before", "_nth")
    )


def _node_frame(
    nodes: DataFrame, marks: DataFrame, members: DataFrame, hub_outputs: int, io: DataFrame, tags: DataFrame | None
) -> DataFrame:
    wanted = nodes.select("address").distinct()
    side = lambda kind: F.when(F.col("io_type") == kind, F.col("amount"))
    totals = io.join(wanted, "address", "left_semi").groupBy("address").agg(
        F.sum(side("out")).alias("received_sats"), F.sum(side("in")).alias("sent_sats"), (F.count_if(F.col("io_type") == "out") > hub_outputs).alias("_hub")
    )
    frame = (
        nodes.drop("truncated")
        .join(marks.withColumn("truncated", F.lit(True)), ["origin", "address"], "left")
        .join(members.withColumn("_own", F.lit(True)), ["origin", "address"], "left")
        .join(totals, "address", "left")
        .select(
            "origin", "address", "depth", "side", signed_level(F.col("depth"), F.col("side")).alias("level"),
            (F.col("address") == F.col("origin")).alias("is_origin"),
            (F.col("_own").isNotNull() & (F.col("address") != F.col("origin"))).alias("same_owner"),
            (F.coalesce("_hub", F.lit(False)) & (F.col("address") != F.col("origin"))).alias("is_hub"),
            F.coalesce("truncated", F.lit(False)).alias("truncated"),
            to_coins(F.coalesce("received_sats", F.lit(0))).alias("total_received_btc"),
            to_coins(F.coalesce("sent_sats", F.lit(0))).alias("total_sent_btc"),
            "parent",
        )
    )
    none = F.lit(None).cast("string")
    if tags is None:
        return frame.select("*", none.alias("entity"), none.alias("entity_category"), none.alias("entity_source"))
    labels = best_tags(tags).select(
        "address", F.col("entity_name").alias("entity"), F.col("category").alias("entity_category"), F.col("source").alias("entity_source")
    )
    return frame.join(labels, "address", "left")


def _edge_frame(edges: DataFrame, members: DataFrame) -> DataFrame:
    own = members.select("origin", F.col("address").alias("other"), F.lit(True).alias("_own"))
    out = F.col("dir") == "out"
    return edges.join(own, ["origin", "other"], "left").select(
        "origin",
        F.when(out, F.col("address")).otherwise(F.col("other")).alias("from"),
        F.when(out, F.col("other")).otherwise(F.col("address")).alias("to"),
        "dir", "depth", "ord", "rank",
        F.coalesce("value_sats", F.lit(0)).alias("value_sats"),
        to_coins(F.coalesce("value_sats", F.lit(0))).alias("value_btc"),
        "tx_count", "first_seen", "last_seen",
        hop_confidence(F.col("depth")).alias("confidence"),
        F.col("_own").isNotNull().alias("returns_to_owner"),
        attribution(F.col("single_input")).alias("attribution"),
        F.col("single_input").alias("certain"),
    )


def _edge_frame_incoming(
    origins: DataFrame, members: DataFrame, io: DataFrame, spends: DataFrame, tx: DataFrame, limits: Limits, name: Callable[[str], Column]
) -> DataFrame:
    found = incoming_edges(origins.select(F.col("origin").alias("address")), io, spends, tx, limits.fanout, limits.max_coins, name=name)
    own = members.select(F.col("origin").alias("_o"), F.col("address").alias("_a"))
    return (
        found.join(own, (F.col("address") == F.col("_o")) & (F.col("other") == F.col("_a")), "left")
        .select(
            F.col("address").alias("origin"), F.col("other").alias("address"), to_coins(F.col("value_sats")).alias("value_btc"),
            "tx_count", "first_seen", "last_seen", F.col("_a").isNotNull().alias("same_owner"),
            attribution(F.col("single_input")).alias("attribution"),
        )
    )


def graph_summary(graph: Graph, max_nodes: int = 750) -> DataFrame:
    """One row of measures for each origin."""
    nodes = graph.nodes.groupBy("origin").agg(
        F.max(F.when(F.col("is_origin"), F.col("total_received_btc"))).alias("total_received_btc"),
        F.max(F.when(F.col("is_origin"), F.col("total_sent_btc"))).alias("total_sent_btc"),
        F.count_if("same_owner").alias("related_wallets"),
        F.count("*").alias("node_count"),
    )
    edges = graph.edges.groupBy("origin").agg(
        F.count_if("returns_to_owner").alias("round_trips_to_owner"),
        F.count("*").alias("edge_count"),
        F.count_if("certain").alias("direct_flows"),
        F.count_if(~F.col("certain")).alias("comingled_flows"),
    )
    incoming = graph.incoming.groupBy("origin").agg(F.count("*").alias("distinct_funders_shown"))
    cluster = graph.cluster.groupBy("origin").agg(F.count("*").alias("cluster_size"))
    zero = ["round_trips_to_owner", "edge_count", "direct_flows", "comingled_flows", "distinct_funders_shown"]
    return (
        nodes.join(edges, "origin", "left")
        .join(incoming, "origin", "left")
        .join(cluster, "origin", "left")
        .fillna(0, zero)
        .withColumn("capped", F.col("node_count") >= max_nodes)
    )


def coin_trail(start: DataFrame, io: DataFrame, spends: DataFrame, hops: int) -> DataFrame:
    """`hop, txid, idx, amount, address`: every output that each start coin (txid, idx) leads to.

    All outputs of a spending transaction are followed; paths that meet keep their repeats, as one row
    with `paths`, so the frame never grows faster than the set of coins.
    """
    outs = io.filter("io_type = 'out'").select("txid", "idx", "amount", "address")
    at = start.groupBy("txid", "idx").agg(F.count("*").alias("paths")).withColumn("hop", F.lit(0))
    whole = at.join(outs, ["txid", "idx"])
    edge = spends.select(F.col("prev_txid").alias("txid"), F.col("prev_vout").alias("idx"), "spending_txid")
    for hop in range(1, hops + 1):
        spent = at.join(edge, ["txid", "idx"]).groupBy("spending_txid").agg(F.sum("paths").alias("paths"))
        at = staged(
            spent.withColumnRenamed("spending_txid", "txid").join(outs, "txid")
            .select("txid", "idx", "paths", F.lit(hop).alias("hop"), "amount", "address")
        )
        whole = whole.unionByName(at)
    return whole


def provenance(start: DataFrame, io: DataFrame, spends: DataFrame, tags: DataFrame, hops: int | None = None) -> DataFrame:
    """`hop, txid, is_coinbase, is_tagged`: transactions behind each start transaction (txid), back to those
    without inputs or with a tagged funder, where the walk stops; without `hops` all the way."""
    ins = io.filter("io_type = 'in'").select("txid", "address")
    stops = staged(ins.join(tags.select("address").distinct(), "address", "left_semi").select("txid").distinct())
    edge = bucketed(spends.select(F.col("spending_txid").alias("txid"), "prev_txid").distinct(), "txid")
    onward = bucketed(edge.join(stops, "txid", "left_anti"), "txid")
    at = start.select("txid").distinct().withColumn("hop", F.lit(0))
    whole = at
    for hop in itertools.count(1) if hops is None else range(1, hops + 1):
        at = staged(
            at.join(onward, "txid").select(F.col("prev_txid").alias("txid")).distinct()
            .join(whole.select("txid"), "txid", "left_anti").withColumn("hop", F.lit(hop))
        )
        if at.isEmpty():
            break
        whole = whole.unionByName(at)
    return (
        whole.join(stops.withColumn("_t", F.lit(True)), "txid", "left")
        .join(edge.select("txid").distinct().withColumn("_e", F.lit(True)), "txid", "left")
        .select("hop", "txid", F.col("_e").isNull().alias("is_coinbase"), F.col("_t").isNotNull().alias("is_tagged"))
    )
