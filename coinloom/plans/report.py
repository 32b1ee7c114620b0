"""Frames of a trace report: selections, collapsed entities, risk, exposures, sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinloom.functions.scalars import risk_name, risk_rank
from coinloom.operators.scratch import staged
from coinloom.plans.trace import Graph


def one_direction(nodes: DataFrame, edges: DataFrame, side: str) -> tuple[DataFrame, DataFrame]:
    """Nodes of one side, the origin always, and the edges with both ends among them."""
    kept = nodes.filter((F.col("side") == side) | F.col("is_origin"))
    ids = kept.select("origin", "address")
    inside = edges.join(ids.withColumnRenamed("address", "from"), ["origin", "from"], "left_semi").join(
        ids.withColumnRenamed("address", "to"), ["origin", "to"], "left_semi"
    )
    return kept, inside


def collapse_entities(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of one entity become one; edges follow, loops among them go, parallel ones add up."""
    key = F.coalesce(F.concat(F.lit("ent:"), F.col("entity")), F.col("address"))
    keyed = nodes.withColumn("key", key)
    merged = keyed.groupBy("origin", "key").agg(
        F.sum("total_received_btc").alias("total_received_btc"),
        F.sum("total_sent_btc").alias("total_sent_btc"),
        F.min("depth").alias("depth"),
        F.max("entity_category").alias("entity_category"),
        F.array_sort(F.collect_list("address")).alias("members"),
    )
    ids = keyed.select("origin", "address", "key")
    joined = edges.join(ids.select("origin", F.col("address").alias("from"), F.col("key").alias("from_key")), ["origin", "from"]).join(
        ids.select("origin", F.col("address").alias("to"), F.col("key").alias("to_key")), ["origin", "to"]
    )
    flows = (
        joined.filter("from_key != to_key")
        .groupBy("origin", "from_key", "to_key")
        .agg(F.sum("value_sats").alias("value_sats"), F.sum("tx_count").alias("tx_count"))
    )
    return merged, flows


def propagate_risk(nodes: DataFrame, edges: DataFrame, rounds: int = 40) -> DataFrame:
    """`origin, address, risk, risk_name`: the worst category on any path that leads to a node, itself included."""
    links = staged(edges.select("origin", "from", F.col("to").alias("address")).filter("from != to").distinct())
    risk = staged(nodes.select("origin", "address", risk_rank(F.col("entity_category")).alias("risk")))
    for _ in range(rounds):
        up = (
            links.join(risk.select("origin", F.col("address").alias("from"), F.col("risk").alias("r")), ["origin", "from"])
            .groupBy("origin", "address")
            .agg(F.max("r").alias("r"))
        )
        new = staged(
            risk.join(up, ["origin", "address"], "left").select(
                "origin", "address", F.greatest("risk", F.coalesce("r", F.lit(0))).alias("risk"), (F.col("r") > F.col("risk")).alias("_up")
            )
        )
        risk = new.drop("_up")
        if new.filter("_up").isEmpty():
            break
    return risk.withColumn("risk_name", risk_name(F.col("risk")))


def exposure(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Value that flows into nodes of each category."""
    kinds = nodes.filter("entity_category is not null").select("origin", F.col("address").alias("to"), "entity_category")
    return edges.join(kinds, ["origin", "to"]).groupBy("origin", "entity_category").agg(F.sum("value_sats").alias("value_sats"))


def top_flows(edges: DataFrame, k: int = 6) -> DataFrame:
    order = Window.partitionBy("origin").orderBy(F.desc("value_sats"), "from", "to", "dir")
    return edges.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


def overview(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    n = nodes.groupBy("origin").agg(F.count("*").alias("addresses"), F.count_if("same_owner").alias("related_wallets"))
    e = edges.groupBy("origin").agg(F.count("*").alias("flows"), F.count_if("returns_to_owner").alias("round_trips"))
    return n.join(e, "origin", "left").fillna(0, ["flows", "round_trips"])


def entity_inflows(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    kinds = nodes.filter("entity is not null").select("origin", F.col("address").alias("to"), "entity", "entity_category")
    return (
        edges.join(kinds, ["origin", "to"])
        .groupBy("origin", "entity_category", "entity")
        .agg(F.sum("value_sats").alias("value_sats"), F.count("*").alias("flows"))
    )


def monthly(edges: DataFrame) -> DataFrame:
    return edges.groupBy("origin", F.date_format("first_seen", "yyyy-MM").alias("month")).agg(
        F.sum("value_sats").alias("value_sats"), F.count("*").alias("flows")
    )


def share_of_hop(nodes: DataFrame) -> DataFrame:
    """Each node's share of what the nodes of its depth received."""
    whole = F.sum("total_received_btc").over(Window.partitionBy("origin", "depth"))
    return nodes.select(
        "origin", "address", "depth", F.when(whole > 0, F.col("total_received_btc") / whole).otherwise(F.lit(0.0)).alias("share")
    )


def search_flows(edges: DataFrame, nodes: DataFrame, text: str, sort: str = "value_sats", descending: bool = True) -> DataFrame:
    """Flows with a text in either end or in the recipient's entity, sorted by any column."""
    names = nodes.select("origin", F.col("address").alias("to"), "entity")
    wanted = F.lit(text.lower())
    hit = F.contains(F.lower(F.concat_ws("\n", "from", "to", "entity")), wanted)
    found = edges.join(names, ["origin", "to"], "left").filter(hit)
    return found.orderBy(F.desc(sort) if descending else F.asc(sort), "from", "to")


def paths_to_origin(nodes: DataFrame, hops: int = 25) -> DataFrame:
    """`origin, address, path`: addresses from each node to its origin, by first discovery."""
    parents = staged(nodes.select("origin", "address", "parent"))
    at = parents.select("origin", "address", F.array("address").alias("path"), F.col("parent").alias("next"))
    done = at.filter("next is null")
    at = at.filter("next is not null")
    for _ in range(hops):
        step = parents.select("origin", F.col("address").alias("next"), F.col("parent").alias("_up"))
        at = staged(
            at.join(step, ["origin", "next"]).select("origin", "address", F.concat("path", F.array("next")).alias("path"), F.col("_up").alias("next"))
        )
        done = done.unionByName(at.filter("next is null"))
        at = at.filter("next is not null")
        if at.isEmpty():
            break
    return done.select("origin", "address", "path")


def sheets(graph: Graph, summary: DataFrame) -> dict[str, DataFrame]:
    """The five ordered frames of a report; amounts to 8 places."""
    eight = lambda c: F.round(c, 8).alias(c)
    return {
        "summary": summary.orderBy("origin"),
        "nodes": graph.nodes.select(
            "origin", "address", "level", "side", "entity", "entity_category", eight("total_received_btc"), eight("total_sent_btc"), "same_owner", "is_hub", "truncated"
        ).orderBy("origin", "level", F.desc("total_received_btc"), "address"),
        "flows": graph.edges.select(
            "origin", "from", "to", eight("value_btc"), "tx_count", "first_seen", "last_seen", "confidence", "attribution", "returns_to_owner"
        ).orderBy("origin", F.desc("value_btc"), "from", "to"),
        "incoming": graph.incoming.select(
            "origin", "address", eight("value_btc"), "tx_count", "first_seen", "last_seen", "same_owner", "attribution"
        ).orderBy("origin", F.desc("value_btc"), "address"),
        "related": graph.nodes.filter("same_owner").select("origin", "address").orderBy("origin", "address"),
    }


def payload(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The report's flow rows: amounts to 6 places, times as year and month."""
    names = nodes.select("origin", F.col("address").alias("to"), "entity", "entity_category")
    return edges.join(names, ["origin", "to"], "left").select(
        "origin", "from", "to", "depth", F.round("value_btc", 6).alias("btc"), "tx_count", "confidence", "attribution",
        F.date_format("first_seen", "yyyy-MM").alias("when"), "entity", risk_name(risk_rank(F.col("entity_category"))).alias("risk"),
        F.col("returns_to_owner").alias("loop"),
    )


def write_graph_json(graph: Graph, summary: DataFrame, path: str) -> None:
    for name, frame in (("nodes", graph.nodes), ("edges", graph.edges), ("summary", summary)):
        frame.write.mode("overwrite").json(f"{path}/{name}")


def write_sheets(frames: dict[str, DataFrame], path: str) -> None:
    """One folder of CSV per sheet, in order."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def write_flow_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)
