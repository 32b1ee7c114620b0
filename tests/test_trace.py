"""The level-wise search against a plain breadth-first search with a queue."""

from collections import deque

import pytest
from coinloom.plans import report, trace
from coinloom.plans.trace import Limits
from coinloom.sources.ledger import derive, tag_frame
from pyspark.sql import Window
from pyspark.sql import functions as F


def model(origin, out, into, own, counts, limits, direction):
    nodes, edges = {origin: (0, "origin")}, []
    for side in ["out", "in"] if direction == "both" else [direction]:
        queue, seen = deque([(origin, 0)]), set()
        while queue:
            a, d = queue.popleft()
            if a in seen or d >= limits.depth:
                continue
            seen.add(a)
            if counts.get(a, 0) > limits.hub_outputs and a != origin:
                continue
            for other, value in (out if side == "out" else into).get(a, [])[: limits.fanout]:
                nodes.setdefault(other, (d + 1, side))
                edges.append((side, a, other, d))
                if len(nodes) >= limits.max_nodes:
                    queue.clear()
                    break
                if d + 1 < limits.depth and other not in own:
                    queue.append((other, d + 1))
    return nodes, edges


@pytest.mark.parametrize("direction, limits", [("out", Limits(3, 3, 40, None)), ("both", Limits(2, 4, 750, None)), ("both", Limits(3, 3, 12, None)), ("out", Limits(3, 5, 60, None, 12))])
def test_search_is_breadth_first(spark, small, direction, limits):
    led = derive(spark, small)
    every = led.outs().select("address").distinct()
    out, into = {}, {}
    for frame, into_ in ((trace.outgoing_edges(every, led.io, led.spends, led.tx, None, None), out), (trace.incoming_edges(every, led.io, led.spends, led.tx, None, None), into)):
        for r in frame.orderBy("address", "rank").collect():
            into_.setdefault(r.address, []).append((r.other, r.value_sats))
    counts = {r.address: r.n_outputs for r in trace.output_counts(led.io).collect()}
    origins = [r.address for r in every.orderBy("address").limit(200).collect()][::70]
    frame = spark.createDataFrame([(o,) for o in origins], "origin string")
    graph = trace.build_graph(frame, led.io, led.spends, led.tx, tag_frame(spark, small), limits, direction)
    cluster = {}
    for r in graph.cluster.collect():
        cluster.setdefault(r.origin, set()).add(r.address)
    nodes, edges = graph.nodes.collect(), graph.edges.collect()
    for o in origins:
        want_nodes, want_edges = model(o, out, into, cluster[o], counts, limits, direction)
        assert {r.address: (r.depth, r.side) for r in nodes if r.origin == o} == want_nodes
        got = [(r.dir, r["from"], r["to"], r.depth) if r.dir == "out" else (r.dir, r["to"], r["from"], r.depth) for r in edges if r.origin == o]
        assert sorted(got) == sorted(want_edges)


def test_paths_risk_and_sheets(spark, small, tmp_path):
    led = derive(spark, small)
    frame = led.outs().select("address").distinct().orderBy("address").limit(3).withColumnRenamed("address", "origin")
    graph = trace.build_graph(frame, led.io, led.spends, led.tx, tag_frame(spark, small), Limits(2, 3))
    paths = report.paths_to_origin(graph.nodes).collect()
    assert len(paths) == graph.nodes.count() and all(p.path[0] == p.address and p.path[-1] == p.origin for p in paths)
    kept, inside = report.one_direction(graph.nodes, graph.edges, "out")
    assert kept.count() == len(paths) and inside.count() == graph.edges.count()
    summary = trace.graph_summary(graph)
    sheets = report.sheets(graph, summary)
    report.write_sheets(sheets, str(tmp_path / "sheets"))
    report.write_graph_json(graph, summary, str(tmp_path / "json"))
    report.write_flow_table(report.payload(graph.edges, graph.nodes), str(tmp_path / "flows"))
    assert spark.read.option("header", True).csv(str(tmp_path / "sheets/flows")).count() == graph.edges.count()
    text = graph.edges.first()["to"][:8]
    assert report.search_flows(graph.edges, graph.nodes, text).count() >= 1


def test_size_warning():
    assert trace.size_warning(Limits(3, 10, 750)) and trace.size_warning(Limits(2, 3, 750)) is None


def _busy_origin(spark, n):
    """An origin with n coins, each spent together with a coin of an address of its own."""
    hexed = lambda c: F.sha2(F.col(c).cast("string"), 256)
    k = spark.range(n).select("id", hexed("id").alias("made"), F.sha2(F.concat(F.lit("s"), F.col("id").cast("string")), 256).alias("used"))
    mate = F.concat(F.lit("m"), F.lpad(F.col("id").cast("string"), 6, "0"))
    row = lambda txid, address, kind, idx: k.select(F.col(txid).alias("txid"), address.alias("address"), F.lit("p2pkh").alias("address_type"), (F.col("id") + 5).alias("amount"), F.lit(kind).alias("io_type"), F.lit(idx).alias("idx"))
    o = F.lit("origin")
    io = row("made", o, "out", 0).unionByName(row("used", o, "in", 0)).unionByName(row("used", mate, "in", 1)).unionByName(row("used", F.lit("shop"), "out", 0))
    spends = k.select(F.col("made").alias("prev_txid"), F.lit(0).alias("prev_vout"), F.col("used").alias("spending_txid"), F.lit(0).alias("spending_vin"), F.lit(1).alias("spent_height"))
    tx = io.groupBy("txid").agg(F.sum(F.expr("if(io_type = 'in', amount, 0)")).alias("total_in"), F.sum(F.expr("if(io_type = 'out', amount, 0)")).alias("total_out")).withColumn("received_time", F.lit("2020-01-01").cast("timestamp"))
    return io, spends, tx


def test_caps_of_the_cluster_are_limits(spark):
    io, spends, tx = _busy_origin(spark, 2100)
    origin = spark.createDataFrame([("origin",)], "origin string")
    size = lambda **caps: trace.build_graph(origin, io, spends, tx, None, Limits(1, 5, **caps)).cluster.count()
    assert size() == 2001
    assert size(cluster_txs=None, cluster_addresses=None) == 2101
    assert size(cluster_txs=None, cluster_addresses=7) in (7, 8)


def test_first_rows_in_two_steps(spark):
    """The same rows as one sort; each part of a hot key is sorted for itself."""
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot', cast(id % 50 as string)) as who", "id", "id * 7919 % 1000 as v")
    got = trace.first_rows(rows, "who", [F.desc("v"), "id"], 1500, ["id"])
    nth = F.row_number().over(Window.partitionBy("who").orderBy(F.desc("v"), "id"))
    want = rows.withColumn("n", nth).filter("n <= 1500").drop("n")
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_value_of_a_busy_origin_follows_its_largest_coins(spark):
    io, spends, tx = _busy_origin(spark, 300)
    frontier = spark.createDataFrame([("origin",)], "address string")
    edges = trace.outgoing_edges(frontier, io, spends, tx, None, 100).collect()
    assert [(r.other, r.tx_count) for r in edges] == [("shop", 100)]
