"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinloom.operators.scratch import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    return (
        down.join(low, "a")
        .select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
        .filter("a != b")
        .distinct()
    )


def connected_components(edges: DataFrame, left: str, right: str, max_rounds: int = 50) -> DataFrame:
    """`(node, component)` for every node of an undirected edge list.

    `component` is the smallest node reachable. Rows with a null end and self-links are ignored;
    repeated edges count once. Each round is written to the shared scratch folder, so the plan
    stays short and a lost executor costs one round. No group is ever collected: a node's
    neighbours meet only in `min`, which combines on the map side, and the joins back are ordinary
    equi-joins whose large partitions adaptive execution may split.
    """
    current = staged(
        edges.select(F.col(left).alias("a"), F.col(right).alias("b"))
        .filter("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    mark = None
    for _ in range(max_rounds):
        current = staged(_small_star(_large_star(current)))
        now = current.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast(T.DecimalType(38, 0))).alias("h")
        ).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
