import random
from collections import Counter

from coinloom.operators import forensics
from coinloom.operators.skew import dealt
from pyspark.sql import functions as F


def test_popular_amounts_meet_in_blocks(spark):
    rng = random.Random(11)

    def side(n, mark):
        usual = [(f"{mark}{i}", 5_000 if i % 3 else rng.randint(0, 40_000), rng.randint(0, 4_000)) for i in range(n)]
        return [*usual, *([(f"{mark}none", None, 5), (f"{mark}never", 7, None)])]

    left, right = side(300, "l"), side(200, "r")
    frame = lambda rows: spark.createDataFrame(rows, "id string, sats long, t long").withColumn("ts", F.timestamp_seconds("t"))
    whole = lambda rows: [r for r in rows if None not in r]
    want = sorted(
        (a, b, s - z, u - t) for a, s, t in whole(left) for b, z, u in whole(right) if 0 <= s - z <= 200 and 0 <= u - t <= 900
    )
    for block in (7, 64, 20_000):
        got = forensics.match_amounts(frame(left), frame(right), 200, 900, block)
        assert sorted(map(tuple, got.collect())) == want
    assert forensics.match_amounts(frame(left), frame(right).limit(0), 200, 900, 7).isEmpty()


def test_no_block_holds_a_large_key_whole(spark):
    one = spark.range(4_000).select(F.col("id").alias("a"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    two = spark.range(1_000).select(F.col("id").alias("b"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"))
    a, b = dealt(one, two, ["k"], "a", "b", block=50)
    key = ["k", "_i", "_j"]
    assert max(r["count"] for x in (a, b) for r in x.groupBy(key).count().collect()) < 2 * 50
    pairs = Counter((r.a, r.b) for r in a.join(b, key).select("a", "b").collect())
    assert set(pairs.values()) == {1}
    assert set(pairs) == {(r.a, r.b) for r in one.join(two, "k").select("a", "b").collect()}


def test_a_large_key_of_one_side_is_split_too(spark):
    one = spark.range(2_000).select(F.col("id").alias("a"), F.lit(1).alias("k"))
    two = spark.createDataFrame([(1, 2), (2, None)], "b long, k int")
    a, b = dealt(one, two, ["k"], "a", "b", block=100)
    assert a.count() == 2_000 and a.select("_i").distinct().count() == 20
    assert b.count() == 2 and a.join(b, ["k", "_i", "_j"]).isEmpty()
