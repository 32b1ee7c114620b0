"""Tables that are added to, clusters kept up to date, periods, prices merged in time, and hash trees."""

import datetime
import random
import re

import pytest
from coinloom.operators import coverage, forensics
from coinloom.operators.absent import RangedTable
from pyspark.sql import functions as F

IO = "txid string, address string, address_type string, amount long, io_type string, idx int"


def numbered(spark, low, high, step=1):
    return spark.range(low, high, step).selectExpr("sha2(cast(id as string), 256) as txid", "cast(id % 3 as int) as idx", "id as v")


def test_insert_reads_few_old_rows(spark, tmp_path):
    table = RangedTable.create(numbered(spark, 0, 40_000), str(tmp_path), ["txid", "idx"], rows_per_range=500)
    assert table.ranges == 80
    added, read = table.insert(numbered(spark, 39_995, 40_100))  # five are there
    assert added.count() == 100 and 5 <= len(read) <= 12
    assert table.read().count() == 40_100 and table.read().select("txid").distinct().count() == 40_100
    again, read = table.insert(numbered(spark, 40_000, 40_100))  # the same batch comes again
    assert again.isEmpty() and table.read().count() == 40_100
    part = table.rows().filter(F.col("range").isin(read))
    assert re.search(r"PartitionFilters: \[[^\]]*range#", part._jdf.queryExecution().toString())  # other folders are not opened
    twice = numbered(spark, 50_000, 50_010)
    added, _ = table.insert(twice.unionByName(twice))
    assert added.count() == 10


def test_no_row_is_dropped_though_filters_are_full(spark, tmp_path):
    """Filters far too small say nothing; the exact join still decides."""
    table = RangedTable.create(numbered(spark, 0, 20), str(tmp_path), ["txid", "idx"], rows_per_range=10)
    for k in range(4):
        table.insert(numbered(spark, 300 * k, 300 * k + 400))
    assert sorted(r.v for r in table.read().collect()) == list(range(1300))


def test_an_insert_that_breaks_off_is_done_again(spark, tmp_path, monkeypatch):
    table = RangedTable.create(numbered(spark, 0, 100), str(tmp_path), ["txid", "idx"])
    placed = table._place(numbered(spark, 100, 150))
    placed.groupBy("range", "word").agg(F.bit_or("mask").alias("mask")).write.mode("append").partitionBy("range").parquet(f"{tmp_path}/filters")
    added, read = table.insert(numbered(spark, 100, 150))  # the filters came, the rows did not
    assert added.count() == 50 and read == [0] and table.read().count() == 150


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_by_any_split(spark, seed):
    rng = random.Random(seed)
    rows = [(f"t{t}", f"a{rng.randrange(120):03}", "p2pkh", 1, "in", i) for t in range(110) for i in range(rng.choice([1, 2, 2, 3]))]
    io = spark.createDataFrame(rows, IO)
    whole = sorted(map(tuple, forensics.wallet_clusters(io).collect()))
    names = [f"t{t}" for t in range(110)]
    rng.shuffle(names)
    cuts = [names[:50], names[50:95], names[95:108], names[108:]]
    labels = forensics.wallet_clusters(io.filter(F.col("txid").isin(cuts[0])))
    for part in cuts[1:]:
        before = {r.node: r.component for r in labels.collect()}
        changes = forensics.cluster_changes(labels, io.filter(F.col("txid").isin(part)))
        got = {r.node: r.component for r in changes.collect()}
        assert all(before.get(n) != c for n, c in got.items())  # nothing is written that stays
        labels = forensics.with_changes(labels, changes)
    assert sorted(map(tuple, labels.collect())) == whole


def test_planted_periods(spark):
    day, rng = 86_400, random.Random(4)
    base = 1_600_000_000
    rows = [("daily", base + day * k + rng.randrange(-1800, 1800)) for k in range(40)]
    rows += [("weekly", base + 7 * day * k + rng.randrange(-5 * 3600, 5 * 3600)) for k in range(30)]
    rows += [(f"any{a}", base + rng.randrange(400 * day)) for a in range(30) for _ in range(40)] + [("few", base), (None, base), ("daily", None)]
    events = spark.createDataFrame(rows, "address string, t long").select("address", F.timestamp_seconds("t").alias("ts"))
    score = {(r.address, r.period_s): r.score for r in forensics.periodicity(events).collect()}
    assert score["daily", day] > 35 and score["weekly", 7 * day] > 25 and score["weekly", day] < 25
    assert all(v < 12 for (a, _), v in score.items() if a.startswith("any"))
    assert ("few", day) not in score and ("daily", 7 * day) in score


def test_prices_merged_in_time(spark):
    """A day with minute prices and most of the rows, moments that many rows share, rows before any price or without a time."""
    rng = random.Random(6)
    start = datetime.datetime(2020, 1, 1)
    at = lambda m: start + datetime.timedelta(minutes=m)
    prices = [(at(m), c, k + m, "x") for m in [*range(2000, 3400), 5, 9000, 9000] for k, c in ((0, "USD"), (7, "GBP"))]
    rows = [(k, at(rng.choice([2500, rng.randrange(2000, 3440), rng.randrange(0, 12_000)]))) for k in range(3000)]
    rows += [(k, None) for k in (9001, 9002)] + [(5, rows[5][1])]
    p = spark.createDataFrame(prices, "ts timestamp, currency string, price long, source string").withColumn("price", F.col("price").cast("decimal(18,8)"))
    r = spark.createDataFrame(rows, "id long, when timestamp").withColumn("price", F.lit(None).cast("string")).withColumn("_part", F.lit(1)).drop("price")
    want = sorted(map(tuple, forensics.price_at(r, "when", p, "USD").collect()), key=repr)
    for parts in (1, 7):
        assert sorted(map(tuple, forensics.price_merge(r, "when", p, "USD", parts).collect()), key=repr) == want
    none = forensics.price_merge(r, "when", p.limit(0), "USD").collect()
    assert len(none) == len(rows) and {x.price for x in none} == {None}


def test_one_row_of_many_is_located(spark):
    rows = spark.range(300_000).selectExpr("sha2(cast(id as string), 256) as txid", "id as v")
    other = rows.withColumn("v", F.when(F.col("v") == 77_777, -1).otherwise(F.col("v")))
    a, b = coverage.hash_tree(rows, ["txid"]), coverage.hash_tree(other, ["txid"])
    assert a.count() == 1 + 16 + 256 and len(coverage.differing_leaves(a, b)) == 1
    assert coverage.differing_leaves(a, a) == [] and coverage.differing_rows(rows, rows, ["txid"]).isEmpty()
    found = coverage.differing_rows(rows, other, ["txid"]).collect()
    assert [r.what for r in found] == ["changed"]
    gone = coverage.differing_rows(rows, other.filter("v != -1"), ["txid"]).collect()
    assert [(r.txid, r.what) for r in gone] == [(found[0].txid, "missing")]
    assert {r.what for r in coverage.differing_rows(rows.limit(0), rows.limit(3), ["txid"]).collect()} == {"added"}


def test_an_insert_deals_new_rows_by_key_once(spark, tmp_path, monkeypatch):
    """What does not belong to the rows is not written beside them, and what is written lies by key."""
    table, written = RangedTable.create(numbered(spark, 0, 400, 2), str(tmp_path), ["txid", "idx"], rows_per_range=50), []
    monkeypatch.setattr("coinloom.operators.absent.staged", lambda df: written.append(df) or df.localCheckpoint())
    added, _ = table.insert(numbered(spark, 0, 400))
    (fresh,) = written
    assert added.columns == fresh.columns == ["txid", "idx", "v"] and added.count() == 200
    plan = fresh.hint("merge")._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.split("+- == Initial Plan")[0].splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) <= 1, plan
