import random

import pytest
from coinloom.operators import balances, coverage, forensics, upsert
from coinloom.operators.components import connected_components
from coinloom.sources import schemas as S
from coinloom.sources import tags
from coinloom.sources.ledger import derive, status_frame, tag_frame, watch_frame


def plain(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_upsert_rules(spark):
    old = spark.createDataFrame([("a", "h", 1, None, 10, 20), ("b", "h", 1, None, 7, 8)], S.TRANSACTIONS)
    new = spark.createDataFrame([("a", "other", 9, None, 0, 21), ("b", "h", 1, None, 5, 6), ("c", "h", 2, None, None, 1)], S.TRANSACTIONS)
    want = [("a", "h", 10, 21), ("b", "h", 5, 6), ("c", "h", None, 1)]
    assert plain(upsert.upsert_transactions(old, new), "txid", "block_hash", "total_in", "total_out") == want
    kept = upsert.upsert_transactions(old, new, keep=True)
    assert plain(kept, "txid", "total_in", "total_out")[:2] == [("a", 10, 20), ("b", 7, 8)]


def test_upsert_twice_changes_nothing(spark, small):
    led = derive(spark, small)
    once = upsert.insert_spends(led.spends, led.spends)
    assert coverage.manifest({"s": once}).first() == coverage.manifest({"s": led.spends}).first()


def test_tags(spark):
    none = spark.createDataFrame([], S.ENTITY_TAGS)
    one = upsert.add_tag(spark, none, "1a", "Name", "mixer")
    two = upsert.add_tag(spark, one, "1a", "New name", "scam", confidence=0.9)
    assert plain(two, "address", "entity_name", "confidence") == [("1a", "New name", 0.9)]
    assert upsert.remove_tags(two, "1a", "user").count() == 0 and upsert.remove_tags(two, "1a", "x").count() == 1
    with pytest.raises(ValueError):
        upsert.add_tag(spark, none, "1a", "Name", "nonsense")
    blank = spark.createDataFrame([(" ", "s", "n", "c", 1.0, None), (None, "s", "n", "c", 1.0, None)], S.ENTITY_TAGS)
    assert upsert.upsert_tags(none, blank).count() == 0


def test_tag_files(spark, tmp_path):
    (tmp_path / "b.csv").write_text("address,entity_name,category,confidence,reference\n# remark\n1a,N,exchange,,r\n1b,M,mixer,0,r\n")
    assert plain(tags.read_bundled_csv(spark, str(tmp_path / "b.csv")), "address", "confidence") == [("1a", 0.7), ("1b", 0.0)]
    (tmp_path / "g").mkdir()
    (tmp_path / "g/1.csv").write_text("Address,name\n1a, Some ,\naddress,odd,x\n ,n,c\n")
    (tmp_path / "g/2.csv").write_text("1c\n")
    got = plain(tags.read_generic_csv(spark, str(tmp_path / "g"), "src", "scam"), "address", "entity_name", "category")
    assert got == [("1a", "Some", "scam"), ("1c", "src", "scam"), ("address", "odd", "x")]
    (tmp_path / "s.xml").write_text(
        "<list><sdnEntry><lastName>DOE</lastName><firstName>Jo</firstName><programList><program>B</program><program>A</program></programList>"
        "<idList><id><idType>Digital Currency Address - XBT</idType><idNumber> 1x </idNumber></id><id><idType>Passport</idType><idNumber>9</idNumber></id></idList>"
        "<remarks>also Digital Currency Address - ETH 0xabc; Digital Currency Address - XBT 1x</remarks></sdnEntry>"
        "<sdnEntry><lastName>ACME</lastName><remarks>Digital Currency Address - XBT 1y</remarks></sdnEntry></list>"
    )
    found = tags.read_sanctions_xml(spark, str(tmp_path / "s.xml"))
    assert plain(found, "address", "currency", "name", "program") == [("0xabc", "ETH", "DOE Jo", "A, B"), ("1x", "XBT", "DOE Jo", "A, B"), ("1y", "XBT", "ACME", "")]
    assert plain(tags.sanction_tags(found), "address", "entity_name") == [("1x", "DOE Jo [A, B]"), ("1y", "ACME")]
    assert tags.sanction_tags(found, all_currencies=True).count() == 3


def test_list_tags_takes_text_literally(spark, small):
    t = tag_frame(spark, small)
    assert tags.list_tags(t, search="%").count() == 0
    assert tags.list_tags(t, search="ENTITY").count() == min(50, t.filter("source = 'alpha'").count())


def test_balance_invariants(spark, small):
    led = derive(spark, small)
    b = balances.build_balances(led.io, led.spends)
    assert b.filter("total_received_sats != balance_sats + total_spent_sats").count() == 0
    free = balances.unspent(led.io, led.spends).agg({"amount": "sum"}).first()[0]
    assert balances.balance_summary(b).first().total_sats == free


def test_clamped_deltas_as_a_loop(spark):
    rng = random.Random(4)
    steps = [(h, f"a{k}", rng.randint(-9, 9), rng.randint(-2, 2), 1, f"t{h}") for h in range(40) for k in range(5) if rng.random() < 0.7]
    deltas = spark.createDataFrame(steps, "height int, address string, delta_sats long, delta_utxos long, delta_txs long, rep_txid string")
    watch = spark.createDataFrame([(f"a{k}", None, None, None, None, None, 0, 1, 3, None, None, None) for k in range(5)], S.WATCH)
    blocks = spark.createDataFrame([(h, "h", None) for h in range(40)], S.BLOCKS)
    state = {f"a{k}": [3, 1] for k in range(5)}
    for _, a, d, u, _, _ in steps:
        state[a] = [max(0, state[a][0] + d), max(0, state[a][1] + u)]
    for stretch in (1, 3, 1_024):
        got = balances.apply_deltas(watch, deltas, blocks, stretch=stretch).collect()
        assert {r.address: [r.balance_sats, r.utxo_count] for r in got} == state
        assert all((r.last_scanned_txid, r.tx_count) == (max((s for s in steps if s[1] == r.address))[5], sum(s[1] == r.address for s in steps)) for r in got)


def test_untouched_watch_rows_stay(spark, small):
    led = derive(spark, small)
    row = ("nobody", "p2pkh", "l", ["t"], None, None, 3, 4, 5, None, None, None)
    watch = watch_frame(spark, small).unionByName(spark.createDataFrame([row], S.WATCH))
    got = balances.recompute_watch(watch, led.io, led.spends, led.tx).filter("address = 'nobody'").first()
    assert (got.tx_count, got.utxo_count, got.balance_sats) == (3, 4, 5)


def test_reprocess_selection(spark, small):
    status = status_frame(derive(spark, small))
    with pytest.raises(ValueError):
        coverage.select_for_reprocess(status, "vout")
    with pytest.raises(ValueError):
        coverage.select_for_reprocess(status, "vout", features=["odd"])
    got = coverage.select_for_reprocess(status, "vout", 0, 50)
    assert got.filter("height <= 50 and vout_status not in ('pending')").count() == 0


def test_stale_and_top_up(spark, small):
    led = derive(spark, small)
    status = status_frame(led)
    assert coverage.stale(status, "2030-01-01").count() == status.filter("address_status = 'in_progress'").count() > 0
    more = coverage.top_up(status, led.tip + 4)
    assert more.count() == status.count() + 4 and coverage.missing_heights(more, led.tip + 4).count() == 0


def test_manifest_verdicts(spark, small, tmp_path):
    led = derive(spark, small)
    stored = coverage.manifest({"a": led.tx, "b": led.io, "c": led.spends, "d": led.tx})
    found = coverage.manifest({"a": led.tx, "b": led.io.limit(5), "c": led.spends.withColumn("spent_height", led.spends.spent_height + 1)})
    verdicts = dict(plain(coverage.verify_manifest(stored, found), "table", "verdict"))
    assert verdicts == {"a": "ok", "b": "size mismatch", "c": "checksum mismatch", "d": "missing"}
    path = upsert.replace_table(led.tx, str(tmp_path), "tx", "1")
    files = coverage.file_checksums(spark, path)
    assert files.filter("path like '%.parquet'").count() >= 1


def test_components_against_union_find(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    want = {x: find(x) for x in {y for e in edges if e[0] != e[1] for y in e}}
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    assert got == want
    assert connected_components(df.limit(0), "a", "b").count() == 0


def test_wallet_clusters(spark):
    rows = [("t1", "b", "x", 1, "in", 0), ("t1", "a", "x", 1, "in", 1), ("t2", "b", "x", 1, "in", 0), ("t2", "c", "x", 1, "in", 1), ("t3", "z", "x", 1, "in", 0)]
    io = spark.createDataFrame(rows, S.TX_IO)
    assert plain(forensics.wallet_clusters(io), "node", "component") == [("a", "a"), ("b", "a"), ("c", "a")]


def test_chains_longer_than_any_cap(spark):
    """A chain of 70 transactions, and a circle, which is refused."""
    io = [(f"t{k}", f"a{k}", "x", 9, "out", 0) for k in range(70)] + [(f"t{k}", f"b{k}", "x", 1, "out", 1) for k in range(70)]
    io += [("u", "z", "x", 9, "out", 0), ("u", "y", "x", 9, "out", 1)]
    spends = [(f"t{k}", 0, f"t{k + 1}", 0, k, "h", None) for k in range(69)]
    io, edges = spark.createDataFrame(io, S.TX_IO), spark.createDataFrame(spends, S.SPENDS)
    got = {r.txid: r.length for r in forensics.peel_chains(io, edges).collect()}
    assert got == {f"t{k}": 70 - k for k in range(70)}
    circle = edges.unionByName(spark.createDataFrame([("t69", 0, "t0", 0, 70, "h", None)], S.SPENDS))
    with pytest.raises(RuntimeError):
        forensics.peel_chains(io, circle, max_rounds=3)


def test_prices_inside_a_day(spark, tmp_path):
    from coinloom.sources.tags import read_prices

    (tmp_path / "p.csv").write_text("ts,currency,price,source\n# remark\n2020-01-02 10:00:00,USD,5,x\n2020-01-02 12:00:00,USD,6,x\n2020-01-04 00:00:00,USD,7.5,x\n2020-01-02 11:00:00,GBP,99,x\n")
    prices = read_prices(spark, str(tmp_path / "p.csv"))
    times = ["2020-01-01 23:00:00", "2020-01-02 09:59:59", "2020-01-02 10:00:00", "2020-01-02 11:59:59", "2020-01-02 12:00:00", "2020-01-03 05:00:00", "2020-01-04 00:00:00", "2021-05-01 00:00:00"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(times)] + [(8, None)], "i int, s string").selectExpr("i", "cast(s as timestamp) as t")
    got = {r.i: None if r.price is None else float(r.price) for r in forensics.price_at(rows, "t", prices, "USD").collect()}
    assert got == {0: None, 1: None, 2: 5, 3: 5, 4: 6, 5: 6, 6: 7.5, 7: 7.5, 8: None}


def test_last_in_first_out(spark):
    io = spark.createDataFrame(
        [("t", "a", "x", 5, "in", 0), ("t", "b", "x", 3, "in", 1), ("t", "c", "x", 4, "out", 0), ("t", "d", "x", 4, "out", 1)], S.TX_IO
    )
    spends = spark.createDataFrame([("p", 0, "t", 0, 1, "h", None), ("q", 0, "t", 1, 1, "h", None)], S.SPENDS)
    bad = spark.createDataFrame([("q", 0)], "txid string, idx int")
    assert plain(forensics.ordered_taint(bad, io, spends), "idx", "tainted") == [(1, 3)]
    assert plain(forensics.ordered_taint(bad, io, spends, last_first=True), "idx", "tainted") == [(0, 3)]
