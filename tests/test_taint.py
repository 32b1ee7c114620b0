"""Taint to the end of all walks against plain Python on random graphs of coins."""

import random

import pytest
from coinloom.operators import forensics, taint


def graph(seed, n=40):
    """Transactions 0 .. n - 1, each spending coins of earlier ones: inputs, outputs, spends, totals."""
    rng = random.Random(seed)
    free, io, spends, tx = [], [], [], []
    for t in range(n):
        name = f"t{t:03}"
        taken = [free.pop(rng.randrange(len(free))) for _ in range(min(len(free), rng.choice([0, 1, 1, 2, 3])) if t > 4 else 0)]
        for vin, (p, v, amount) in enumerate(taken):
            io.append((name, "a", "p2pkh", amount, "in", vin))
            spends.append((p, v, name, vin, t))
        total_in = sum(a for _, _, a in taken)
        left = total_in or rng.randrange(50, 200)
        outs = []
        for idx in range(rng.randrange(1, 4)):
            amount = max(1, min(left, rng.randrange(1, 120)))
            left -= amount
            outs.append((name, idx, amount))
            if left <= 0:
                break
        for _, idx, amount in outs:
            io.append((name, "a", "p2pkh", amount, "out", idx))
        free += outs
        tx.append((name, total_in))
    return io, spends, tx


def frames(spark, seed):
    io, spends, tx = graph(seed)
    return (
        io, spends, tx,
        spark.createDataFrame(io, "txid string, address string, address_type string, amount long, io_type string, idx int"),
        spark.createDataFrame(spends, "prev_txid string, prev_vout int, spending_txid string, spending_vin int, spent_height int"),
        spark.createDataFrame(tx, "txid string, total_in long"),
    )


def satoshis(io, spends, start, last_first):
    """Coin -> the set of its tainted satoshis, moved one by one; and how many each transaction loses as fee."""
    outs, ins = {}, {}
    for txid, _, _, amount, kind, idx in io:
        (outs if kind == "out" else ins).setdefault(txid, []).append((idx, amount))
    source = {(t, vin): (p, v) for p, v, t, vin, _ in spends}
    bad, lost = {}, {}
    for txid in sorted(outs):
        line = []
        for vin, amount in sorted(ins.get(txid, [])):
            own = bad.get(source[txid, vin], set())
            line += [k in own for k in range(amount)]
        if last_first:
            line.reverse()
        at = 0
        for idx, amount in sorted(outs[txid]):
            coin = (txid, idx)
            bad[coin] = set(range(amount)) if coin in start else {k for k in range(amount) if at + k < len(line) and line[at + k]}
            at += amount
        lost[txid] = sum(line[at:])
    return {c: s for c, s in bad.items() if s}, lost


@pytest.mark.parametrize("last_first", [False, True])
def test_order_over_many_hops(spark, last_first):
    io, spends, _, io_frame, spend_frame, _ = frames(spark, 5 + last_first)
    start = {("t000", 0), ("t003", 0), ("t017", 0)}
    begun = spark.createDataFrame(sorted(start), "txid string, idx int")
    rows = taint.ordered_intervals(begun, io_frame, spend_frame, last_first).collect()
    want, lost = satoshis(io, spends, start, last_first)
    got = {}
    for r in rows:
        got.setdefault((r.txid, r.idx), []).append((r.lo, r.hi))
    assert {c: {k for lo, hi in v for k in range(lo, hi)} for c, v in got.items() if any(hi > lo for lo, hi in v)} == want
    for v in got.values():  # stretches that touch are one
        v.sort()
        assert all(a[1] < b[0] for a, b in zip(v, v[1:], strict=False))
    layers = {}
    for r in rows:
        layers.setdefault((r.txid, r.idx), set()).add(r.layer)
    assert all(len(v) == 1 for v in layers.values()) and max(map(max, layers.values())) >= 6
    # What goes into the transactions of a layer comes out of them or is lost as fee; start coins bring their own.
    held = {c: sum(hi - lo for lo, hi in v) for c, v in got.items()}
    layer_of = {c[0]: min(v) for c, v in layers.items()}
    for k in range(1, max(map(max, layers.values())) + 1):
        these = {t for t, n in layer_of.items() if n == k}
        fed = sum(held.get((p, v), 0) for p, v, t, _, _ in spends if t in these)
        out = sum(n for c, n in held.items() if c[0] in these and c not in start)
        gone = sum(lost[t] for t in these)
        own = {c for c in start if c[0] in these}
        covered = 0
        if own:  # satoshis that would have gone to start coins anyway
            plain, _ = satoshis([r for r in io], spends, start - own, last_first)
            covered = sum(len(plain.get(c, ())) for c in own)
        assert fed == out + gone + covered


def test_haircut_settles_each_coin_once(spark):
    io, spends, tx, io_frame, spend_frame, tx_frame = frames(spark, 9)
    start = {("t000", 0), ("t001", 0), ("t016", 0)}
    begun = spark.createDataFrame(sorted(start), "txid string, idx int")
    got = {(r.txid, r.idx): r.tainted_milli for r in taint.haircut_totals(begun, io_frame, spend_frame, tx_frame).collect()}
    outs = {(r[0], r[5]): r[3] for r in io if r[4] == "out"}
    total, source = dict(tx), {}
    for p, v, t, _, _ in spends:
        source.setdefault(t, []).append((p, v))
    want = {}
    for coin in sorted(outs):
        fed = [want[s] for s in source.get(coin[0], []) if s in want]
        if fed or coin in start:
            share = outs[coin] * sum(fed) // total[coin[0]] if fed else 0
            want[coin] = share + (outs[coin] * 1000 if coin in start else 0)
    assert got == want
    sums = {}
    hops = 0
    for r in forensics.haircut_taint(begun, io_frame, spend_frame, tx_frame).collect():
        sums[r.txid, r.idx] = sums.get((r.txid, r.idx), 0) + r.tainted_milli
        hops = max(hops, r.hop)
    assert hops >= 6 and sums.keys() == got.keys()
    assert all(0 <= got[c] - sums[c] <= 20 * (hops + 1) for c in got)


def test_nothing_to_follow(spark):
    _, _, _, io_frame, spend_frame, tx_frame = frames(spark, 2)
    none = spark.createDataFrame([], "txid string, idx int")
    assert taint.ordered_totals(none, io_frame, spend_frame).collect() == []
    assert taint.haircut_totals(none, io_frame, spend_frame, tx_frame).collect() == []
