import numpy as np
import pytest
from coinloom.llm import cap_filters


def brute(rows, threshold=0.93):
    ids = [r[0] for r in rows]
    n, links = len(rows), {}
    for i in range(n):
        for j in range(n):
            if i == j or rows[i][1] is None or rows[i][1] != rows[j][1]:
                continue
            a, b = rows[i][2], rows[j][2]
            if any(v is None or any(x is None or not np.isfinite(x) for x in v) or not np.any(v) for v in (a, b)):
                continue
            a, b = np.asarray(a, float), np.asarray(b, float)
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links.setdefault(i, set()).add(j)
    comp = list(range(n))
    for _ in range(n):
        for i, js in links.items():
            comp[i] = min([comp[i], *(comp[j] for j in js)], key=lambda k: ids[k])
    return {ids[i]: (len(links.get(i, ())), ids[comp[i]]) for i in range(n)}


def test_links_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(32)
        for _ in range(25):
            rows.append((len(rows), c % 3, (centre + rng.standard_normal(32) * rng.choice([0.05, 0.2, 0.3, 0.5])).astype("f4").tolist()))
    rows += [(len(rows) + k, 1, rows[4][2]) for k in range(30)]  # equal vectors
    n = len(rows)
    odd = [None, [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, [float("inf")] * 32, []]
    rows += [(n + k, 1, v) for k, v in enumerate(odd)] + [(n + 50, None, rows[0][2]), (n + 51, 0, (np.array(rows[0][2]) * 1e-20).tolist())]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, n_links string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cap_filters.vector_links(df).collect()}
    assert got == brute(rows)


def test_odd_tables(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert cap_filters.vector_links(spark.createDataFrame([], schema)).count() == 0
    got = cap_filters.vector_links(spark.createDataFrame([(None, 1, [1.0, 2.0]), (4, 1, [1.0, 2.0]), (4, 1, [1.0, 2.0])], schema)).collect()
    assert sorted(((r.vec_id or -1), r.n_links, r.kept) for r in got) == [(-1, 0, False), (4, 1, True), (4, 1, True)]


def test_large_bucket_is_split(spark, monkeypatch):
    monkeypatch.setattr(cap_filters, "BLOCK", 16)
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(16)
    rows = [(i, 1, (centre + rng.standard_normal(16) * 0.25).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cap_filters.vector_links(df).collect()}
    assert got == brute(rows)


def test_code_gives_every_vector_directions():
    code = cap_filters.ProductCode.fitted(8, 1000)
    unit = np.eye(8)
    assert all(len(x) >= min(code.least, len(code.first) ** 2) for x in code.decode(unit))


@pytest.mark.parametrize("dim", [16, 64])
def test_links_at_the_threshold_share_a_direction_at_every_size(dim):
    """Pairs at a cosine of exactly 0.93, under the codes of labels of a thousand to a hundred million vectors."""
    rng = np.random.default_rng(5)
    x, y = rng.standard_normal((2, 400, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    for n, least in ((10**3, 399), (10**4, 399), (10**6, 399), (10**8, 399 if dim == 64 else 390)):
        code = cap_filters.ProductCode.fitted(dim, n)
        both = zip(code.decode(x), code.decode(y), strict=True)
        assert sum(bool(np.intersect1d(a, b).size) for a, b in both) >= least, n
