"""Whitening and search over embeddings, against plain numpy over all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from commitpost.llm import topk, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def random_rows(n, dim, seed=0, spread=None):
    rng = np.random.default_rng(seed)
    values = rng.standard_normal((n, dim)) * (np.ones(dim) if spread is None else spread)
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(values)]


def by_numpy(rows, k):
    x = np.floor(1024 * np.array([v for _, v in rows], float)) + 100_000
    mean = x.mean(axis=0)
    covariance = (x - mean).T @ (x - mean) / len(x)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    deviations = [sum((len(x) * int(c) - int(s)) ** 2 for c, s in zip(row, x.sum(axis=0))) for row in x]
    return values, vectors, (x - mean) @ vectors / np.sqrt(values), deviations, np.trace(covariance)


def test_rows_equal_plain_numpy(spark):
    rows = random_rows(700, 12, spread=np.linspace(0.5, 3, 12))
    got = whitening.whitened(frame(spark, rows).repartition(5)).collect()
    values, _, white, deviations, trace = by_numpy(rows, 8)
    assert len(got) == 700 * 8
    table = np.zeros((700, 8))
    for r in got:
        table[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["n"] == 700 and r["deviation"] == deviations[r["vec_id"]]
        assert math.isclose(r["explained"], values[r["component"] - 1] / trace, rel_tol=1e-12)
        assert r["identity_error"] < 1e-9
    signs = np.sign((table * white).sum(axis=0))
    assert np.abs(table - white * signs).max() < 1e-9


def test_result_does_not_depend_on_the_layout(spark):
    df = frame(spark, random_rows(300, 9, 3))
    one, many = (whitening.fit(df.repartition(n)) for n in (1, 40))
    assert (one.components == many.components).all() and (one.eigenvalues == many.eigenvalues).all()


@pytest.mark.parametrize("kind", ["random", "repeated", "diagonal", "blocks", "rank one", "zero", "tiny gaps", "graded"])
def test_eigenvectors(kind):
    rng = np.random.default_rng(5)
    n = 40
    basis = np.linalg.qr(rng.standard_normal((n, n)))[0]
    spectrum = {
        "random": rng.random(n), "repeated": np.repeat([3.0, 1.0], n // 2), "zero": np.zeros(n),
        "tiny gaps": 1 + 1e-13 * np.arange(n), "graded": 10.0 ** -np.arange(n),
    }
    if kind in spectrum:
        a = basis @ np.diag(spectrum[kind]) @ basis.T
    elif kind == "diagonal":
        a = np.diag(np.repeat([5.0, 4.0, 4.0, 1.0], n // 4))
    elif kind == "blocks":
        block = np.array([[2.0, 1.0], [1.0, 2.0]])
        a = np.kron(np.eye(n // 2), block)
    else:
        v = rng.standard_normal(n)
        a = np.outer(v, v)
    a = (a + a.T) / 2
    values, vectors = whitening.principal(a, 8)
    norm = max(1e-300, np.abs(a).max())
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:8]).max() < 1e-12 * norm
    assert np.abs(vectors @ vectors.T - np.eye(8)).max() < 1e-10
    assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-11 * norm


def test_sturm_counts():
    rng = np.random.default_rng(1)
    d, e = rng.standard_normal(30), rng.standard_normal(29)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-4, 4, 50)
    assert whitening.above(d, e, at).tolist() == [(values > x).sum() for x in at]


def odd_rows():
    vectors = random_rows(60, 4, 9)
    return vectors + [
        (100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, math.nan, 0.0, 0.0]), (103, [math.inf, 0.0, 0.0, 0.0]),
        (104, []), (105, [1.0, 2.0]), (None, [0.5, 0.25, 0.125, 2.0]), (7, vectors[7][1]), (7, vectors[7][1]),
    ]


def test_odd_rows_take_no_part(spark):
    df = frame(spark, odd_rows()).select("*", F.lit(1).alias("n"), F.lit("x").alias("place"), F.lit("y").alias("whitened"))
    got = whitening.whitened(df).collect()
    used = [(i, v) for i, v in odd_rows() if v and len(v) == 4 and None not in v and np.isfinite(v).all()]
    assert len(got) == len(used) * 4 and {r["vec_id"] for r in got} == {i for i, _ in used} and {r["n"] for r in got} == {63}
    values, _, _, _, trace = by_numpy(used, 4)
    shares = {r["component"]: r["explained"] for r in got}
    assert np.allclose([shares[k] for k in (1, 2, 3, 4)], values / trace)


def test_empty_and_single(spark):
    df = frame(spark, [(1, [0.5, 0.5])])
    assert whitening.whitened(df.where("1 = 0")).count() == 0
    assert whitening.whitened(frame(spark, [(1, None)])).count() == 0
    got = whitening.whitened(df).collect()
    assert [(r["component"], r["whitened"], r["deviation"], r["explained"], r["identity_error"]) for r in got] == [(1, 0, 0, 0, 0), (2, 0, 0, 0, 0)]
    assert whitening.whitened(frame(spark, [(1, []), (2, [])])).count() == 0


def test_directions_without_variance(spark):
    rows = [(i, [float(i % 5), float(i % 5) * 2, 1.0]) for i in range(50)]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert all(r["whitened"] == 0 for r in got if r["component"] > 1) and max(r["identity_error"] for r in got) < 1e-9


def test_large_components_stay_exact(spark):
    rows = [(i, [60_000.0 - i, float(i * i), -50_000.0]) for i in range(90)]
    got = whitening.whitened(frame(spark, rows)).collect()
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((90 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r["vec_id"]: r["deviation"] for r in got} == want


# ---- search -------------------------------------------------------------------


def usable(rows):
    return [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]


def by_all_pairs(rows, k, every):
    out = []
    points = usable(rows)
    for n, (i, q) in enumerate(points):
        if i % every == 0:
            others = [(-sum(a * b for a, b in zip(q, p)), j) for m, (j, p) in enumerate(points) if m != n and len(p) == len(q)]
            out += [(i, rank, j, -less) for rank, (less, j) in enumerate(sorted(others)[:k], 1)]
    return sorted(out)


def found(df, k=5, every=50):
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % every == 0, k).collect()))


def clustered(n, dim, seed=0, clusters=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim))
    values = centres[rng.integers(0, clusters, n)] + rng.standard_normal((n, dim)) * 0.02
    return [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(values)]


@pytest.mark.parametrize("kind", ["random", "clustered", "copies", "ties"])
def test_search_equals_all_pairs(spark, monkeypatch, kind):
    for name, value in {"SHARD": 150, "GROUP": 20, "BLOCK": 4, "SAMPLE": 100, "LEAF": 16, "QUERY_LEAF": 4}.items():
        monkeypatch.setattr(topk, name, value)
    rows = random_rows(900, 6, 4) if kind == "random" else clustered(900, 6, 4)
    if kind == "copies":
        rows = [(i, rows[i % 7 if i % 3 == 0 else i][1]) for i, _ in rows]
    if kind == "ties":
        rows = [(i, [float(round(c)) for c in v]) for i, v in rows]
    assert found(frame(spark, rows).repartition(4), every=10) == by_all_pairs(rows, 5, 10)


def test_odd_rows(spark):
    rows = random_rows(40, 3, 8)
    rows += [
        (50, None), (60, [1.0, None, 0.0]), (70, [math.nan, 0.0, 0.0]), (80, [math.inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]),
        (90, []), (91, []), (100, [1.0, 2.0]), (110, [2.0, 1.0]), (120, [0.0]), (10, rows[10][1]), (10, rows[10][1]), (20, [9.0, 9.0, 9.0]),
    ]
    df = frame(spark, rows).select("*", F.lit("x").alias("key"), F.lit(1).alias("wanted"), F.lit(2).alias("rank"))
    assert found(df, every=10) == by_all_pairs(rows, 5, 10)
    assert found(df.where("1 = 0")) == [] and found(frame(spark, [(0, [1.0])])) == [] and found(frame(spark, [(1, [1.0])])) == []


def test_scores_are_exact(spark):
    rows = [(i, [60_000.0 - i * 0.25, -59_999.75 + i, 31_000.5]) for i in range(60)]
    assert found(frame(spark, rows), every=20) == by_all_pairs(rows, 5, 20)


def test_cover_tree():
    points = np.floor(256 * np.array([v for _, v in clustered(3000, 5)]))
    tree = topk.cover_tree(points)
    assert sorted(tree.order) == list(range(3000)) and (tree.points == points[tree.order]).all()
    for n in range(len(tree.start)):
        inside = tree.points[tree.start[n] : tree.end[n]]
        middle = tree.points[tree.centre[n]]
        assert topk.distances(inside, middle).max() == tree.radius[n]
        children = range(tree.child[n], tree.child[n] + tree.children[n])
        if tree.children[n]:
            assert tree.start[children[0]] == tree.start[n] and tree.end[children[-1]] == tree.end[n]
            middles = [tree.points[tree.centre[c]] for c in children]
            for a, one in enumerate(middles):
                assert all(topk.distances(one[None], two)[0] > tree.radius[n] / 2 for two in middles[a + 1 :])
    assert (tree.children > 0).any()


def test_pairs_of_nodes_are_pruned():
    points = np.floor(256 * np.array([v for _, v in clustered(4000, 5, clusters=30)]))
    rows, queries = topk.cover_tree(points), topk.cover_tree(points[::40], topk.QUERY_LEAF)
    best = topk.Best(queries, topk.least_scores(queries.points, points[:500], 6), 6)
    compared = sum(
        int((rows.end[others] - rows.start[others]).sum()) * int(queries.end[leaf] - queries.start[leaf])
        for leaf, others in topk.descend(queries, rows, best.worst)
    )
    assert compared < 0.5 * len(points) * 100
    counts = np.ones(len(points), np.int64)
    topk.search_tree(best, rows, rows.order, np.concatenate([[0], np.cumsum(counts)]))
    scores = topk.products(queries.points, rows.points)
    sixth = np.sort(scores, axis=1)[:, -6]
    assert [s for _, s in sorted(zip(best.query, best.score)) if s >= 0] and (np.sort(best.score.reshape(-1, 6), axis=1)[:, 0] == sixth).all()
