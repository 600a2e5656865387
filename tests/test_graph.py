"""Approximate neighbours and the spectral embedding: recall, residuals, plain eigenvectors."""

import math

import numpy as np
import pytest

from lexivane.operators import forest, neighbours, reduce, spectral


def frame(spark, x, first=0):
    rows = [(first + i, [float(c) for c in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "doc_id long, embedding array<double>").repartition(3)


def winding(rng, n):
    """A closed curve that winds through twelve dimensions: any plane folds it onto itself."""
    t = np.sort(rng.uniform(0, 2 * np.pi, n))
    return np.concatenate([f(t[:, None] * k) / np.sqrt(k) for k in [np.arange(3, 9)] for f in (np.cos, np.sin)], axis=1)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_recall_and_distances(spark, metric):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 16)) + 3 * rng.normal(size=(30, 16))[rng.integers(0, 30, 900)]
    df = frame(spark, x)
    found = forest.approximate_knn(df, 10, metric, trees=4, block_rows=40, rounds=2).cache()
    exact = neighbours.knn(df, df, 10, metric, exclude_self=True).cache()
    assert found.count() == 9000
    assert forest.recall(found, exact).first()["recall"] >= 0.9
    # every distance is the true one, and ranks are in order
    true = {(r.id, r.neighbour): r.distance for r in neighbours.knn(df, df, 899, metric, exclude_self=True).collect()}
    rows = found.collect()
    assert all(abs(true[r.id, r.neighbour] - r.distance) < 2e-9 for r in rows)
    by = {}
    for r in sorted(rows, key=lambda r: (r.id, r["rank"])):
        by.setdefault(r.id, []).append((r.distance, r.neighbour))
    assert all(v == sorted(v) and len({n for _, n in v}) == 10 for v in by.values())


def test_descent_raises_recall(spark):
    rng = np.random.default_rng(2)
    df = frame(spark, rng.normal(size=(700, 8)))
    exact = neighbours.knn(df, df, 8, exclude_self=True).cache()
    shares = [
        forest.recall(forest.approximate_knn(df, 8, trees=2, block_rows=32, rounds=r), exact).first()["recall"]
        for r in (0, 2)
    ]
    assert shares[0] < 0.8 < shares[1]


def test_search_with_copies_and_unusable_rows(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([np.tile(rng.normal(size=(1, 4)), (80, 1)), rng.normal(size=(60, 4))])
    odd = spark.createDataFrame(
        [(900, None), (901, []), (902, [1.0]), (903, [math.nan] * 4), (904, [0.0] * 4)], "doc_id long, embedding array<double>"
    )
    df = frame(spark, x).unionByName(odd)
    found = {(r.id, r["rank"]): (r.neighbour, r.distance) for r in forest.approximate_knn(df, 5, trees=3, block_rows=16).collect()}
    assert {i for i, _ in found} == set(range(140))
    assert all(found[i, 1][1] == 0 for i in range(80))
    assert [found[50, k][0] for k in range(1, 6)] == [0, 1, 2, 3, 4] and found[0, 1][0] == 1


@pytest.mark.parametrize("n", [0, 1, 3])
def test_search_in_little(spark, n):
    found = forest.approximate_knn(frame(spark, np.eye(4)[:n] + 1), 5)
    assert found.count() == n * (n - 1)


def test_trees_halve_their_sample():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1024, 6))
    leaf, _ = forest._grow(x, 4, [7, 0]).place(x)
    assert np.bincount(leaf, minlength=16).min() >= 60
    deep, _ = forest._grow(x[:64], 9, [7, 0]).place(x)
    assert len(np.unique(deep)) > 200  # nine levels, though a sample of 64 fills three


# --- spectral embedding ----------------------------------------------------------------


def dense(rows, n):
    w = np.zeros((n, n))
    for r in rows:
        w[r.src, r.dst] = w[r.dst, r.src] = r.weight
    d = w.sum(1)
    return w / np.sqrt(d[:, None] * d[None, :]), d


def test_against_dense_eigenvectors(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 6)) + 4 * np.eye(6)[rng.integers(0, 5, 150)]  # five groups: four axes tell them apart
    df = frame(spark, x)
    graph = neighbours.neighbour_graph(neighbours.knn(df, df, 10, exclude_self=True), 10).cache()
    got = spectral.spectral_embedding(graph, 4, tolerance=1e-5)
    a, d = dense(graph.collect(), 150)
    values, vectors = np.linalg.eigh(a)
    assert got.eigenvalues == pytest.approx(values[::-1][1:5].tolist(), abs=1e-6)
    assert max(got.residuals) < 1e-5
    y = np.zeros((150, 4))
    for r in got.rows.collect():
        y[r.id] = r.axes
    want = vectors[:, ::-1][:, 1:5] / np.sqrt(d)[:, None] * np.sqrt(d.sum())
    for i in range(4):
        sign = np.sign(want[:, i] @ (d * y[:, i]))
        assert y[:, i] == pytest.approx(sign * want[:, i], abs=1e-3)
        assert y[np.abs(y[:, i]).argmax(), i] > 0


def test_keeps_more_neighbours_than_a_plane(spark):
    df = frame(spark, winding(np.random.default_rng(6), 300))
    rows, found = spectral.graph_coordinates(df, 2, 10, "euclidean")
    assert max(found.residuals) < spectral.TOLERANCE
    flat = reduce.project(df, reduce.fit_projection(df, 2), out="axes").select("doc_id", "axes")
    kept = spectral.neighbours_kept(df, rows, 10, "euclidean")
    assert kept > 0.9 and kept > 1.2 * spectral.neighbours_kept(df, flat, 10, "euclidean")


def test_components_copies_and_odd_rows(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=(40, 3)) * 0.1 + [5, 0, 0], rng.normal(size=(40, 3)) * 0.1 + [0, 5, 0],
                        np.tile([[5.0, 0.1, 0.1]], (50, 1))])
    df = frame(spark, x).unionByName(spark.createDataFrame([(500, None), (501, [1.0])], "doc_id long, embedding array<double>"))
    placed = {r.doc_id: r for r in spectral.with_graph_coordinates(df, 2, neighbours=5).collect()}
    assert set(placed) == set(range(130))
    assert len({placed[i].proj_x for i in range(80, 130)}) == 1
    left, right = [placed[i].proj_x for i in range(40)], [placed[i].proj_x for i in range(40, 80)]
    assert max(left) < min(right) or max(right) < min(left)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_embedding_of_little(spark, n):
    rows, found = spectral.graph_coordinates(frame(spark, np.eye(4)[:n] + 1), 3)
    assert rows.count() == (n if n > 1 else 0) and all(len(r.axes) == min(3, n - 1) for r in rows.collect())
