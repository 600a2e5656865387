"""Density clustering against a plain version: spanning tree, linkage, condensed tree, choice."""

import math
from collections import defaultdict

import numpy as np
import pytest

from lexivane.operators import density, hierarchy, neighbours, spanning

LEAST = 10


def frame(spark, x, ids=None):
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(ids if ids is not None else range(len(x)), x)]
    return spark.createDataFrame(rows, "doc_id long, embedding array<double>").repartition(3)


def reachability(x, samples):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)).round(9)
    others = np.sort(d + np.diag(np.full(len(x), -1.0)), axis=1)[:, 1:]
    core = others[:, min(samples, len(x) - 1) - 1]
    return np.maximum(d, np.maximum(core[:, None], core[None, :]))


def plain_tree(w):
    """Prim's algorithm."""
    n, inside, best, at = len(w), [0], w[0].copy(), np.zeros(len(w), int)
    best[0], edges = np.inf, []
    while len(inside) < n:
        j = int(best.argmin())
        edges.append((float(best[j]), min(j, int(at[j])), max(j, int(at[j]))))
        inside.append(j)
        closer = w[j] < best
        closer[inside] = False
        best[closer], at[closer] = w[j][closer], j
        best[inside] = np.inf
    return sorted(edges)


def plain_clusters(edges, n, least):
    """(chosen point sets, strength of their points) by recursion over the linkage."""
    node_of, points, made = {i: i for i in range(n)}, {i: [i] for i in range(n)}, {}
    for k, (w, a, b) in enumerate(edges):
        x, y = node_of[a], node_of[b]
        made[n + k], points[n + k] = (w, x, y), points[x] + points[y]
        for p in points[n + k]:
            node_of[p] = n + k
    floor = min((w for w, _, _ in edges if w > 0), default=1.0)
    dens = lambda w: 1 / max(w, floor)

    def walk(top, birth):
        """(stability, children, points with their densities) of the cluster that begins at ``top``."""
        gone, node = [], top
        while True:
            w, x, y = made[node]
            sizes = len(points[x]), len(points[y])
            if min(sizes) >= least:
                kids = [walk(x, dens(w)), walk(y, dens(w))]
                stay = sum(d - birth for _, d in gone) + sum(sizes) * (dens(w) - birth)
                return {"s": stay, "kids": kids, "gone": gone, "top": top, "most": max([dens(w)] + [d for _, d in gone])}
            for side, size in zip((x, y), sizes):
                if size < least:
                    gone += [(p, dens(w)) for p in points[side]]
            if max(sizes) < least:
                return {"s": sum(d - birth for _, d in gone), "kids": [], "gone": gone, "top": top,
                        "most": max(d for _, d in gone)}
            node = x if sizes[0] >= least else y

    def value(c):
        below = sum(value(k) for k in c["kids"])
        c["best"] = c["s"] >= below
        return max(c["s"], below)

    def all_gone(c):
        return c["gone"] + [g for k in c["kids"] for g in all_gone(k)]

    def chosen(c, root):
        if c["best"] and not root:
            return [(sorted(points[c["top"]]), {p: min(1.0, d / c["most"]) for p, d in all_gone(c)})]
        return [f for k in c["kids"] for f in chosen(k, False)]

    if n < max(least, 2):
        return []
    root = walk(2 * n - 2, 0.0)
    value(root)
    return chosen(root, True)


def nested(rng, dims=3):
    """Two tight groups close together, a wide one, a small far one, and noise."""
    parts = [rng.normal(size=(45, dims)) * 0.05, rng.normal(size=(40, dims)) * 0.06 + 0.7,
             rng.normal(size=(90, dims)) * 0.8 + 7, rng.normal(size=(25, dims)) * 0.01 - 6,
             rng.uniform(-10, 12, size=(60, dims))]
    return rng.permutation(np.concatenate(parts))


def groups(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["cluster"]].append(r["doc_id"])
    return sorted(sorted(v) for v in out.values())


@pytest.fixture(scope="module")
def grown(spark):
    """Nested groups with their spanning tree, as found by cells and chunks."""
    x = nested(np.random.default_rng(2))
    tree = spanning.spanning_tree(frame(spark, x), 5, broadcast_bytes=0, chunk_rows=32)
    return x, [(r["weight"], r["a"], r["b"]) for r in tree.collect()]


def test_spanning_tree(spark, grown):
    x, got = grown
    want = plain_tree(reachability(x, 5))
    assert len(got) == len(x) - 1 == 259
    # core distances make equal weights, so the edges may differ but not their weights
    assert sorted(w for w, _, _ in got) == pytest.approx([w for w, _, _ in want], abs=1e-9)
    root = list(range(len(x)))
    for _, a, b in got:  # it is a tree
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        assert a != b
        root[a] = b


def test_search_for_outsiders_writes_no_row_per_point_and_chunk(spark, monkeypatch):
    x, rows, write = nested(np.random.default_rng(3))[:150], [], spanning.durable

    def counted(df):
        rows.append((out := write(df)).count())
        return out

    monkeypatch.setattr(spanning, "durable", counted)
    ids = [f"p{i}" for i in range(len(x))]
    table = frame(spark, x).selectExpr("concat('p', doc_id) AS doc_id", "embedding")
    got = spanning.spanning_tree(table, 5, broadcast_bytes=0, chunk_rows=2).collect()
    want = plain_tree(reachability(x, 5))
    assert sorted(r["weight"] for r in got) == pytest.approx([w for w, _, _ in want], abs=1e-9)
    assert {r[c] for r in got for c in "ab"} == set(ids)
    assert max(rows) <= 5 * len(x)  # the known edges are the largest table


@pytest.mark.parametrize("piece_edges", [100_000, 40])
def test_clusters_of_nested_and_unequal_density(spark, grown, piece_edges):
    x, rows = grown
    want = plain_clusters(sorted(rows), len(x), LEAST)
    table = spark.createDataFrame([(a, b, w) for w, a, b in rows], "a long, b long, weight double")
    points = frame(spark, x).select("doc_id")
    clusters, leaving = hierarchy.condensed_tree(table, points, LEAST, piece_edges=piece_edges)
    report, held = hierarchy.excess_of_mass(clusters, leaving)
    got = held.collect()
    assert groups(got) == sorted(c for c, _ in want)
    strengths = {p: s for _, each in want for p, s in each.items()}
    assert {r["doc_id"]: r["strength"] for r in got} == pytest.approx(strengths)
    assert report.filter("chosen").count() == len(want) >= 4


@pytest.mark.parametrize("piece_edges", [30])
def test_linkage_is_single_linkage(spark, piece_edges):
    x = nested(np.random.default_rng(4))[:120]
    edges = [(w + 1e-6 * i, a, b) for i, (w, a, b) in enumerate(plain_tree(reachability(x, 3)))]
    table = spark.createDataFrame([(a, b, w) for w, a, b in edges], "a long, b long, weight double")
    merges, _ = hierarchy.linkage(table, frame(spark, x), piece_edges=piece_edges)
    got = {r["node"]: r for r in merges.collect()}
    node_of, size = list(range(120)), dict.fromkeys(range(120), 1)
    for k, (w, a, b) in enumerate(edges):
        x_, y_ = node_of[a], node_of[b]
        r = got[120 + k]
        size[120 + k] = size[x_] + size[y_]
        assert {r["left"], r["right"]} == {x_, y_}
        assert r["weight"] == w and r["size"] == size[120 + k]
        node_of = [120 + k if v in (x_, y_) else v for v in node_of]


def test_nested_chain_of_clusters(spark):
    """Groups that join one after the other: a condensed tree that is one long chain."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(12, 2)) * 0.01 + [1.3**k, 0] for k in range(16)])
    got = density.density_hierarchy(frame(spark, x), LEAST, 3)[1].collect()
    want = plain_clusters(plain_tree(reachability(x, 3)), len(x), LEAST)
    assert groups(got) == sorted(c for c, _ in want)
    assert len(want) == 16


def test_topics_with_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([np.tile([[1.0, 2.0]], (60, 1)), rng.normal(size=(30, 2)) * 0.1 + 9, rng.uniform(-9, 0, (20, 2))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(200, None), (201, []), (202, [1.0]), (203, [math.nan, 1.0]), (204, [None, 1.0])]
    df = spark.createDataFrame(rows + odd, "doc_id long, embedding array<double>").repartition(4)
    got = {r["doc_id"]: r["topic"] for r in density.density_clusters(df, LEAST, 5, piece_edges=15).collect()}
    assert len(got) == 115 and {got[i] for i, _ in odd} == {-1}
    assert {got[i] for i in range(60)} == {0} and {got[i] for i in range(60, 90)} == {1}


@pytest.mark.parametrize("n", [0, 4])
def test_too_few_points_are_noise(spark, n):
    df = frame(spark, np.arange(2.0 * n).reshape(n, 2))
    assert [r["topic"] for r in density.density_clusters(df, LEAST, 3).collect()] == [-1] * n


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_outsiders_within_reach(metric, monkeypatch):
    """Pairs beyond the bounds are told by the product alone; what is found is that of all pairs."""
    rng = np.random.default_rng(5)
    m, n = neighbours.metric_of(metric), 600
    x = m.prepare(rng.normal(size=(n, 6)) + 4 * np.eye(6)[rng.integers(0, 6, n)])
    x[400:500] = x[:100]
    comp, core, ids = rng.integers(0, 40, n), rng.random(n) * 0.02, rng.permutation(n)
    w = np.maximum(np.maximum(m.distances(x, x), core[:, None]), core[None, :])
    w[comp[:, None] == comp[None, :]] = np.inf
    measured = []
    monkeypatch.setattr(neighbours.Metric, "distances", lambda self, a, b: measured.append(len(a) * len(b)) or w[:0])
    chord = m.chord(np.sort(w, axis=1)[:, 4])
    seeking = spanning._Seeking.__new__(spanning._Seeking)
    seeking.metric = m
    least, who = seeking._nearest(x, x, chord, comp, comp, core, core, ids)
    by_id = np.argsort(ids)
    first = by_id[w[:, by_id].argmin(1)]
    assert not measured and np.allclose(least, w.min(1), atol=2e-9) and (who == ids[first]).all()


def test_few_points_are_dealt_to_all_tasks(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(400)]
    units = spark.createDataFrame(rows, "uid long, vec array<double>")
    m = neighbours.metric_of("euclidean")
    cells = neighbours.build_cells(units, m, 1, 32)
    blocks, n = neighbours._in_blocks(cells.base.select("uid", "vec", "cell"), cells, m, 10_000, 4, 32)
    assert n == 4 and blocks.select("block").distinct().count() == 4
