"""The merge tree against merging one pair after the other."""

import numpy as np
import pytest

from lexivane.operators import agglomerate


def plain(d, linkage):
    n = len(d)
    d = {(i, j): float(d[i, j]) for i in range(n) for j in range(n) if i != j}
    size, name, out = dict.fromkeys(range(n), 1), {i: i for i in range(n)}, []
    while len(size) > 1:
        a, b = min(((i, j) for i, j in d if i < j), key=lambda p: (d[p], p))
        ab = d[a, b]
        for c in list(size):
            if c in (a, b):
                continue
            x, y, na, nb, nc = d[a, c], d[b, c], size[a], size[b], size[c]
            new = {
                "single": min(x, y), "complete": max(x, y), "average": (na * x + nb * y) / (na + nb),
                "ward": np.sqrt(max(0, ((na + nc) * x * x + (nb + nc) * y * y - nc * ab * ab) / (na + nb + nc))),
            }[linkage]
            d[a, c] = d[c, a] = new
        d = {p: v for p, v in d.items() if b not in p}
        size[a] += size.pop(b)
        out.append((len(out), name[a], name[b], ab, size[a]))
        name[a] = n + len(out) - 1
    return out


@pytest.mark.parametrize("linkage", ["ward", "average"])
def test_merge_tree(spark, linkage):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(14, 5)) + 3 * rng.normal(size=(4, 5))[rng.integers(0, 4, 14)]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    names = [3 * i + 1 for i in range(14)]
    rows = [(names[i], names[j], float(d[i, j])) for i in range(14) for j in range(i + 1, 14)]
    pairs = spark.createDataFrame(rows, "a long, b long, distance double").repartition(3)
    got = sorted(tuple(r) for r in agglomerate.merge_tree(pairs, linkage).collect())
    want = plain(d, linkage)
    assert [(s, l, r, n) for s, l, r, _, n in got] == [(s, l, r, n) for s, l, r, _, n in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_little(spark):
    schema = "a long, b long, distance double"
    assert agglomerate.merge_tree(spark.createDataFrame([], schema)).count() == 0
    got = agglomerate.merge_tree(spark.createDataFrame([(5, 9, 0.5)], schema)).collect()
    assert [tuple(r) for r in got] == [(0, 0, 1, 0.5, 2)]
    with pytest.raises(ValueError):
        agglomerate.merge_tree(spark.createDataFrame([], schema), "median")
