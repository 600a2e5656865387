"""Spectral embedding of a neighbour graph: coordinates that keep neighbourhoods.

The coordinates are the leading eigenvectors of the symmetrically normalised weights, past the
trivial one, divided by the root of the degree. They come from subspace iteration on a thin block
of columns: a Chebyshev polynomial of the matrix damps what lies below the block, and a
Rayleigh-Ritz step turns the block into the best vectors it holds and measures their residuals.

A product with the matrix is one join with the edges and one sum. Edges are held partitioned by
source, and the sum leaves the block partitioned in the same way, so each product shuffles once,
and only the block. The driver sees Gram matrices, whose size is that of the block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.vector import as_double
from ..session import durable
from .neighbours import clean, distinct_vectors, knn, members, metric_of, neighbour_graph
from .reduce import AXES

EXTRA = 6  # columns beyond those asked for; they speed up the last ones
DEGREE = 10
TOLERANCE = 1e-3
ROUNDS = 30
PLACES = 1 << 32


@dataclass
class Embedding:
    """(id, axes) and, for each axis, its eigenvalue and the norm of its residual."""

    rows: DataFrame
    eigenvalues: list[float]
    residuals: list[float]


def _columns(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(n)]


def normalised(graph: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(src, dst, w, self) with both directions and a loop for each node, and (id, t), the root degrees.

    Loops weigh nothing; they carry a node's own values through a product.
    """
    both = graph.select("src", "dst", "weight").unionByName(
        graph.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    ).filter("src != dst AND weight > 0")
    degree = durable(both.groupBy(F.col("src").alias("id")).agg(F.sqrt(F.sum("weight")).alias("t")))
    ends = both.join(degree.select(F.col("id").alias("src"), F.col("t").alias("ts")), "src").join(
        degree.select(F.col("id").alias("dst"), F.col("t").alias("td")), "dst"
    )
    zero, one = F.lit(0.0), F.lit(1.0)
    edges = ends.select("src", "dst", (F.col("weight") / (F.col("ts") * F.col("td"))).alias("w"), zero.alias("self"))
    loops = degree.select(F.col("id").alias("src"), F.col("id").alias("dst"), zero.alias("w"), one.alias("self"))
    return durable(edges.unionByName(loops)), degree


def _product(block: DataFrame, edges: DataFrame, times: list[str], keep: list[str]) -> DataFrame:
    """(id, s_<c> for c in times, keep): the matrix times some columns, next to a node's own ones."""
    sums = [F.expr(f"sum(w * {c}) AS s_{c}") for c in times]
    own = [F.expr(f"sum(self * {c}) AS {c}") for c in keep]
    return block.join(edges, F.col("id") == F.col("src")).groupBy(F.col("dst").alias("id")).agg(*sums, *own)


def _damped(block: DataFrame, edges: DataFrame, n: int, cut: float, degree: int) -> DataFrame:
    """The Chebyshev polynomial of a degree that is small on [-1, cut] and grows beyond, times the block."""
    cur, prev = _columns("x", n), _columns("p", n)
    a, b = 2 / (cut + 1), (cut - 1) / (cut + 1)
    scaled = lambda c: f"({a!r}D * s_{c} - {b!r}D * {c})"
    state = _product(block, edges, cur, cur).selectExpr(
        "id", *[f"{scaled(c)} AS {c}" for c in cur], *[f"{c} AS {p}" for c, p in zip(cur, prev)]
    )
    for _ in range(degree - 1):
        state = _product(state, edges, cur, cur + prev).selectExpr(
            "id", *[f"2 * {scaled(c)} - {p} AS {c}" for c, p in zip(cur, prev)],
            *[f"{c} AS {p}" for c, p in zip(cur, prev)],
        )
    return state.select("id", *cur)


def _gram(rows: DataFrame, columns: list[str]) -> np.ndarray:
    """Products of all pairs of columns, summed in the tasks; the driver gets one small matrix."""
    k = len(columns)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            z = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            total += z @ z.T
        at = np.arange(k * k)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["at", "value"])

    out = np.zeros(k * k)
    for r in rows.select(*columns).mapInArrow(partial, "at long, value double").groupBy("at").agg(
        F.sum("value").alias("value")
    ).collect():
        out[r["at"]] = r["value"]
    return out.reshape(k, k)


def _ritz(z: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shift, turn, values, residuals) from the Gram matrix of (t, x.., y..), where y is the product of x.

    ``(x - t shift) turn`` are the Ritz vectors, of unit length and free of the trivial vector t.
    """
    tt, tx = z[0, 0], z[0, 1 : n + 1]
    shift = tx / tt
    trivial = np.outer(tx, tx) / tt  # t is kept by the matrix, so its part is the same in all three
    g = z[1 : n + 1, 1 : n + 1] - trivial
    h = z[1 : n + 1, n + 1 :] - trivial
    h2 = z[n + 1 :, n + 1 :] - trivial
    scale = 1 / np.sqrt(np.maximum(np.diag(g), 1e-300))
    g, h, h2 = (m * scale[:, None] * scale[None, :] for m in (g, (h + h.T) / 2, h2))
    size, basis = np.linalg.eigh(g)
    good = size > 1e-10 * size.max()  # columns that have become parallel count once
    root = basis[:, good] / np.sqrt(size[good])
    values, turn = np.linalg.eigh(root.T @ h @ root)
    order = np.argsort(-values)
    values, turn = values[order], root @ turn[:, order]
    square = np.einsum("ij,ik,kj->j", turn, h2, turn) - values**2
    return shift, scale[:, None] * turn, values, np.sqrt(np.maximum(square, 0))


def _start(key: str, i: Column | int, seed: int) -> Column:
    """A number in [-1, 1) for a node, the same in every run."""
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(PLACES)) / (PLACES / 2) - 1


def spectral_embedding(
    graph: DataFrame, k: int, seed: int = 42, tolerance: float = TOLERANCE, rounds: int = ROUNDS,
    degree: int = DEGREE, extra: int = EXTRA,
) -> Embedding:
    """``k`` coordinates for every node of an undirected weighted graph (src, dst, weight).

    Rounds end when the residual of every axis is below ``tolerance`` or after ``rounds`` of them;
    the residuals are part of the result. Axes are scaled to variance 1 under the degrees and point
    to the side of their largest value. A graph of several components has an axis that tells
    them apart first. Fewer nodes than axes give fewer axes, a graph without edges no rows.
    """
    edges, roots = normalised(graph)
    nodes = roots.count()
    if not nodes:
        return Embedding(roots.select("id", F.array().cast("array<double>").alias("axes")), [], [])
    edges = edges.repartition("src").persist(StorageLevel.MEMORY_AND_DISK)
    n = min(k + extra, max(nodes - 1, 1))
    x, y = _columns("x", n), _columns("s_x", n)
    block = roots.select("id", *[_start("id", i, seed).alias(c) for i, c in enumerate(x)])
    cut = 0.0
    for at in range(rounds + 1):
        if at:
            block = _damped(block, edges, n, cut, degree)
        block = durable(block)
        with_t = durable(_product(block, edges, x, x).join(roots, "id"))
        shift, turn, values, residuals = _ritz(_gram(with_t, ["t", *x, *y]), n)
        axes = min(k, len(values), max(nodes - 1, 0))
        done = at > 0 and (residuals[:axes] < tolerance).all()
        width = axes if done or at == rounds else turn.shape[1]
        held = block.join(roots, "id")
        mixed = lambda j: sum(
            (float(turn[i, j]) * (F.col(c) - float(shift[i]) * F.col("t")) for i, c in enumerate(x)), F.lit(0.0)  # noqa: B023
        )
        block = held.select("id", "t", *[mixed(j).alias(f"x{j}") for j in range(width)])
        if done or at == rounds:
            break
        # what the block cannot hold lies below its last value; stay clear of the trivial one
        cut = float(np.clip(values[-1], -0.9, 0.999))
        fresh = [_start("id", (at + 1) * n + j, seed).alias(f"x{j}") for j in range(width, n)]
        block = block.select("id", *[F.col(f"x{j}") for j in range(width)], *fresh)
    axis = _columns("x", axes)
    signs = block.agg(F.sum(F.col("t") * F.col("t")), *[
        F.max_by(F.signum(c), F.struct(F.round(F.abs(F.col(c) / F.col("t")), 9), "id")) for c in axis
    ]).first()
    total = float(signs[0] or 1.0) ** 0.5
    rows = durable(block.select("id", F.array(*[
        F.col(c) / F.col("t") * (float(s or 1.0) * total) for c, s in zip(axis, signs[1:])
    ]).cast("array<double>").alias("axes")))
    edges.unpersist()
    return Embedding(rows, values[:axes].tolist(), residuals[:axes].tolist())


def graph_coordinates(
    points: DataFrame, k: int, neighbours: int = 15, metric: str = "cosine", key: str = "doc_id",
    vector: str = "embedding", search=knn, **how,
) -> tuple[DataFrame, Embedding]:
    """(key, axes) for every row with a usable vector, from the graph of nearest neighbours.

    ``search`` is ``knn`` or ``forest.approximate_knn``. Equal vectors are one node, so copies lie on one place
    and make no hub.
    """
    m = metric_of(metric)
    pts = durable(clean(points, key, vector, m))
    units = durable(distinct_vectors(pts, 1).select("uid", F.col("vec").cast("array<double>").alias("vec")))
    if search is knn:
        near = knn(units, units, neighbours, metric, "uid", "uid", "vec", exclude_self=True)
    else:
        near = search(units, neighbours, metric, "uid", "vec")
    found = spectral_embedding(durable(neighbour_graph(durable(near), neighbours)), k, **how)
    where = members(pts.withColumn("vec", as_double("vec")), units)
    rows = where.join(found.rows, F.col("uid") == found.rows["id"]).select(where["id"].alias(key), "axes")
    return rows, found


def with_graph_coordinates(points: DataFrame, k: int = 3, key: str = "doc_id", **how) -> DataFrame:
    """Two or three named float coordinates per row; rows without a usable vector are dropped."""
    rows, _ = graph_coordinates(points, k, key=key, **how)
    axes = [F.get("axes", F.lit(i)).cast("float").alias(AXES[i]) for i in range(k)]
    return points.join(rows.select(key, *axes), key)


def neighbours_kept(
    points: DataFrame, placed: DataFrame, k: int = 15, metric: str = "cosine", key: str = "doc_id",
    vector: str = "embedding", axes: str = "axes",
) -> float:
    """The share of the ``k`` nearest rows of each row that are among its ``k`` nearest after placing."""
    before = knn(points, points, k, metric, key, key, vector, exclude_self=True).select("id", "neighbour")
    after = knn(placed, placed, k, "euclidean", key, key, axes, exclude_self=True).select(
        "id", "neighbour", F.lit(1).alias("hit")
    )
    n, hits = before.join(after, ["id", "neighbour"], "left").agg(F.count("*"), F.count("hit")).first()
    return hits / n if n else 1.0
