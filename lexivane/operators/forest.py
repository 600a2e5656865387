"""Approximate nearest neighbours: a random projection forest, then descent over neighbours of neighbours.

Every tree orders all vectors: it halves them at the median of one random direction a level, and
what it puts side by side is alike. The order, not the tree, is cut into blocks of fixed size, so
no leaf is too large or too small, whatever the data. Pairs within a block are compared; a vector
keeps its best over all trees. Then rounds of descent: the neighbours of a vector, in both
directions, are compared with each other, since neighbours of a neighbour are likely ones too.

Work grows with n log n for sorting and with n for everything else. The exact search is
``neighbours.knn``; ``recall`` compares the two.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import durable
from .neighbours import (
    BROADCAST_BYTES, Metric, clean, distinct_vectors, expand_copies, members, metric_of,
)

SAMPLE_ROWS = 20_000
NODE_ROWS = 8  # rows of the sample that a median should rest on


@dataclass(frozen=True)
class Tree:
    """A direction a level and one more to order leaves by, and a threshold for each node."""

    directions: np.ndarray
    thresholds: list[np.ndarray]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, place within the leaf) of every row."""
        p = x @ self.directions.T
        node = leaf = np.zeros(len(x), np.int64)
        for level, cuts in enumerate(self.thresholds):
            right = p[:, level] > cuts[node]
            leaf = 2 * leaf + right
            if level + 1 < len(self.thresholds) and len(self.thresholds[level + 1]) > len(cuts):
                node = 2 * node + right
        return leaf, p[:, -1]


def _medians(values: np.ndarray, node: np.ndarray, n: int) -> np.ndarray:
    """The median of each node; that of all values for nodes without any."""
    order = np.lexsort([values, node])
    first = np.searchsorted(node[order], np.arange(n))
    past = np.searchsorted(node[order], np.arange(n), side="right")
    out = np.full(n, np.median(values) if len(values) else 0.0)
    some = past > first
    out[some] = values[order][(first[some] + past[some] - 1) // 2]
    return out


def _grow(sample: np.ndarray, depth: int, seed: list[int]) -> Tree:
    """A tree from a sample. Levels too deep for it use the medians of its deepest nodes."""
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(depth + 1, sample.shape[1]))
    p = sample @ directions.T
    known = max(0, int(np.log2(max(1, len(sample) / NODE_ROWS))))
    node, cuts = np.zeros(len(sample), np.int64), []
    for level in range(depth):
        cuts.append(_medians(p[:, level], node, 1 << min(level, known)))
        if level < known:
            node = 2 * node + (p[:, level] > cuts[-1][node])
    return Tree(directions, cuts)


def plant(units: DataFrame, n: int, metric: Metric, trees: int, block_rows: int, seed: int) -> list[Tree]:
    """Trees from a sample by hash; the driver holds at most 32 MB of vectors, however many there are."""
    dimension = units.select(F.size("vec")).first()[0]
    rows = min(SAMPLE_ROWS, BROADCAST_BYTES // (8 * dimension))
    drawn = units.select("uid", "vec").orderBy(F.xxhash64("uid", F.lit(seed)), "uid").limit(rows).collect()
    sample = metric.prepare([r["vec"] for r in drawn])
    depth = max(0, int(np.ceil(np.log2(max(1, n / block_rows)))))
    return [_grow(sample, depth, [seed, t]) for t in range(trees)]


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(x: np.ndarray, metric: Metric) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True) if metric.name == "cosine" else x


def _lists(ids: pa.Array, row: np.ndarray, distance: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    """(uid, near) from hits sorted by row, for the rows that have any."""
    have, first = np.unique(row, return_index=True)
    near = pa.ListArray.from_arrays(
        pa.array(np.append(first, len(row)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(distance, pa.float64()), ids.take(pa.array(other))], ["distance", "other"]),
    )
    return pa.RecordBatch.from_arrays([ids.take(pa.array(have)), near], names=["uid", "near"])


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Runs of about ``size`` rows of one tree, in the order in which they come; a rest is shared out."""
    held, tree = [], None

    def cut(table: pa.Table, last: bool) -> Iterator[pa.Table]:
        at, n = 0, table.num_rows
        while n - at >= 2 * size or (last and at < n):
            step = size if n - at >= 2 * size else (n - at if n - at <= size else -(-(n - at) // 2))
            yield table.slice(at, step)
            at += step
        held[:] = table.slice(at).to_batches() if at < n else []

    for batch in batches:
        trees = batch.column("tree").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(trees)) + 1).tolist(), len(trees)]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            if held and tree != trees[a]:
                yield from cut(pa.Table.from_batches(held), True)
            tree = trees[a]
            held.append(batch.slice(a, b - a))
            if sum(h.num_rows for h in held) >= 2 * size:
                yield from cut(pa.Table.from_batches(held), False)
    if held:
        yield from cut(pa.Table.from_batches(held), True)


def _best(merged: DataFrame, k: int) -> DataFrame:
    """(uid, near) with the ``k`` nearest of all lists of a vector."""
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_list("near"))))
    return merged.groupBy("uid").agg(F.slice(every, 1, k).alias("near"))


def _from_trees(units: DataFrame, trees: list[Tree], k: int, metric: Metric, block_rows: int) -> DataFrame:
    uid = units.schema["uid"].dataType.simpleString()
    shared = units.sparkSession.sparkContext.broadcast(trees)  # bounded by the sample

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(_vectors(batch.column("vec")), metric)
            for t, tree in enumerate(shared.value):
                leaf, at = tree.place(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)), pa.array(leaf), pa.array(at), *batch.columns],
                    names=["tree", "leaf", "at", *batch.schema.names],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, block_rows):
            ids, vec = block["uid"].combine_chunks(), block["vec"].combine_chunks()
            x = _unit(_vectors(vec), metric)
            d = metric.distances(x, x)
            np.fill_diagonal(d, np.inf)
            top = np.argsort(d, axis=1, kind="stable")[:, : min(k, len(d) - 1)]
            if top.size:
                row = np.repeat(np.arange(len(d)), top.shape[1])
                yield _lists(ids, row, np.take_along_axis(d, top, axis=1).ravel(), top.ravel())

    placed = units.select("uid", "vec").mapInArrow(
        place, f"tree int, leaf long, at double, uid {uid}, vec array<double>"
    )
    ordered = placed.repartitionByRange("tree", "leaf", "at").sortWithinPartitions("tree", "leaf", "at")
    lists = ordered.mapInArrow(compare, f"uid {uid}, near array<struct<distance:double,other:{uid}>>")
    return _best(lists, k)


def _descend(graph: DataFrame, units: DataFrame, k: int, metric: Metric, width: int) -> DataFrame:
    """One round: around every vector, its ``width`` nearest and those it is near to meet each other.

    A vector that very many are near to meets the nearest of them only, so no group and no key grows.
    """
    uid = units.schema["uid"].dataType.simpleString()
    edges = graph.select("uid", F.inline(F.slice("near", 1, width)))
    closest = Window.partitionBy("other").orderBy("distance", "uid")
    limited = edges.withColumn("r", F.row_number().over(closest)).filter(F.col("r") <= 4 * width)
    meeting = (
        limited.select(F.col("uid").alias("at"), F.col("other").alias("uid"))
        .unionByName(limited.filter(F.col("r") <= width).select(F.col("other").alias("at"), "uid"))
        .distinct()
        .unionByName(graph.select(F.col("uid").alias("at"), "uid"))
    )
    worst = graph.select(
        "uid", F.when(F.size("near") >= k, F.element_at("near", -1)["distance"]).otherwise(float("inf")).alias("worst")
    )
    groups = meeting.join(units.select("uid", "vec").join(worst, "uid"), "uid").groupBy("at").agg(
        F.collect_list(F.struct("uid", "vec", "worst")).alias("group")
    ).select("group")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = batch.column("group")
            cuts = np.asarray(group.offsets) - (group.offsets[0].as_py() if len(group) else 0)
            flat = group.flatten()
            ids, x = flat.field("uid"), _unit(_vectors(flat.field("vec")), metric)
            limit = flat.field("worst").to_numpy()
            rows, others, found = [], [], []
            for a, b in zip(cuts[:-1], cuts[1:]):
                d = metric.distances(x[a:b], x[a:b])
                np.fill_diagonal(d, np.inf)
                i, j = np.nonzero(d < limit[a:b, None])
                rows.append(i + a)
                others.append(j + a)
                found.append(d[i, j])
            if rows and sum(map(len, rows)):
                yield _lists(ids, np.concatenate(rows), np.concatenate(found), np.concatenate(others))

    better = groups.mapInArrow(meet, f"uid {uid}, near array<struct<distance:double,other:{uid}>>")
    return _best(graph.unionByName(better), k)


def approximate_knn(
    points: DataFrame, k: int, metric: str = "cosine", key: str = "doc_id", vector: str = "embedding",
    trees: int = 8, block_rows: int = 256, rounds: int = 2, width: int = 12, seed: int = 42,
) -> DataFrame:
    """(id, neighbour, distance, rank): ``k`` near rows of every row but itself, most of them the nearest.

    The same columns, metrics and treatment of unusable vectors as ``neighbours.knn``, and the same
    distances; ties by neighbour id. Equal vectors are searched once and expanded. More ``trees``,
    larger blocks, more ``rounds`` or a greater ``width`` raise recall. The same table and
    seed give the same result up to the borders of partitions.
    """
    m = metric_of(metric)
    pts = clean(points, key, vector, m)
    units = durable(distinct_vectors(pts, k + 1).withColumn("vec", F.col("vec").cast("array<double>")))
    n = units.count()
    own = units.select(F.col("uid").alias("qid"), F.col("uid").alias("bid"), F.lit(0.0).alias("distance"))
    found = own
    if n > 1:
        planted = plant(units, n, m, trees, block_rows, seed)
        graph = durable(_from_trees(units, planted, k, m, block_rows))
        for _ in range(rounds):
            graph = durable(_descend(graph, units, k, m, width))
        hits = graph.select(F.col("uid").alias("qid"), F.inline("near")).groupBy(
            "qid", F.col("other").alias("bid")
        ).agg(F.min("distance").alias("distance"))
        found = own.unionByName(hits)
    where = members(pts.withColumn("vec", F.col("vec").cast("array<double>")), units)
    each = expand_copies(found, units, where, k + 1).filter("qid != bid")
    order = Window.partitionBy("qid").orderBy("distance", "bid")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        F.col("qid").alias("id"), F.col("bid").alias("neighbour"), "distance", F.col("rank").cast("long").alias("rank")
    )


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(n, hits, recall): exact neighbours, those also found, and their share; both as from a search."""
    both = exact.select("id", "neighbour").join(
        found.select("id", "neighbour", F.lit(1).alias("hit")), ["id", "neighbour"], "left"
    )
    return both.agg(F.count("*").alias("n"), F.count("hit").alias("hits")).withColumn(
        "recall", F.col("hits") / F.col("n")
    )
