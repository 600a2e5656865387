"""Embedding near-duplicates by binary codes after random rotation.

A unit vector is rotated and reduced to the signs of its coordinates. With each code the
inner product of the vector and its code direction is stored; dividing by it makes the inner
product of a code and another rotated vector an unbiased estimate of the true one, with a
known spread. Codes do two things here: parts of them name buckets, in as many tables as the
wanted recall takes, and inside a bucket the estimate and its bound rule pairs out, so that
only the rest is computed in double precision from the vectors.

Equal vectors are one node. Buckets are compared in a grid of blocks of bounded size; a pair
counts in the first table where it meets, so nothing is counted twice and no pair is written:
blocks return link counts for each node and a spanning forest.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.components import connected_components
from ..session import durable
from .common import groups_of, partitions, query, table

COSINE = 0.9
RECALL = 0.995
SIGMAS = 6.0
BLOCK = 512
SALTS = 8


def rotations(dim: int, number: int) -> np.ndarray:
    """``number`` random orthogonal matrices, the same in every task."""
    rng = np.random.default_rng([dim, 11])
    return np.stack([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(number)])


def plan_tables(nodes: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables): buckets of about half a block, and tables enough for the recall at ``cosine``."""
    bits = int(np.clip(round(math.log2(max(nodes, 1) * 2 / BLOCK)), 4, 24))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def unit(blob: bytes) -> np.ndarray:
    v = np.frombuffer(blob, np.float64)
    v = v / np.abs(v).max()  # squares of very small or large components stay in range
    return v / np.linalg.norm(v)


def _nodes(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, node, vec): a node is a hash of all components; null for vectors that cannot link."""

    def run(batches):
        for batch in batches:
            names, blobs = [], []
            for v in batch.column(1).to_pylist():
                a = np.array([np.nan if x is None else x for x in v or ()], np.float64)
                good = len(a) and np.isfinite(a).all() and a.any()
                blobs.append((a + 0.0).tobytes() if good else None)  # -0.0 equals 0.0
                names.append(xxhash.xxh3_128_digest(blobs[-1]) if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.binary()), pa.array(blobs, pa.binary())],
                [key, "node", "vec"],
            )

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.select(key, vector).mapInArrow(run, f"`{key}` {kind}, node binary, vec binary")


def _keys(nodes: DataFrame, bits: int, tables: int) -> DataFrame:
    """Nodes with their bucket in every table: ``bits`` signs of one of the rotations."""

    def run(batches):
        for batch in batches:
            vecs = [unit(b) for b in batch.column("vec").to_pylist()]
            out: list = [None] * len(vecs)
            for dim in {len(v) for v in vecs}:
                at = [i for i, v in enumerate(vecs) if len(v) == dim]
                x = np.stack([vecs[i] for i in at])
                turned = np.concatenate([x @ r.T for r in rotations(dim, math.ceil(bits * tables / dim))], 1)
                signs = (turned[:, : bits * tables] > 0).reshape(len(at), tables, bits)
                for i, k in zip(at, signs @ (1 << np.arange(bits))):
                    out[i] = k
            yield batch.append_column("keys", pa.array(out, pa.list_(pa.int64())))

    return nodes.mapInArrow(run, "node binary, rep long, copies long, vec binary, keys array<long>")


def _compare(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Pairs (i, j) whose cosine reaches the bound; codes rule out, vectors decide."""
    dim = x.shape[1]
    turn = rotations(dim, 1)[0].T
    turned_x, turned_y = x @ turn, y @ turn
    code = np.where(turned_y > 0, 1.0, -1.0) / math.sqrt(dim)
    factor = (code * turned_y).sum(1)
    estimate = (turned_x @ code.T) / factor
    spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(dim - 1, 1))
    maybe = np.argwhere(estimate + SIGMAS * spread >= cosine)
    exact = np.einsum("ij,ij->i", x[maybe[:, 0]], y[maybe[:, 1]])
    return maybe[exact >= cosine]


def _links(laid: DataFrame, cosine: float) -> DataFrame:
    """(node, n, dst): link counts, and forest edges where ``dst`` is not null."""

    def run(batches):
        for g in groups_of(batches, ["t", "bucket", "row", "col"]):
            t, row, col = (g.column(c)[0].as_py() for c in ("t", "row", "col"))
            node = g.column("node").to_pylist()
            chunk = np.array(g.column("chunk").to_pylist())
            copies = np.array(g.column("copies").to_pylist(), np.int64)
            keys = np.array(g.column("keys").to_pylist())
            x = np.stack([unit(b) for b in g.column("vec").to_pylist()])
            left, right = np.flatnonzero(chunk == row), np.flatnonzero(chunk == col)
            if not len(left) or not len(right):
                continue
            pairs = _compare(x[left], x[right], cosine)
            a, b = left[pairs[:, 0]], right[pairs[:, 1]]
            own = (a < b) if row == col else np.ones(len(a), bool)
            a, b = a[own], b[own]
            fresh = np.ones(len(a), bool)
            for earlier in range(t):
                fresh &= keys[a, earlier] != keys[b, earlier]
            a, b = a[fresh], b[fresh]
            if not len(a):
                continue
            count = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
            out = [(node[i], int(count[i]), None) for i in np.flatnonzero(count)]
            top = list(range(len(node)))

            def root(i):
                while top[i] != i:
                    top[i] = top[top[i]]
                    i = top[i]
                return i

            for i, j in zip(a.tolist(), b.tolist()):
                if (p := root(i)) != (q := root(j)):
                    top[p] = q
                    out.append((node[i], 0, node[j]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], pa.binary())], ["node", "n", "dst"],
            )

    by = ["t", "bucket", "row", "col"]
    spread = laid.repartition(partitions(laid.sparkSession), *by).sortWithinPartitions(*by)
    return spread.mapInArrow(run, "node binary, n long, dst binary")


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(key, n_links, component_id, kept) for every row.

    Vectors that are null, empty, zero or hold a null, NaN or infinity link with nothing, as do
    vectors of different dimension. Rows with a null key take no part and are kept, with a null
    component. Rows that repeat a key count as vectors of their own and share its component
    where their vectors are equal. Other columns are ignored.
    """
    read = durable(_nodes(vectors, key, vector))
    grouped = durable(
        read.filter(F.col("node").isNotNull() & F.col(key).isNotNull()).groupBy("node")
        .agg(F.min(F.col(key).cast("long")).alias("rep"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    )
    bits, tables = plan_tables(grouped.count(), cosine)
    nodes = durable(_keys(grouped, bits, tables))
    # vectors of different dimension never meet
    spots = nodes.select(
        "node", F.posexplode("keys").alias("t", "k"), F.length("vec").alias("dim")
    ).select("node", "t", F.xxhash64("k", "dim").alias("bucket"))
    full = durable(
        spots.groupBy("t", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
        .select("t", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks"))
    )
    each = full.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = spots.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(
        each, ["t", "bucket", "salt"]
    ).withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(1)), "chunks").cast("int"))
    cells = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda c: F.struct(F.least(c, F.col("chunk")).alias("row"), F.greatest(c, F.col("chunk")).alias("col")),
    )
    laid = met.select("t", "bucket", "node", "chunk", F.explode(cells).alias("cell")).select(
        "t", "bucket", "node", "chunk", "cell.row", "cell.col"
    ).join(nodes.select("node", "copies", "keys", "vec"), "node")
    found = durable(_links(laid, cosine))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    labels = connected_components(found.filter("dst IS NOT NULL").select(F.col("node").alias("src"), "dst"))
    comps = durable(
        nodes.select("node", "rep", "copies").join(labels, "node", "left").join(counts, "node", "left")
        .select("node", "rep", F.coalesce("component", "node").alias("comp"),
                (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    )
    least = comps.groupBy("comp").agg(F.min("rep").alias("component_id"))
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    named = durable(
        comps.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
        .join(least.withColumn("salt", salt), ["comp", "salt"]).select("node", "n_links", "component_id")
    )
    out = read.select(key, "node").withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")).join(
        named.withColumn("salt", salt), ["node", "salt"], "left"
    )
    own = F.col(key).isNotNull()
    component = F.when(own, F.coalesce("component_id", F.col(key).cast("long")))
    return out.select(
        key, F.when(own, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col(key) == component, F.lit(True)).alias("kept"),
    )


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v WHERE list_inner_product(e, e) > 0),
l AS (SELECT a.vec_id AS s, b.vec_id AS d FROM u a, u b
  WHERE a.vec_id <> b.vec_id AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
r AS (SELECT vec_id AS n, vec_id AS reach FROM v UNION SELECT r.n, l.d FROM r JOIN l ON r.reach = l.s),
c AS (SELECT n, min(reach) AS component_id FROM r GROUP BY n),
k AS (SELECT s, count(*) AS n_links FROM l GROUP BY s)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON vec_id = n LEFT JOIN k ON vec_id = s"""


@query("op1_embeddings", SQL)
def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
