"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import durable

SALTS = 8


def follow(rows: DataFrame, column: str, moves: DataFrame, salts: int = SALTS) -> DataFrame:
    """``column`` replaced by ``moves.target`` of the node it names, if there is one.

    Many rows may name the same node, so the rows of a node are dealt over ``salts`` keys and
    its single move is repeated for each of them.
    """
    spread = moves.select(
        F.col("node").alias("_node"),
        F.col("target").alias("_target"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt_r"),
    )
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    met = salted.join(
        spread, (F.col(column) == F.col("_node")) & (F.col("_salt") == F.col("_salt_r")), "left"
    )
    return met.withColumn(column, F.coalesce("_target", column)).select(*rows.columns)


def connected_components(edges: DataFrame, salts: int = SALTS) -> DataFrame:
    """(node, component) with the smallest node of the component, for all nodes with an edge.

    Each round lets every node point at its smallest neighbour below itself, follows these
    pointers to their ends, and puts the ends into the edges. At least every second node
    vanishes in a round, so rounds are few. Tables between rounds are written down; edges with
    a null or equal ends are ignored.
    """
    pairs = durable(
        edges.filter("src IS NOT NULL AND dst IS NOT NULL AND src != dst")
        .select(F.least("src", "dst").alias("low"), F.greatest("src", "dst").alias("high"))
        .distinct()
    )
    labels = pairs.select(F.col("low").alias("node")).union(pairs.select("high")).distinct()
    labels = labels.withColumn("component", F.col("node"))
    while not pairs.isEmpty():
        moves = durable(
            pairs.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("target"))
        )
        while True:
            ends = moves.select("node", "target", F.col("target").alias("before"))
            moved = durable(follow(ends, "target", moves, salts))
            moves = moved.select("node", "target")
            if moved.filter("target != before").isEmpty():
                break
        labels = durable(follow(labels, "component", moves, salts))
        pairs = durable(
            follow(follow(pairs, "low", moves, salts), "high", moves, salts)
            .filter("low != high")
            .select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high"))
            .distinct()
        )
    return labels
