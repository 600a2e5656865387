"""Agglomeration of topics by rounds of reciprocal nearest pairs.

Two clusters that are each other's nearest merge in any order of merging, as long as a merge never
brings a third cluster nearer than the two were (single, complete, average and Ward linkage). So a
round merges all such pairs at once and computes the new distances from the old ones by the
recurrence of Lance and Williams, in joins over the table of distances. The merge tree is that of
merging one pair after the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import durable
from ..sources.corpus import with_row_index

LINKAGES = ("single", "complete", "average", "ward")


def _joined_distance(linkage: str, na: Column, nb: Column, nc: Column, ac: Column, bc: Column, ab: Column) -> Column:
    """The distance of a third cluster c from a and b together."""
    if linkage == "single":
        return F.least(ac, bc)
    if linkage == "complete":
        return F.greatest(ac, bc)
    if linkage == "average":
        return (na * ac + nb * bc) / (na + nb)
    square = ((na + nc) * ac * ac + (nb + nc) * bc * bc - nc * ab * ab) / (na + nb + nc)
    return F.sqrt(F.greatest(square, F.lit(0.0)))


def _merged_on(distances: DataFrame, merges: DataFrame, linkage: str) -> DataFrame:
    """Distances (x, y, d, nx, ny) with the merged clusters of side x put together under the smaller name."""
    role = merges.select(
        F.col("a").alias("m"), F.col("a").alias("to"), F.lit(True).alias("stays"), "ab", "na", "nb"
    ).unionByName(merges.select(
        F.col("b").alias("m"), F.col("a").alias("to"), F.lit(False).alias("stays"), "ab", "na", "nb"
    ))
    named = distances.join(role, F.col("x") == F.col("m"), "left").withColumn("to", F.coalesce("to", "x"))
    both = named.groupBy("to", "y").agg(
        F.max(F.when(F.coalesce("stays", F.lit(True)), F.col("d"))).alias("ac"),
        F.max(F.when(~F.col("stays"), F.col("d"))).alias("bc"),
        F.max("ab").alias("ab"), F.max("na").alias("na"), F.max("nb").alias("nb"),
        F.max("nx").alias("nx"), F.max("ny").alias("ny"),
    )
    c = [F.col(n) for n in ("na", "nb", "ny", "ac", "bc", "ab")]
    return both.select(
        F.col("to").alias("x"), "y",
        F.when(F.col("ab").isNull(), F.col("ac")).otherwise(_joined_distance(linkage, *c)).alias("d"),
        F.when(F.col("ab").isNull(), F.col("nx")).otherwise(F.col("na") + F.col("nb")).alias("nx"), "ny",
    )


def merge_tree(pairs: DataFrame, linkage: str = "ward") -> DataFrame:
    """(step, left, right, distance, size): the merges of all clusters of (a, b, distance), nearest first.

    ``pairs`` has a row for each pair of topics, a < b. Step i makes cluster n + i of n topics; below n, left
    and right are places of topics in ascending order, from 0. Of equally near pairs that with the smallest names goes
    first. Fewer than two topics have no merges.
    """
    if linkage not in LINKAGES:
        raise ValueError(f"unknown linkage {linkage!r}")
    one = F.lit(1.0)
    d = F.col("distance").cast("double").alias("d")
    state = durable(
        pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), d, one.alias("nx"), one.alias("ny")).unionByName(
            pairs.select(F.col("b").alias("x"), F.col("a").alias("y"), d, one.alias("nx"), one.alias("ny")))
    )
    topics = state.select(F.col("x").alias("topic")).distinct()
    done, number = None, 0
    while not state.isEmpty():
        name = F.struct("d", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        near = state.groupBy("x").agg(F.min(F.struct(name.alias("p"), "nx", "ny")).alias("m"))
        # a pair is reciprocal if both of its clusters name it
        merges = durable(
            near.groupBy(F.col("m.p.a").alias("a"), F.col("m.p.b").alias("b")).agg(
                F.count("*").alias("named"), F.max("m.p.d").alias("ab"),
                F.max(F.when(F.col("x") == F.col("m.p.a"), F.col("m.nx"))).alias("na"),
                F.max(F.when(F.col("x") == F.col("m.p.b"), F.col("m.nx"))).alias("nb"),
            ).filter("named = 2").drop("named")
        )
        log = merges.select("a", "b", "ab", (F.col("na") + F.col("nb")).alias("size"), F.lit(number).alias("round"))
        done = log if done is None else done.unionByName(log)
        own = merges.select(F.col("a").alias("ma"), F.col("b").alias("mb"))
        inside = F.least("x", "y").eqNullSafe(F.col("ma")) & F.greatest("x", "y").eqNullSafe(F.col("mb"))
        rest = state.join(own, inside, "left_anti")
        half = _merged_on(rest, merges, linkage)
        turned = half.select(F.col("y").alias("x"), F.col("x").alias("y"), "d", F.col("ny").alias("nx"), F.col("nx").alias("ny"))
        state, number = durable(_merged_on(turned, merges, linkage)), number + 1
    if done is None:
        return pairs.sparkSession.createDataFrame([], "step long, left long, right long, distance double, size long")
    log = durable(done.withColumn("merge", F.concat_ws(" ", "a", "b")))
    placed = durable(with_row_index(log, ["ab", "round", "a", "b"], "merge", "step"))
    n = topics.count()
    leaf = durable(with_row_index(topics, ["topic"], "topic", "leaf"))
    # a cluster is known by its smallest topic; what it was before is the last merge that kept this name
    kept = Window.partitionBy("a").orderBy("step")
    left = placed.withColumn("before", F.lag("step").over(kept))
    last = placed.groupBy(F.col("a").alias("kept")).agg(F.max("step").alias("last"))
    return (
        left.join(last, F.col("b") == F.col("kept"), "left")
        .join(leaf.select(F.col("topic").alias("a"), F.col("leaf").alias("la")), "a")
        .join(leaf.select(F.col("topic").alias("b"), F.col("leaf").alias("lb")), "b")
        .select(
            "step", F.coalesce(F.col("before") + n, "la").alias("left"), F.coalesce(F.col("last") + n, "lb").alias("right"),
            F.col("ab").alias("distance"), F.col("size").cast("long").alias("size"),
        )
    )
