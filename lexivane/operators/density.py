"""Density clustering and its exchangeable alternative, with ordered cluster ids."""

from __future__ import annotations

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ..functions.vector import as_double
from ..session import durable
from ..sources.corpus import with_row_index
from .components import connected_components
from .hierarchy import PIECE_EDGES, condensed_tree, excess_of_mass
from .neighbours import (
    BROADCAST_BYTES, CHUNK_ROWS, clean, distinct_vectors, knn, members, metric_of, problem,
    radius_forest, usual_dimension,
)
from .spanning import spanning_tree

NOISE = -1


def order_topics(assignment: DataFrame, key: str = "doc_id", cluster: str = "cluster") -> DataFrame:
    """Topic ids 0, 1, ... by descending size, ties by smallest member; null is noise, -1."""
    sizes = assignment.filter(F.col(cluster).isNotNull()).groupBy(cluster).agg(
        F.count("*").alias("n"), F.min(key).alias("least")
    )
    ranked = with_row_index(sizes, ["-n", "least"], cluster, "topic").select(cluster, "topic")
    return assignment.join(ranked, cluster, "left").select(
        key, F.coalesce("topic", F.lit(NOISE)).cast("bigint").alias("topic")
    )


def density_clusters(
    points: DataFrame, min_cluster_size: int = 20, min_samples: int | None = None,
    radius: float | None = None, metric: str = "euclidean", key: str = "doc_id",
    vector: str = "embedding", broadcast_bytes: int = BROADCAST_BYTES,
    chunk_rows: int = CHUNK_ROWS, piece_edges: int = PIECE_EDGES,
) -> DataFrame:
    """(key, topic): the clusters of greatest excess of mass, or those of one ``radius`` if it is given.

    Keys are unique. Rows without a usable vector are noise, as are points outside of all clusters.
    """
    if radius is not None:
        return radius_clusters(
            points, min_cluster_size, min_samples, radius, metric, key, vector, broadcast_bytes, chunk_rows
        )
    _, held = density_hierarchy(
        points, min_cluster_size, min_samples, metric, key, vector, broadcast_bytes, chunk_rows, piece_edges
    )
    return order_topics(points.select(key).join(held.select(key, "cluster"), key, "left"), key)


def density_hierarchy(
    points: DataFrame, min_cluster_size: int = 20, min_samples: int | None = None,
    metric: str = "euclidean", key: str = "doc_id", vector: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES, chunk_rows: int = CHUNK_ROWS, piece_edges: int = PIECE_EDGES,
) -> tuple[DataFrame, DataFrame]:
    """The condensed cluster tree with the chosen clusters, and their points with strengths.

    See ``hierarchy.excess_of_mass``: (cluster, parent, stability, value, chosen) and
    (key, cluster, strength). Clusters may be nested and of any density; none is below
    ``min_cluster_size``, and the whole table is never one.
    """
    usable = points.filter(problem(vector, metric_of(metric), usual_dimension(points, vector)).isNull())
    tree = durable(spanning_tree(
        usable, min_samples or min_cluster_size, metric, key, vector, broadcast_bytes, chunk_rows
    ))
    clusters, leaving = condensed_tree(tree, usable.select(key), min_cluster_size, key, piece_edges)
    return excess_of_mass(clusters, leaving, key)


def radius_clusters(
    points: DataFrame, min_cluster_size: int = 20, min_samples: int | None = None,
    radius: float | None = None, metric: str = "euclidean", key: str = "doc_id",
    vector: str = "embedding", broadcast_bytes: int = BROADCAST_BYTES,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(key, topic): components of core points that reach each other within ``radius``.

    A core point has its ``min_samples``-th neighbour within the radius. The default
    radius is the 90th percentile of these distances. Everything else, and every component
    below ``min_cluster_size``, is noise.
    """
    m = metric_of(metric)
    pts = clean(points, key, vector, m)
    samples = min_samples or min_cluster_size
    near = knn(
        pts, pts, samples, metric, "id", "id", "vec", exclude_self=True,
        broadcast_bytes=broadcast_bytes, chunk_rows=chunk_rows,
    )
    core = durable(near.filter(F.col("rank") == samples).select("id", F.col("distance").alias("core")))
    if radius is None:
        radius = core.agg(F.percentile_approx("core", 0.9, 1_000_000)).first()[0]
    inside = durable(
        pts.join(core.filter(F.col("core") <= F.lit(radius)), "id", "left_semi")
        if radius is not None
        else pts.limit(0)
    )
    units = durable(distinct_vectors(inside, 1))
    if units.isEmpty():
        none = points.select(key).withColumn("cluster", F.lit(None).cast("bigint"))
        return order_topics(none, key)
    forest = radius_forest(units.select("uid", "vec"), radius, m, chunk_rows)
    labels = connected_components(forest)
    each = members(inside, units).join(labels, F.col("uid") == F.col("node"), "left").select(
        "id", F.coalesce("component", "uid").alias("cluster")
    )
    big = each.groupBy("cluster").agg(F.count("*").alias("n")).filter(
        F.col("n") >= min_cluster_size
    )
    kept = each.join(big, "cluster", "left_semi").select(F.col("id").alias(key), "cluster")
    return order_topics(points.select(key).join(kept, key, "left"), key)


def centre_clusters(
    points: DataFrame, k: int, method: str = "kmeans", key: str = "doc_id",
    vector: str = "embedding", seed: int = 42,
) -> DataFrame:
    """The same output as density_clusters, from k-means or its bisecting form; no noise."""
    models = {"kmeans": KMeans, "bisecting": BisectingKMeans}
    if method not in models:
        raise ValueError(f"unknown clusterer {method!r}")
    data = points.filter(F.size(vector) > 0).select(
        key, array_to_vector(as_double(vector)).alias("features")
    )
    model = models[method](k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(data)
    assigned = model.transform(data).select(key, "cluster")
    return order_topics(points.select(key).join(assigned, key, "left"), key)
