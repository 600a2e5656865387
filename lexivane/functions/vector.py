"""Column functions and aggregates over vectors stored as arrays."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F


def as_float32(v: Column | str) -> Column:
    return (F.col(v) if isinstance(v, str) else v).cast("array<float>")


def as_double(v: Column | str) -> Column:
    return (F.col(v) if isinstance(v, str) else v).cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda acc, x: acc + x * x))


def bind(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, also where fn uses it inside a lambda."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def l2_normalise(v: Column | str) -> Column:
    """Unit vector; null where the length is zero."""
    return bind(
        F.struct(as_double(v).alias("v"), norm(v).alias("n")),
        lambda s: F.when(s["n"] > 0, F.transform(s["v"], lambda x: x / s["n"])),
    )


def cosine(a: Column | str, b: Column | str) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths)


def vector_problem(v: Column | str, dimension: int) -> Column:
    """Name of the first rule a vector breaks, or null."""
    v = F.col(v) if isinstance(v, str) else v
    return (
        F.when(v.isNull(), "missing")
        .when(F.size(v) == 0, "empty")
        .when(F.exists(v, lambda x: x.isNull()), "null element")
        .when(F.exists(v, lambda x: F.isnan(x)), "not a number")
        .when(F.size(v) != dimension, "dimension")
        .when(F.forall(v, lambda x: x == 0), "zero")
    )


def mean_vector(v: Column | str, weight: Column | None = None) -> Column:
    """Aggregate: (weighted) mean of vectors, partially aggregated before the shuffle."""
    vector = array_to_vector(as_double(v))
    metric = Summarizer.mean(vector) if weight is None else Summarizer.mean(
        vector, weight.cast("double")
    )
    return vector_to_array(metric)


def pool_chunks(
    chunks: DataFrame, key: str = "doc_id", vector: str = "vector", weight: str = "weight",
    normalise_single: bool = False,
) -> DataFrame:
    """One vector per document: mean weighted by chunk length, then unit length.

    A single chunk is kept as it is unless ``normalise_single``. A mean of zero length
    has no direction: its vector is null and ``error`` says so.
    """
    pooled = chunks.groupBy(key).agg(
        F.count("*").alias("n_chunks"),
        F.first(as_double(vector)).alias("__first"),
        mean_vector(vector, F.col(weight)).alias("__mean"),
    )
    single = l2_normalise("__first") if normalise_single else F.col("__first")
    vec = F.when(F.col("n_chunks") == 1, single).otherwise(l2_normalise("__mean"))
    return pooled.select(
        key, "n_chunks", vec.alias("embedding"), F.when(vec.isNull(), "zero norm").alias("error")
    )


def dimensions(store: DataFrame, vector: str = "embedding") -> DataFrame:
    """Smallest and largest dimension per provider."""
    sized = store.filter(F.size(vector) > 0).select("provider", F.size(vector).alias("d"))
    return sized.groupBy("provider").agg(
        F.min("d").cast("bigint").alias("min_dim"), F.max("d").cast("bigint").alias("max_dim")
    )
