"""Linear projection of vectors to a few coordinates."""

from __future__ import annotations

from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..functions.vector import as_double

AXES = ("proj_x", "proj_y", "proj_z")


def fit_projection(points: DataFrame, k: int, vector: str = "embedding") -> PCAModel:
    """Principal axes; the driver holds one d x d matrix, whatever the number of rows."""
    data = points.filter(F.size(vector) > 0).select(
        array_to_vector(as_double(vector)).alias("features")
    )
    return PCA(k=k, inputCol="features", outputCol="projected").fit(data)


def project(points: DataFrame, model: PCAModel, vector: str = "embedding", out: str = "projected") -> DataFrame:
    """Add the coordinates as an array; rows without a vector are dropped."""
    data = points.filter(F.size(vector) > 0).withColumn(
        "features", array_to_vector(as_double(vector))
    )
    done = model.transform(data)
    return done.withColumn(out, vector_to_array(model.getOutputCol())).drop(
        *({"features", model.getOutputCol()} - {out})
    )


def with_coordinates(points: DataFrame, k: int = 3, vector: str = "embedding") -> DataFrame:
    """Two or three named float coordinates per row."""
    done = project(points, fit_projection(points, k, vector), vector, "__p")
    axes = [F.col("__p")[i].cast("float").alias(AXES[i]) for i in range(k)]
    return done.select("*", *axes).drop("__p")
