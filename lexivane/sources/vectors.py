"""Reading vector stores: long tables, nested maps, wide docs, manifest-driven loads."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .corpus import VECTOR_PREFIX, vector_columns, without_vectors

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField(
            "providers",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("file", T.StringType()),
                        T.StructField("filepath", T.StringType()),
                        T.StructField("completed_at", T.StringType()),
                        T.StructField("num_embeddings", T.LongType()),
                    ]
                ),
            ),
        )
    ]
)
MANIFEST_ROWS = T.StructType(
    [
        T.StructField("provider", T.StringType()),
        *MANIFEST_SCHEMA["providers"].dataType.valueType.fields,
    ]
)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Long store ``provider, doc_id, embedding``, written partitioned by provider."""
    return spark.read.parquet(path)


def provider_vectors(store: DataFrame, provider: str, ids: DataFrame | None = None) -> DataFrame:
    """One provider's vectors, optionally only for the ids given in a column ``doc_id``.

    The provider filter prunes folders; the ids go through a semi join.
    """
    rows = store.filter(F.col("provider") == provider)
    return rows if ids is None else rows.join(ids.select("doc_id"), "doc_id", "left_semi")


def explode_nested(df: DataFrame, column: str) -> DataFrame:
    """``map<provider, map<doc_id, vector>>`` as long rows."""
    return df.select(F.explode(column).alias("provider", "__docs")).select(
        "provider", F.explode("__docs").alias("doc_id", "embedding")
    )


def unpivot_wide(docs: DataFrame, key: str = "url") -> DataFrame:
    """Long rows out of the ``embeddings_*`` columns; nulls are skipped."""
    columns = vector_columns(docs)
    if not columns:
        raise ValueError("no embedding columns")
    rows = docs.unpivot(key, [f"`{c}`" for c in columns], "provider", "embedding")
    return rows.filter(F.col("embedding").isNotNull()).select(
        F.expr(f"substring(provider, {len(VECTOR_PREFIX) + 1})").alias("provider"),
        F.col(key).alias("doc_id"),
        "embedding",
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per provider; an absent manifest is an empty one."""
    try:
        raw = spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_ROWS)
    return raw.select(F.explode("providers").alias("provider", "__e")).select("provider", "__e.*")


def attach_vectors(docs: DataFrame, store: DataFrame, key: str = "url") -> DataFrame:
    """Left join of docs and one provider's vectors: every document stays."""
    vectors = store.select(F.col("doc_id").alias(key), "embedding")
    return docs.join(vectors, key, "left")


def attach_providers(
    docs: DataFrame, store: DataFrame, providers: list[str], key: str = "url"
) -> DataFrame:
    """Wide docs: one ``embeddings_{provider}`` column per listed provider, null if missing."""
    wide = (
        store.filter(F.col("provider").isin(providers))
        .groupBy(F.col("doc_id").alias(key))
        .pivot("provider", providers)
        .agg(F.first("embedding"))
    )
    wide = wide.select(key, *[F.col(f"`{p}`").alias(VECTOR_PREFIX + p) for p in providers])
    return docs.join(wide, key, "left")


def load_by_manifest(spark: SparkSession, docs: DataFrame, manifest_path: str) -> DataFrame:
    """Docs plus the vectors of each provider file the manifest names."""
    entries = read_manifest(spark, manifest_path).select("provider", "filepath").collect()
    wide = without_vectors(docs)
    for entry in sorted(entries):
        vectors = spark.read.parquet(entry["filepath"]).select(
            F.col("doc_id").alias("url"),
            F.col("embedding").cast("array<float>").alias(VECTOR_PREFIX + entry["provider"]),
        )
        wide = wide.join(vectors, "url", "left")
    return wide
