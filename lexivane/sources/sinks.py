"""Writing vector stores, docs, reports, model tables and delivery batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .corpus import VECTOR_PREFIX, without_vectors


def write_store(store: DataFrame, path: str) -> None:
    """Vectors partitioned by provider; only the providers present are replaced.

    There is no shuffle by provider: each task writes its own file per provider it holds,
    so one big provider is written by all tasks.
    """
    (
        store.select("provider", "doc_id", F.col("embedding").cast("array<float>"))
        .write.partitionBy("provider")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def manifest_rows(store: DataFrame, path: str) -> DataFrame:
    """Manifest entries from a store with ``completed_at`` (timestamp)."""
    return store.groupBy("provider").agg(
        F.count("*").alias("num_embeddings"), F.max("completed_at").alias("completed_at")
    ).select(
        "provider",
        F.concat(F.lit("provider="), "provider").alias("file"),
        F.concat(F.lit(f"{path}/provider="), "provider").alias("filepath"),
        F.date_format("completed_at", "yyyy-MM-dd'T'HH:mm:ss").alias("completed_at"),
        "num_embeddings",
    )


def write_manifest(entries: DataFrame, path: str) -> None:
    """One JSON object; its size is one entry per provider."""
    fields = [c for c in entries.columns if c != "provider"]
    packed = F.collect_list(F.struct("provider", F.struct(*fields)))
    entries.agg(F.map_from_entries(packed).alias("providers")).coalesce(1).write.mode(
        "overwrite"
    ).json(path)


def publish(df: DataFrame, root: str) -> str:
    """Write a new version folder, then append one pointer row to it.

    A version without a pointer is invisible, so a broken run leaves the last one in use.
    """
    spark = df.sparkSession
    version = f"{root}/versions/{uuid.uuid4().hex}"
    df.write.parquet(version)
    pointer = spark.range(1).select(
        F.lit(version).alias("path"), F.unix_micros(F.current_timestamp()).alias("published")
    )
    pointer.write.mode("append").json(f"{root}/pointer")
    return version


def read_published(spark: SparkSession, root: str) -> DataFrame:
    pointers = spark.read.schema("path string, published bigint").json(f"{root}/pointer")
    current = pointers.agg(F.max_by("path", F.struct("published", "path"))).first()[0]
    return spark.read.parquet(current)


def write_docs_parquet(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").parquet(path)


def write_docs_csv(docs: DataFrame, path: str) -> None:
    """CSV without the vector columns."""
    write_csv(without_vectors(docs), path)


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_ndjson(docs: DataFrame, path: str, drop: tuple[str, ...] = ("content",)) -> None:
    """One JSON object per line, without text and vectors."""
    keep = [c for c in docs.columns if c not in drop and not c.startswith(VECTOR_PREFIX)]
    docs.select([f"`{c}`" for c in keep]).write.mode("overwrite").option(
        "ignoreNullFields", False
    ).json(path)


def write_json_row(df: DataFrame, path: str) -> None:
    """A report of one row, nulls kept."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_topic_csv(topics: DataFrame, path: str) -> None:
    """Topic table with its arrays joined to strings."""
    arrays = {f.name for f in topics.schema if f.dataType.typeName() == "array"}
    flat = [F.array_join(c, ", ").alias(c) if c in arrays else F.col(c) for c in topics.columns]
    write_csv(topics.select(*flat), path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Request bodies (project, value), one per line, in a folder per project."""
    lines.write.mode("overwrite").partitionBy("project").text(path)


def json_sample(df: DataFrame, n: int = 3, *order: str) -> DataFrame:
    """The first ``n`` rows as JSON text, for a look."""
    rows = df.orderBy(*order) if order else df
    return rows.limit(n).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def save_tables(tables: dict[str, DataFrame], path: str) -> None:
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def load_tables(spark: SparkSession, path: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}

