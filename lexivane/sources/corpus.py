"""Reading paragraph corpora: CSV and parquet scans, snapshots, pages, row positions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import durable

VECTOR_PREFIX = "embeddings_"
REQUIRED = ("url", "content")

# Fixed value: the column names of the published corpus file.
CORPUS_SCHEMA = (
    "url string, xmlid string, lang string, wid string, `author-id` string, "
    "`author-name` string, title string, year int, passage string, "
    "`citation-recommendation` string, content string"
)


def read_csv(
    spark: SparkSession, path: str, schema: str = CORPUS_SCHEMA, header: bool = True,
    index_column: bool = False,
) -> DataFrame:
    """CSV with quoted fields that may hold separators, quotes and line breaks.

    ``index_column`` reads the older form whose first column is an unnamed row index.
    Quoted line breaks make one file one task, so large corpora should come in many files.
    """
    if index_column:
        schema = f"__index bigint, {schema}"
    df = (
        spark.read.schema(schema)
        .option("header", header)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return df.drop("__index") if index_column else df


def require_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def vector_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(VECTOR_PREFIX)]


def without_vectors(df: DataFrame) -> DataFrame:
    return df.select([f"`{c}`" for c in df.columns if not c.startswith(VECTOR_PREFIX)])


def read_docs_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Docs without their vector columns; the parquet scan never touches those."""
    return without_vectors(spark.read.parquet(path))


def read_docs(
    spark: SparkSession, directory: str, stem: str = "all_docs", schema: str = CORPUS_SCHEMA
) -> DataFrame:
    """``{stem}.parquet`` if present, else ``{stem}.csv``, else an error."""
    try:
        return read_docs_parquet(spark, f"{directory}/{stem}.parquet")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    try:
        return without_vectors(read_csv(spark, f"{directory}/{stem}.csv", schema))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    raise FileNotFoundError(f"no {stem} in parquet or CSV form below {directory}")


def latest_snapshot(spark: SparkSession, directory: str, pattern: str) -> str:
    """Path of the snapshot folder with the newest file, of those that match ``pattern``.

    Files are listed, not opened: one row per file, and one row comes back.
    """
    found = (
        spark.read.format("binaryFile").load(f"{directory}/{pattern}")
        .select(
            F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
            F.col("modificationTime").alias("modified"),
        )
        .groupBy("folder")
        .agg(F.max("modified").alias("modified"))
        .agg(F.max_by("folder", F.struct("modified", "folder")))
        .first()
    )
    if found is None or found[0] is None:
        raise FileNotFoundError(f"nothing matches {pattern} below {directory}")
    return found[0]


def first_rows(df: DataFrame, max_documents: int, *order: str | Column) -> DataFrame:
    """The first ``max_documents`` rows in key order; a negative number keeps all."""
    return df if max_documents < 0 else df.orderBy(*order).limit(max_documents)


def page(df: DataFrame, offset: int, limit: int, *order: str | Column) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def with_row_index(
    df: DataFrame, order: list[str], key: str, name: str = "row_idx"
) -> DataFrame:
    """Add the 0-based position of every row in a total order.

    ``order`` lists columns, a leading ``-`` meaning descending. The ordering columns
    alone are range-partitioned, sorted and numbered inside their partition, then shifted
    by the sizes of the partitions before. Only the per-partition counts meet in one task.
    Writing the numbers down pins the partition borders, which both uses must share. The
    numbers are as many as the rows and compress to little on disk, so their join is a merge
    join: by its size on disk either side would be broadcast.
    """
    names = [o.lstrip("-") for o in order]
    by = [F.col(o[1:]).desc() if o.startswith("-") else F.col(o).asc() for o in order]
    slim = df.select(*dict.fromkeys([key, *names]))
    numbered = durable(
        slim.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select(
            F.col(key).alias("__key"),
            F.spark_partition_id().alias("__part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__local"),
        )
    )
    counts = numbered.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    index = numbered.join(offsets, "__part").select(
        F.col("__key").alias(key), (F.col("__local") + F.col("__offset")).alias(name)
    )
    return df.join(index.hint("merge"), key)


def with_page_id(
    df: DataFrame, page_size: int, key: str, name: str = "page_id"
) -> DataFrame:
    """Page number of every row for fixed-size pages in key order."""
    indexed = with_row_index(df, [key], key)
    return indexed.withColumn(name, F.floor(F.col("row_idx") / page_size).cast("bigint"))
