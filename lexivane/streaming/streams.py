"""Structured Streaming: incremental embedding, rates, quotas, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.coverage import work_list
from ..operators.embed import Embedder, embed_docs

SAFETY_MARGIN = 0.95


def incremental_embedding(
    spark: SparkSession, source: str, schema: T.StructType, store: str, checkpoint: str,
    embedder: Embedder, interval: str | None = None, max_files: int = 100,
) -> StreamingQuery:
    """Embed new documents as their files arrive and append them to a partitioned store.

    Each micro-batch embeds only the documents the store lacks. A batch that is run again
    after a failure overwrites its own folder, so nothing is written twice. ``interval``
    bounds the work that a stop can lose; without it, all files present are processed and
    the query ends.
    """
    provider = embedder.identifier()
    store_schema = "doc_id bigint, embedding array<float>, status string, error string, provider string, batch bigint"

    def process(batch: DataFrame, number: int) -> None:
        stored = spark.read.schema(store_schema).parquet(store)
        done = stored.filter(
            (F.col("provider") == provider) & (F.col("batch") != number) & (F.col("status") == "ok")
        )
        # of texts that share an id in one batch, the first in text order counts
        first = batch.groupBy("doc_id").agg(F.min("text").alias("text"))
        todo = work_list(first, done)
        result = embed_docs(todo, embedder)
        result.select(
            "doc_id", F.col("embedding").cast("array<float>"), "status", "error"
        ).write.mode("overwrite").parquet(f"{store}/provider={provider}/batch={number}")

    spark.createDataFrame([], store_schema).write.mode("append").partitionBy(
        "provider", "batch"
    ).parquet(store)
    writer = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(source)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def progress_rate(
    requests: DataFrame, span: str = "30 seconds", delay: str = "10 minutes", key: str = "provider"
) -> DataFrame:
    """Successful items per provider and time span, with items per second."""
    seconds = F.unix_seconds("window.end") - F.unix_seconds("window.start")
    counted = (
        requests.withWatermark("ts", delay)
        .filter(F.col("http_status") < 400)
        .groupBy(F.window("ts", span), key)
        .agg(F.count("*").alias("items"))
    )
    return counted.select(
        key,
        F.col("window.start").alias("start"),
        "items",
        (F.col("items") / seconds).alias("items_per_s"),
    )


def quota_use(
    requests: DataFrame, limit: int, span: str, slide: str | None = None,
    delay: str = "10 minutes", margin: float = SAFETY_MARGIN, key: str = "provider",
) -> DataFrame:
    """Requests per tumbling or sliding window against ``limit * margin``."""
    window = F.window("ts", span, slide) if slide else F.window("ts", span)
    counted = (
        requests.withWatermark("ts", delay).groupBy(window, key).agg(F.count("*").alias("requests"))
    )
    return counted.select(
        key,
        F.col("window.start").alias("start"),
        "requests",
        (F.col("requests") > limit * margin).alias("over"),
    )


def first_results(results: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """One result per (provider, doc) within the watermark."""
    return results.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["provider", "doc_id"])
