"""Structured Streaming over the request log and the documents, run until all input is read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import embed
from ..session import work_dir
from ..streaming import streams
from .common import LOG_SQL, log, query, table, texts

LOG_TYPES = (
    "event_id bigint, ts timestamp, provider string, doc_id bigint, http_status int, duration_s double"
)


PARTS = 4


def replay(spark: SparkSession, sf_dir: str, transform: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """The request log in ``PARTS`` arrivals in time order, through ``transform``, as a keyed table.

    Every arrival is a part of the log that is written down, and a run of the query that goes on
    from the checkpoint of the one before. Updates of a key replace what earlier batches said of
    it, so windows that are still open at the end are in the table as well.
    """
    staged, incoming, out, state = (work_dir(spark, x) for x in ("staged", "log", "out", "state"))
    rows = log(spark, sf_dir)
    span = rows.agg(F.min(F.unix_micros("ts")).alias("a"), F.max(F.unix_micros("ts")).alias("b")).first()
    if span["a"] is None:
        return spark.createDataFrame([], transform(rows).schema)
    width = (span["b"] - span["a"]) // PARTS + 1
    part = F.floor((F.unix_micros("ts") - span["a"]) / width).alias("part")
    rows.select("*", part).write.partitionBy("part").parquet(staged)
    schema = None

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    for i in range(PARTS):
        spark.read.schema(LOG_TYPES).parquet(f"{staged}/part={i}").write.mode("append").parquet(incoming)
        changed = transform(spark.readStream.schema(LOG_TYPES).parquet(incoming))
        schema = changed.schema
        changed.writeStream.outputMode("update").option("checkpointLocation", state).trigger(
            availableNow=True
        ).foreachBatch(keep).start().awaitTermination()
    written = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(out)
    return written.groupBy(*keys).agg(F.max_by(F.struct(*schema.names), "batch").alias("last")).select("last.*")


@query(
    "t01_incremental_embedding",
    r"""SELECT doc_id, CASE WHEN len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) > 0
               THEN 'ok' ELSE 'failed' END AS status FROM documents""",
)
def t01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a growing folder: the second one embeds only what is new."""
    source, store, state = (work_dir(spark, x) for x in ("incoming", "store", "state"))
    rows = texts(spark, sf_dir).select("doc_id", "text")
    marked = table(spark, sf_dir, "labels").select("doc_id")
    embedder = embed.make_embedder("hashed_words")
    for part in (rows.join(marked, "doc_id", "left_semi"), rows):
        part.write.mode("append").parquet(source)
        streams.incremental_embedding(
            spark, source, rows.schema, store, state, embedder
        ).awaitTermination()
    kept = spark.read.parquet(store)
    # each stored document once: a failed one is tried again, its last try counts
    return kept.groupBy("doc_id").agg(F.max_by("status", "batch").alias("status"))


def windows_sql(seconds: int, where: str, slide: int | None = None) -> str:
    """Counts of all windows: what a batch over the whole log gives."""
    slide = slide or seconds
    return f"""
    SELECT provider, start, count(*) AS n FROM (
      SELECT provider, unnest([epoch_us(ts) // {slide * 1_000_000} * {slide} - {slide} * i FOR i IN range({seconds // slide})]) AS start
      FROM ({LOG_SQL}) WHERE {where}) GROUP BY ALL"""


@query(
    "t02_progress_rate",
    f"SELECT provider, start, n AS items, round(n / 30, 6) AS items_per_s FROM ({windows_sql(30, 'http_status < 400')})",
)
def t02(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = replay(spark, sf_dir, streams.progress_rate, ["provider", "start"])
    return rows.select(
        "provider", F.unix_seconds("start").alias("start"), "items",
        F.round("items_per_s", 6).alias("items_per_s"),
    )


def quota(spark: SparkSession, sf_dir: str, slide: str | None = None) -> DataFrame:
    rows = replay(spark, sf_dir, lambda s: streams.quota_use(s, 70, "1 day", slide), ["provider", "start"])
    return rows.withColumn("start", F.unix_seconds("start"))


@query(
    "t03_quota_use",
    f"SELECT provider, start, n AS requests, n > 70 * 0.95 AS over FROM ({windows_sql(86_400, 'true')})",
)
def t03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota(spark, sf_dir)


@query(
    "t03_sliding_quota",
    f"SELECT provider, start, n AS requests, n > 70 * 0.95 AS over FROM ({windows_sql(86_400, 'true', 21_600)})",
)
def t03_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quota(spark, sf_dir, "6 hours")


@query(
    "t05_first_results",
    "SELECT event_type AS provider, user_id AS doc_id, 1::BIGINT AS n FROM events GROUP BY ALL",
)
def t05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within a watermark wider than the log every (provider, doc) comes out once, restarts or not."""
    rows = replay(
        spark, sf_dir, lambda s: streams.first_results(s, "60 days").select("provider", "doc_id", "event_id"), ["event_id"]
    )
    return rows.groupBy("provider", "doc_id").agg(F.count("*").alias("n"))
