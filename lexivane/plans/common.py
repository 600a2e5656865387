"""Registry of queries with their SQL counterparts, and the tables both derive from.

Every derived table exists twice: as a DataFrame function and as an SQL text. They are
computed from the given tables, whole, so the work of every query grows with the data.
"""

from __future__ import annotations

from functools import wraps
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import tokens
from ..session import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the given time stamps carry no zone; both sides read them as UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if name == "events" else df


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for work on their whole texts, over all cores."""
    return spread(docs(spark, sf_dir), "doc_id")


# --- the corpus: documents under url and content, with metadata ----------------------

CORPUS_SQL = """
SELECT 'https://corpus.example/' || lang || '/' || source || '?id=' || doc_id AS url,
       text AS content, lang, source, CAST(1500 + doc_id % 10 AS INTEGER) AS year, n_chars,
       doc_id
FROM documents"""


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select(
        F.concat(
            F.lit("https://corpus.example/"), "lang", F.lit("/"), "source", F.lit("?id="), "doc_id"
        ).alias("url"),
        F.col("text").alias("content"),
        "lang",
        "source",
        (1500 + F.col("doc_id") % 10).cast("int").alias("year"),
        "n_chars",
        "doc_id",
    )


# --- three providers: complete, partly failed, sparse --------------------------------

ALPHA, BETA, GAMMA = "alpha-text_embed-3-large", "beta_embed-v4.0_search", "gamma_mini"

STORE_SQL = f"""
SELECT '{ALPHA}' AS provider, vec_id AS doc_id, embedding,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(60 * vec_id) AS completed_at
FROM embeddings
UNION ALL
SELECT '{BETA}', vec_id, CASE WHEN quality = 1 THEN embedding[1:32] ELSE embedding[1:0] END,
       TIMESTAMP '2024-01-02 00:00:00' + to_seconds(60 * vec_id)
FROM embeddings JOIN labels ON doc_id = vec_id
UNION ALL
SELECT '{GAMMA}', vec_id, embedding,
       TIMESTAMP '2024-01-03 00:00:00' + to_seconds(60 * vec_id)
FROM embeddings JOIN labels ON doc_id = vec_id WHERE toxic = 1"""


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")
    marked = vectors.join(table(spark, sf_dir, "labels"), "doc_id")
    day = lambda n: F.timestamp_seconds(F.lit(1704067200 + 86400 * n) + 60 * F.col("doc_id"))
    row = lambda df, name, vector, n: df.select(
        F.lit(name).alias("provider"), "doc_id", vector.alias("embedding"), day(n).alias("completed_at")
    )
    half = F.when(F.col("quality") == 1, F.slice("embedding", 1, 32)).otherwise(
        F.slice("embedding", 1, 0)
    )
    return (
        row(vectors, ALPHA, F.col("embedding"), 0)
        .unionByName(row(marked, BETA, half, 1))
        .unionByName(row(marked.filter("toxic = 1"), GAMMA, F.col("embedding"), 2))
    )


PROVIDERS_SQL = f"""
SELECT unnest(['{ALPHA}', '{BETA}', '{GAMMA}', 'delta_none']) AS provider"""


def providers(spark: SparkSession) -> DataFrame:
    """The configured providers; one of them has no vectors."""
    return spark.createDataFrame([(p,) for p in (ALPHA, BETA, GAMMA, "delta_none")], "provider string")


# --- vectors with text: documents that have an embedding, its label as topic ---------

LABELLED_SQL = """
SELECT doc_id, text, lang, CAST(label AS BIGINT) AS topic, embedding
FROM documents JOIN embeddings ON doc_id = vec_id"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("bigint").alias("topic"), "embedding"
    )
    return texts(spark, sf_dir).select("doc_id", "text", "lang").join(vectors, "doc_id")


VECTORS_SQL = """
SELECT vec_id AS doc_id, CAST(label AS BIGINT) AS topic, embedding FROM embeddings"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("bigint").alias("topic"), "embedding"
    )


# --- the request log: events as requests ---------------------------------------------

LOG_SQL = """
SELECT event_id, ts, event_type AS provider, user_id AS doc_id,
       CASE WHEN value < 20 THEN 429 WHEN value < 25 THEN 500 ELSE 200 END AS http_status,
       value / 100 AS duration_s
FROM events"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("event_type").alias("provider"),
        F.col("user_id").alias("doc_id"),
        F.when(value < 20, 429).when(value < 25, 500).otherwise(200).alias("http_status"),
        (value / 100).alias("duration_s"),
    )


ATTEMPTS_SQL = """
SELECT event_type AS provider, user_id AS doc_id, event_id AS attempt, ts,
       CASE WHEN value > 110 THEN 'ok' ELSE 'failed' END AS status,
       CASE WHEN value < 20 THEN 429 WHEN value < 25 THEN 500 ELSE 200 END AS http_status,
       CASE WHEN value < 20 THEN 'HTTP 429' WHEN value < 25 THEN 'HTTP 500'
            WHEN value <= 110 THEN 'no vector' END AS error
FROM events"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("provider"),
        F.col("user_id").alias("doc_id"),
        F.col("event_id").alias("attempt"),
        "ts",
        F.when(value > 110, "ok").otherwise("failed").alias("status"),
        F.when(value < 20, 429).when(value < 25, 500).otherwise(200).alias("http_status"),
        F.when(value < 20, "HTTP 429")
        .when(value < 25, "HTTP 500")
        .when(value <= 110, "no vector")
        .alias("error"),
    )


# --- words: stop words, seeds, term arrays by topic, class and period ----------------

TOKENS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"

def units_sql(source: str, key: str) -> str:
    """(key, text, g, u): the gaps between tokens, and every token with the gap behind it."""
    token = r"[\p{L}\p{N}_]{2,}"
    return f"""
    SELECT {key}, text, g, [x || g[i + 1] FOR x, i IN a] AS u FROM (
      SELECT {key}, text, regexp_extract_all(text, '{token}') AS a, string_split_regex(text, '{token}') AS g
      FROM {source})"""


STOP_SQL = f"""
SELECT w AS word FROM (SELECT unnest(list_distinct({TOKENS_SQL})) AS w FROM documents)
GROUP BY w ORDER BY count(*) DESC, w LIMIT 25"""


def stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 words found in most documents, as a stop list."""
    words = texts(spark, sf_dir).select(F.explode(F.array_distinct(tokens("text"))).alias("word"))
    return words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(25).select("word")


SEEDS_SQL = f"SELECT DISTINCT unnest({TOKENS_SQL}) AS term FROM benchmark"


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.explode(tokens("text")).alias("term")).distinct()


def classed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with source as topic, lang as class and a period."""
    return texts(spark, sf_dir).select(
        "doc_id",
        "text",
        F.expr("substring(source, 4)").cast("bigint").alias("topic"),
        "lang",
        (F.col("doc_id") % 10).alias("period"),
    )


def grams_sql(n: int = 3, source: str = "documents") -> str:
    """CTEs ``stop``, ``words`` and ``grams`` (doc_id, topic, lang, period, term)."""
    parts = ["t"]
    if n > 1:
        parts.append("[t[i] || ' ' || t[i+1] FOR i IN range(1, len(t))]")
    if n > 2:
        parts.append("[t[i] || ' ' || t[i+1] || ' ' || t[i+2] FOR i IN range(1, len(t) - 1)]")
    return f"""
stop AS ({STOP_SQL}),
stops AS (SELECT list(word) AS sw FROM stop),
words AS (
  SELECT doc_id, CAST(substr(source, 4) AS BIGINT) AS topic, lang, doc_id % 10 AS period,
         [w FOR w IN {TOKENS_SQL} IF NOT list_contains(sw, w)] AS t
  FROM documents, stops),
grams AS (
  SELECT doc_id, topic, lang, period, unnest({' || '.join(parts)}) AS term FROM words)"""


def weights_sql(n: int = 3, seeded: bool = True, min_df: int = 6) -> str:
    """CTEs up to ``weights`` (topic, term, tf, total, idf, score) after ``grams``."""
    boost = "CASE WHEN term IN (SELECT term FROM seed) THEN 10.0 ELSE 1.0 END" if seeded else "1.0"
    return f"""
{grams_sql(n)},
seed AS ({SEEDS_SQL}),
vocab AS (
  SELECT term, count(*) AS f, count(DISTINCT doc_id) AS df FROM grams GROUP BY term
  HAVING count(DISTINCT doc_id) >= {min_df} ORDER BY f DESC, term LIMIT 100000),
tfs AS (SELECT topic, term, count(*) AS tf FROM grams SEMI JOIN vocab USING (term) GROUP BY ALL),
totals AS (SELECT topic, sum(tf) AS total FROM tfs GROUP BY topic),
idfs AS (
  SELECT term, ln(1 + (SELECT avg(total) FROM totals) / f) * {boost} AS idf FROM vocab),
weights AS (
  SELECT topic, term, tf, total, idf, sqrt(tf / total) * idf AS score
  FROM tfs JOIN totals USING (topic) JOIN idfs USING (term))"""


# --- hashed-word vectors in SQL, for the embedding step ------------------------------


def hashed_sql(source: str, key: str, dimensions: int, limit: int = 512) -> str:
    """CTE ``pooled`` (key, n_chunks, dim, value): chunk, hash, pool by characters, unit length."""
    tok = TOKENS_SQL
    return f"""
toks AS (SELECT {key}, g, u, {tok} AS t FROM ({units_sql(source, key)})),
pieces AS (
  SELECT {key}, i // {limit} AS chunk_no, t[i+1:i+{limit}] AS words,
         CASE WHEN i = 0 THEN g[1] ELSE '' END || array_to_string(u[i+1:i+{limit}], '') AS chunk
  FROM (SELECT {key}, g, u, t, unnest(range(0, len(t), {limit})) AS i FROM toks)),
weighed AS (SELECT {key}, chunk_no, words, length(chunk) AS weight FROM pieces),
placed AS (
  SELECT {key}, chunk_no, weight,
         CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {dimensions} AS dim, count(*) AS n
  FROM (SELECT {key}, chunk_no, weight, unnest(words) AS w FROM weighed) GROUP BY ALL),
units AS (
  SELECT *, n / sqrt(sum(n * n) OVER (PARTITION BY {key}, chunk_no)) AS x FROM placed),
spread AS (
  SELECT {key}, count(*) AS n_chunks, sum(weight) AS mass FROM weighed GROUP BY {key}),
means AS (
  SELECT {key}, any_value(n_chunks) AS n_chunks, dim, sum(weight * x) / any_value(mass) AS y
  FROM units JOIN spread USING ({key}) GROUP BY {key}, dim),
pooled AS (
  SELECT {key}, n_chunks, dim, y / sqrt(sum(y * y) OVER (PARTITION BY {key})) AS value FROM means)"""
