"""Coverage of the corpus by language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import token_count
from .common import TOKENS_SQL, query, table, texts

MIN_TOKENS = 10

SQL = f"""
SELECT lang, count(*) AS docs, count(embedding) AS vectors,
       CAST(max(len(embedding)) AS BIGINT) AS dimension,
       CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(max(length(text)) AS BIGINT) AS longest
FROM (SELECT *, len({TOKENS_SQL}) AS n_tokens FROM documents) LEFT JOIN embeddings ON vec_id = doc_id
WHERE n_tokens >= {MIN_TOKENS} GROUP BY lang"""


@query("coverage_by_language", SQL)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The length test sits in the aggregates: as a filter Catalyst would move it below the
    # redistribution of the texts and count the tokens twice.
    counted = texts(spark, sf_dir).select(
        "doc_id", "lang", F.length("text").alias("n"), token_count("text").alias("tokens")
    )
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.size("embedding").alias("d")
    )
    enough = F.col("tokens") >= MIN_TOKENS
    by_language = counted.join(vectors, "doc_id", "left").groupBy("lang").agg(
        F.count_if(enough).alias("docs"),
        F.count(F.when(enough, F.col("d"))).alias("vectors"),
        F.max(F.when(enough, F.col("d"))).cast("bigint").alias("dimension"),
        F.sum(F.when(enough, F.col("tokens"))).alias("tokens"),
        F.max(F.when(enough, F.col("n"))).cast("bigint").alias("longest"),
    )
    return by_language.filter("docs > 0")
