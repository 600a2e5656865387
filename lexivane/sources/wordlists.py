"""Reading seed words and stop words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def parse_seed_lines(lines: DataFrame, column: str = "value", key: str | None = None) -> DataFrame:
    """Seed lists: right-trimmed lines split at commas, one row per word and position."""
    lemma = F.col(key) if key else F.xxhash64(column)
    return lines.select(
        lemma.alias("lemma_id"),
        F.posexplode(F.split(F.regexp_replace(column, r"\s+$", ""), ",")).alias("pos", "word"),
    )


def read_seed_words(spark: SparkSession, path: str) -> DataFrame:
    return parse_seed_lines(spark.read.text(path))


def seed_terms(seeds: DataFrame) -> DataFrame:
    """Flat, trimmed, lower-case seed terms for boosting."""
    term = F.trim(F.lower("word"))
    return seeds.select(term.alias("term")).filter(F.col("term") != "").distinct()


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("word"))
