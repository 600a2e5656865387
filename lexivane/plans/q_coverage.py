"""Work lists, merges, statistics, failure classes, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.vector import as_double
from ..operators import coverage
from ..sources import vectors as stores
from .common import (
    ALPHA, ATTEMPTS_SQL, BETA, GAMMA, PROVIDERS_SQL, STORE_SQL, attempts, corpus, docs, providers,
    query, store, table,
)
from .q_sources import STATISTICS_SQL


def one(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return stores.provider_vectors(store(spark, sf_dir), name)


def first_value(column: str = "embedding"):
    """A checkable number of a vector: its first element, six digits."""
    return F.round(F.get(as_double(column), F.lit(0)), 6)


ONE_SQL = "SELECT doc_id, embedding FROM ({s}) WHERE provider = '{p}'"


@query(
    "j01_left_join_vectors",
    f"""SELECT doc_id, lang, round(v.embedding[1]::DOUBLE, 6) AS first FROM documents
        LEFT JOIN ({ONE_SQL.format(s=STORE_SQL, p=ALPHA)}) v USING (doc_id)""",
)
def j01(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", "lang")
    joined = stores.attach_vectors(rows, one(spark, sf_dir, ALPHA), "doc_id")
    return joined.select("doc_id", "lang", first_value().alias("first"))


@query(
    "j02_providers_as_columns",
    f"""SELECT doc_id, round(a.embedding[1]::DOUBLE, 6) AS alpha, round(b.embedding[1]::DOUBLE, 6) AS beta,
               round(g.embedding[1]::DOUBLE, 6) AS gamma FROM documents
        LEFT JOIN ({ONE_SQL.format(s=STORE_SQL, p=ALPHA)}) a USING (doc_id)
        LEFT JOIN ({ONE_SQL.format(s=STORE_SQL, p=BETA)}) b USING (doc_id)
        LEFT JOIN ({ONE_SQL.format(s=STORE_SQL, p=GAMMA)}) g USING (doc_id)""",
)
def j02(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id")
    wide = stores.attach_providers(rows, store(spark, sf_dir), [ALPHA, BETA, GAMMA], "doc_id")
    return wide.select(
        "doc_id",
        *[
            first_value(f"`embeddings_{p}`").alias(name)
            for p, name in ((ALPHA, "alpha"), (BETA, "beta"), (GAMMA, "gamma"))
        ],
    )


DONE_SQL = f"SELECT doc_id FROM ({STORE_SQL}) WHERE provider = '{BETA}' AND len(embedding) > 0"
KEPT_SQL = f"SELECT doc_id FROM ({STORE_SQL}) WHERE provider = '{BETA}'"


@query(
    "j05_work_list",
    f"""SELECT doc_id, doc_id NOT IN ({KEPT_SQL}) AS also_if_empty_is_done FROM documents
        WHERE doc_id NOT IN ({DONE_SQL})""",
)
def j05(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, beta = docs(spark, sf_dir).select("doc_id"), one(spark, sf_dir, BETA)
    strict = coverage.work_list(rows, beta)
    lenient = coverage.work_list(rows, beta, empty_is_done=True).withColumn("x", F.lit(True))
    return strict.join(lenient, "doc_id", "left").select(
        "doc_id", F.coalesce("x", F.lit(False)).alias("also_if_empty_is_done")
    )


@query("j06_already_done", f"SELECT doc_id FROM documents WHERE doc_id IN ({DONE_SQL})")
def j06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.already_done(docs(spark, sf_dir).select("doc_id"), one(spark, sf_dir, BETA))


@query(
    "j07_merge_by_document",
    f"""SELECT doc_id, string_agg(provider, ',' ORDER BY provider) AS providers,
               CAST(sum(len(embedding)) AS BIGINT) AS total_dim FROM ({STORE_SQL}) GROUP BY doc_id""",
)
def j07(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = coverage.by_document(store(spark, sf_dir))
    size = F.aggregate(F.map_values("embeddings"), F.lit(0), lambda acc, v: acc + F.size(v))
    return merged.select(
        "doc_id",
        F.array_join(F.array_sort(F.map_keys("embeddings")), ",").alias("providers"),
        size.cast("bigint").alias("total_dim"),
    )


def renewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer vectors of the labelled docs for the first provider: the old ones, negated."""
    ids = table(spark, sf_dir, "labels").select("doc_id")
    old = one(spark, sf_dir, ALPHA).join(ids, "doc_id", "left_semi")
    return old.select(
        "provider",
        "doc_id",
        F.transform("embedding", lambda x: -x).alias("embedding"),
        F.timestamp_seconds(F.unix_seconds("completed_at") + 86400).alias("completed_at"),
    )


@query(
    "j08_cached_and_new",
    f"""SELECT doc_id, round((CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN -1 ELSE 1 END)
               * embedding[1]::DOUBLE, 6) AS first
        FROM ({STORE_SQL}) WHERE provider = '{ALPHA}' AND doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')""",
)
def j08(spark: SparkSession, sf_dir: str) -> DataFrame:
    needed = docs(spark, sf_dir).filter("lang = 'en'").select("doc_id")
    merged = coverage.merge_cached(one(spark, sf_dir, ALPHA), renewed(spark, sf_dir), needed)
    return merged.select("doc_id", first_value().alias("first"))


def manifest_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows that lack one stored provider, and list one with nothing stored."""
    kept = store(spark, sf_dir).filter(F.col("provider") != GAMMA)
    rows = kept.groupBy("provider").agg(F.count("*").alias("num_embeddings"))
    extra = providers(spark).filter("provider = 'delta_none'").withColumn(
        "num_embeddings", F.lit(0).cast("bigint")
    )
    return rows.unionByName(extra)


MANIFEST_OF_SQL = f"""
SELECT provider, count(*) AS num_embeddings FROM ({STORE_SQL}) WHERE provider <> '{GAMMA}' GROUP BY provider
UNION ALL SELECT 'delta_none', 0"""


@query(
    "j15_skip_decision",
    f"""SELECT p.provider, CASE WHEN num_embeddings IS NULL THEN 'process'
               WHEN num_embeddings > 0 AND stored > 0 THEN 'skip' ELSE 'redo' END AS decision
        FROM ({PROVIDERS_SQL}) p LEFT JOIN ({MANIFEST_OF_SQL}) m USING (provider)
        LEFT JOIN (SELECT provider, count(*) AS stored FROM ({STORE_SQL}) GROUP BY provider) s USING (provider)""",
)
def j15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.skip_decision(
        providers(spark), manifest_of(spark, sf_dir), store(spark, sf_dir)
    )


# --- statistics ----------------------------------------------------------------------


@query("a01_provider_statistics", STATISTICS_SQL)
def a01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.provider_statistics(attempts(spark, sf_dir))


FAILED_SQL = f"""
SELECT provider, doc_id, arg_max(error, attempt) AS error FROM ({ATTEMPTS_SQL})
GROUP BY provider, doc_id HAVING NOT bool_or(status = 'ok')"""


@query("a01_failed_docs", FAILED_SQL)
def a01_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.failed_docs(attempts(spark, sf_dir))


@query(
    "a02_embeddings_per_provider",
    f"""SELECT provider, count(*) AS rows, count(*) FILTER (len(embedding) > 0) AS vectors,
               CAST(max(len(embedding)) AS BIGINT) AS dimension FROM ({STORE_SQL}) GROUP BY provider""",
)
def a02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.store_counts(store(spark, sf_dir))


@query(
    "a03_describe_lengths",
    """SELECT lang, count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
              CAST(min(n) AS BIGINT) AS min, round(quantile_cont(n, 0.25), 6) AS p25,
              round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.75), 6) AS p75,
              CAST(max(n) AS BIGINT) AS max
       FROM (SELECT lang, length(text) AS n FROM documents) GROUP BY lang""",
)
def a03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles are linearly interpolated. They are exact: the values are counted first."""
    rows = docs(spark, sf_dir).select("lang", F.length("text").alias("n"))
    counted = rows.groupBy("lang", "n").agg(F.count("*").alias("c"))
    at = lambda p: F.round(F.percentile("n", F.lit(p), F.col("c")), 6)
    basic = rows.groupBy("lang").agg(
        F.count("*").alias("count"),
        F.round(F.avg("n"), 6).alias("mean"),
        F.round(F.stddev("n"), 6).alias("std"),
        F.min("n").cast("bigint").alias("min"),
        F.max("n").cast("bigint").alias("max"),
    )
    quartiles = counted.groupBy("lang").agg(
        at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75")
    )
    return basic.join(quartiles, "lang")


@query(
    "a04_failure_classes",
    f"""SELECT doc_id, CASE WHEN f = 5 THEN 'critical' WHEN f > 0 THEN 'partial' ELSE 'full' END AS failure_class
        FROM (SELECT DISTINCT user_id AS doc_id FROM events)
        LEFT JOIN (SELECT doc_id, count(*) AS f FROM ({FAILED_SQL}) GROUP BY doc_id) USING (doc_id)""",
)
def a04(spark: SparkSession, sf_dir: str) -> DataFrame:
    tried = attempts(spark, sf_dir)
    return coverage.failure_classes(
        tried.select("doc_id").distinct(), coverage.failed_docs(tried), 5
    )


@query(
    "a05_failure_preview",
    f"""SELECT provider, count(*) AS failed, array_to_string(list(doc_id ORDER BY doc_id)[1:10], ',') AS shown,
               greatest(count(*) - 10, 0) AS more FROM ({FAILED_SQL}) GROUP BY provider""",
)
def a05(spark: SparkSession, sf_dir: str) -> DataFrame:
    preview = coverage.failure_preview(coverage.failed_docs(attempts(spark, sf_dir)), 10)
    return preview.withColumn("shown", F.array_join(F.col("shown").cast("array<string>"), ","))


@query(
    "a06_failures_per_provider",
    f"SELECT provider, count(*) AS failed FROM ({FAILED_SQL}) GROUP BY provider",
)
def a06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.failures_per_provider(coverage.outcomes(attempts(spark, sf_dir)))


@query(
    "a20_processed_counts",
    f"""SELECT p.provider, coalesce(n, 0) AS documents_processed FROM ({PROVIDERS_SQL}) p
        LEFT JOIN (SELECT provider, count(*) AS n FROM ({STORE_SQL}) WHERE len(embedding) > 0
                   GROUP BY provider) USING (provider)""",
)
def a20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.processed_counts(providers(spark), store(spark, sf_dir))


@query(
    "a21_store_health",
    f"""SELECT provider, stored, num_embeddings AS listed,
               CASE WHEN stored IS NULL THEN 'not in store' WHEN num_embeddings IS NULL THEN 'not in manifest'
                    WHEN stored <> num_embeddings THEN 'counts differ' ELSE 'ok' END AS state
        FROM (SELECT provider, count(*) AS stored FROM ({STORE_SQL}) GROUP BY provider)
        FULL JOIN ({MANIFEST_OF_SQL}) USING (provider)""",
)
def a21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.store_health(store(spark, sf_dir), manifest_of(spark, sf_dir))


@query(
    "w10_latest_vector",
    f"""SELECT doc_id, round((CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN -1 ELSE 1 END)
               * embedding[1]::DOUBLE, 6) AS first,
               CAST(epoch(completed_at) AS BIGINT) + CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 86400 ELSE 0 END AS at
        FROM ({STORE_SQL}) WHERE provider = '{ALPHA}'""",
)
def w10(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = one(spark, sf_dir, ALPHA).unionByName(renewed(spark, sf_dir))
    return coverage.latest(both).select(
        "doc_id", first_value().alias("first"), F.unix_seconds("completed_at").alias("at")
    )


# --- sets of ids ---------------------------------------------------------------------


@query(
    "o01_union",
    f"SELECT provider, count(*) AS n FROM ({STORE_SQL}) GROUP BY provider",
)
def o01(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = coverage.union_stores(*(one(spark, sf_dir, p) for p in (ALPHA, BETA, GAMMA)))
    return every.groupBy("provider").agg(F.count("*").alias("n"))


@query(
    "o02_difference",
    "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels",
)
def o02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.difference(docs(spark, sf_dir), table(spark, sf_dir, "labels"))


@query(
    "o03_intersection",
    f"""SELECT doc_id FROM ({STORE_SQL}) GROUP BY doc_id HAVING count(DISTINCT provider) = 3""",
)
def o03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.in_all_providers(store(spark, sf_dir), 3)


@query(
    "o04_superset",
    f"""SELECT provider, count(*) FILTER (s.doc_id IS NULL) = 0 AS complete FROM
          (SELECT provider, d.doc_id FROM documents d, ({PROVIDERS_SQL})) n
          LEFT JOIN ({STORE_SQL}) s USING (provider, doc_id) GROUP BY provider""",
)
def o04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider is complete if as many needed docs are stored for it as there are."""
    needed = corpus(spark, sf_dir).select("doc_id")
    total = needed.agg(F.count("*")).scalar()
    stored = store(spark, sf_dir).join(needed, "doc_id", "left_semi")
    counts = stored.groupBy("provider").agg(F.count_distinct("doc_id").alias("n"))
    return providers(spark).join(counts, "provider", "left").select(
        "provider", (F.coalesce("n", F.lit(0)) == total).alias("complete")
    )
