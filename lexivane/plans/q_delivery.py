"""Payload joins, mappings, delivery reports, snapshot diffs, request logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import delivery, requestlog
from .common import LOG_SQL, STORE_SQL, log, query, store, table
from .q_coverage import MANIFEST_OF_SQL, manifest_of
from .q_functions import PAYLOAD_SQL, payload_rows


@query(
    "j03_payload_join",
    f"""SELECT provider, text_id, vector_dim, round(vector[1]::DOUBLE, 6) AS first FROM ({PAYLOAD_SQL})""",
)
def j03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_rows(spark, sf_dir).select(
        "provider", "text_id", "vector_dim",
        F.round(F.get("vector", F.lit(0)).cast("double"), 6).alias("first"),
    )


@query(
    "j04_unmatched",
    f"""SELECT provider, doc_id FROM ({STORE_SQL})
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
)
def j04(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1").select(F.col("doc_id").alias("url"))
    return delivery.unmatched(store(spark, sf_dir), good)


@query(
    "j09_routes",
    """SELECT n_name AS provider, CASE WHEN r_name IS NULL THEN NULL ELSE r_name END AS project_handle,
              CASE WHEN r_regionkey < 3 THEN 'inst-' || r_regionkey END AS instance_handle,
              CASE WHEN r_regionkey = 4 THEN 'no project' WHEN r_regionkey = 3 THEN 'no instance' ELSE 'ok' END AS note
       FROM (SELECT n_name, n_regionkey AS r_regionkey,
                    CASE WHEN n_regionkey < 4 THEN r_name END AS r_name
             FROM nation JOIN region ON n_regionkey = r_regionkey)""",
)
def j09(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    named = nations.select(F.col("n_name").alias("provider"))
    projects = nations.join(
        regions.filter("r_regionkey < 4"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_name").alias("provider"), F.col("r_name").alias("project_handle"))
    instances = regions.filter("r_regionkey < 3").select(
        F.col("r_name").alias("project_handle"),
        F.concat(F.lit("inst-"), "r_regionkey").alias("instance_handle"),
    )
    return delivery.routed(named, projects, instances)


@query(
    "j10_agreement",
    f"""SELECT coalesce(m.provider, l.provider) AS provider,
               CASE WHEN l.provider IS NULL THEN 'not loaded' ELSE 'not in manifest' END AS problem
        FROM ({MANIFEST_OF_SQL}) m FULL JOIN (SELECT DISTINCT provider FROM ({STORE_SQL})) l ON l.provider = m.provider
        WHERE l.provider IS NULL OR m.provider IS NULL""",
)
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = store(spark, sf_dir).select("provider").distinct()
    return delivery.agreement(manifest_of(spark, sf_dir), loaded)


SNAPSHOT_SQL = """
SELECT user_id || '-' || event_type AS project_handle, count(*) AS number_of_embeddings
FROM events WHERE {when} GROUP BY 1"""
BEFORE_SQL = SNAPSHOT_SQL.format(when="ts < TIMESTAMP '2024-01-06'")
AFTER_SQL = SNAPSHOT_SQL.format(when="true")


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two states of the vector store: after the first days of the log, and after all of it."""
    events = table(spark, sf_dir, "events")

    def state(when) -> DataFrame:
        handle = F.concat("user_id", F.lit("-"), "event_type").alias("project_handle")
        return events.filter(when).groupBy(handle).agg(F.count("*").alias("number_of_embeddings"))

    return state(F.col("ts") < "2024-01-06"), state(F.lit(True))


DIFF_SQL = f"""
SELECT coalesce(b.project_handle, a.project_handle) AS project_handle,
       CASE WHEN b.project_handle IS NULL THEN 'new' WHEN a.project_handle IS NULL THEN 'removed'
            WHEN a.number_of_embeddings <> b.number_of_embeddings THEN 'changed' ELSE 'same' END AS change,
       a.number_of_embeddings - b.number_of_embeddings AS delta
FROM ({BEFORE_SQL}) b FULL JOIN ({AFTER_SQL}) a ON a.project_handle = b.project_handle"""


@query("j11_snapshot_diff", DIFF_SQL)
def j11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.snapshot_diff(*snapshots(spark, sf_dir), "project_handle")


@query(
    "j11_instance_diff",
    f"SELECT project_handle, CASE change WHEN 'changed' THEN 'same' ELSE change END AS change FROM ({DIFF_SQL})",
)
def j11_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.snapshot_diff(*snapshots(spark, sf_dir), "project_handle", None)


# --- reports -------------------------------------------------------------------------


def paged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log(spark, sf_dir).withColumn("page_id", F.to_date("ts"))


PAGES_SQL = f"""
SELECT provider, CAST(ts AS DATE) AS page_id, count(*) AS total_sent,
       count(*) FILTER (http_status < 400) AS successful, count(*) FILTER (http_status >= 400) AS failed,
       sum(duration_s) AS duration_s FROM ({LOG_SQL}) GROUP BY ALL"""


@query(
    "a07_upload_pages",
    f"SELECT * REPLACE (CAST(page_id AS VARCHAR) AS page_id, round(duration_s, 6) AS duration_s) FROM ({PAGES_SQL})",
)
def a07_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = delivery.page_results(paged_log(spark, sf_dir))
    return pages.withColumn("page_id", F.col("page_id").cast("string")).withColumn(
        "duration_s", F.round("duration_s", 6)
    )


@query(
    "a07_upload_results",
    f"""SELECT provider, count(*) AS pages, CAST(sum(total_sent) AS BIGINT) AS total_sent,
               CAST(sum(successful) AS BIGINT) AS successful, CAST(sum(failed) AS BIGINT) AS failed,
               round(sum(duration_s), 6) AS duration_s,
               round(100.0 * sum(successful) / sum(total_sent), 2) AS success_rate
        FROM ({PAGES_SQL}) GROUP BY provider""",
)
def a07(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = delivery.provider_results(delivery.page_results(paged_log(spark, sf_dir)))
    return rolled.withColumn("duration_s", F.round("duration_s", 6))


@query(
    "a08_request_times",
    f"""SELECT count(*) AS requests, round(avg(ok), 6) AS avg_s, round(max(ok), 6) AS max_s,
               round(min(ok), 6) AS min_s, round(sum(ok), 6) AS sum_s,
               round(max(epoch_us(ts) / 1e6 + duration_s) - min(epoch_us(ts) / 1e6), 3) AS elapsed_s
        FROM (SELECT *, CASE WHEN http_status < 400 THEN duration_s END AS ok FROM ({LOG_SQL}))""",
)
def a08(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = delivery.request_times(log(spark, sf_dir))
    return times.select(
        "requests",
        *[F.round(c, 6).alias(c) for c in ("avg_s", "max_s", "min_s", "sum_s")],
        F.round("elapsed_s", 3).alias("elapsed_s"),
    )


@query(
    "a09_status_histogram",
    f"SELECT CAST(http_status AS BIGINT) AS http_status, count(*) AS requests FROM ({LOG_SQL}) GROUP BY ALL",
)
def a09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.status_histogram(log(spark, sf_dir)).withColumn(
        "http_status", F.col("http_status").cast("bigint")
    )


@query(
    "a10_throughput",
    f"""SELECT provider, requests, delivered, round(elapsed_s, 6) AS elapsed_s,
               round(requests / elapsed_s, 9) AS requests_per_s, round(elapsed_s / delivered, 6) AS s_per_item,
               round(delivered / elapsed_s, 9) AS items_per_s
        FROM (SELECT provider, count(*) AS requests, count(*) FILTER (http_status < 400) AS delivered,
                     (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS elapsed_s FROM ({LOG_SQL}) GROUP BY provider)""",
)
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = {"elapsed_s": 6, "requests_per_s": 9, "s_per_item": 6, "items_per_s": 9}
    return delivery.throughput(log(spark, sf_dir)).withColumns(
        {c: F.round(c, n) for c, n in digits.items()}
    )


@query(
    "a11_net_change",
    f"""SELECT b AS before, a AS after, a - b AS change FROM (
          SELECT (SELECT CAST(sum(number_of_embeddings) AS BIGINT) FROM ({BEFORE_SQL})) AS b,
                 (SELECT CAST(sum(number_of_embeddings) AS BIGINT) FROM ({AFTER_SQL})) AS a)""",
)
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.net_change(*snapshots(spark, sf_dir))


@query("a12_distinct_projects", f"SELECT DISTINCT project_handle FROM ({PAYLOAD_SQL})")
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_rows(spark, sf_dir).select("project_handle").distinct()


# --- the request log -----------------------------------------------------------------


@query(
    "w07_trailing_requests",
    f"""SELECT event_id, provider,
          count(*) OVER (w RANGE BETWEEN INTERVAL '59.999999' SECOND PRECEDING AND CURRENT ROW) AS last_minute,
          count(*) OVER (w RANGE BETWEEN INTERVAL '3599.999999' SECOND PRECEDING AND CURRENT ROW) AS last_hour,
          count(*) OVER (w RANGE BETWEEN INTERVAL '86399.999999' SECOND PRECEDING AND CURRENT ROW) AS last_day
        FROM ({LOG_SQL}) WINDOW w AS (PARTITION BY provider ORDER BY ts)""",
)
def w07(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = {"last_minute": 60, "last_hour": 3600, "last_day": 86_400}
    return requestlog.trailing_counts(log(spark, sf_dir), spans).select(
        "event_id", "provider", *spans
    )


@query(
    "w07_limit_breaches",
    f"""SELECT event_id FROM (SELECT event_id,
          count(*) OVER (w RANGE BETWEEN INTERVAL '59.999999' SECOND PRECEDING AND CURRENT ROW) AS m,
          count(*) OVER (w RANGE BETWEEN INTERVAL '3599.999999' SECOND PRECEDING AND CURRENT ROW) AS h
          FROM ({LOG_SQL}) WINDOW w AS (PARTITION BY provider ORDER BY ts)) WHERE m > 1 OR h > 6""",
)
def w07_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = requestlog.trailing_counts(log(spark, sf_dir), {"m": 60, "h": 3600})
    return requestlog.breaches(counted, {"m": 1, "h": 6}).select("event_id")


GAP_SQL = f"""
SELECT event_id, provider, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY provider ORDER BY ts, event_id))) / 1e6 AS gap_s
FROM ({LOG_SQL})"""


@query(
    "w08_request_gaps",
    f"SELECT event_id, round(gap_s, 6) AS gap_s, coalesce(gap_s < 60, false) AS too_close FROM ({GAP_SQL})",
)
def w08(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = requestlog.previous_gap(log(spark, sf_dir))
    close = F.coalesce(F.col("gap_s") < 60, F.lit(False))
    return gaps.select("event_id", F.round("gap_s", 6).alias("gap_s"), close.alias("too_close"))


RUNS_SQL = f"""
WITH hits AS (
  SELECT *, sum(CAST(http_status = 429 AS BIGINT)) OVER (PARTITION BY provider ORDER BY ts, event_id) AS s
  FROM ({LOG_SQL})),
marked AS (
  SELECT *, s - coalesce(max(CASE WHEN http_status < 400 THEN s END) OVER (PARTITION BY provider
         ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_run FROM hits)
SELECT *, http_status < 400 AND open_run > 0 AS ends_run,
       CAST(CASE WHEN http_status < 400 THEN 0 ELSE open_run END AS BIGINT) AS consecutive_429 FROM marked"""


@query("w09_throttle_runs", f"SELECT event_id, consecutive_429, ends_run FROM ({RUNS_SQL})")
def w09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requestlog.throttle_runs(log(spark, sf_dir)).select(
        "event_id", "consecutive_429", "ends_run"
    )


@query(
    "w11_sorted_report",
    f"""SELECT http_status, provider, requests FROM (SELECT CAST(http_status AS BIGINT) AS http_status, provider,
               count(*) AS requests FROM ({LOG_SQL}) GROUP BY ALL) ORDER BY http_status, provider""",
)
def w11(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = log(spark, sf_dir).groupBy(
        F.col("http_status").cast("bigint").alias("http_status"), "provider"
    ).agg(F.count("*").alias("requests"))
    return counted.orderBy("http_status", "provider")


@query(
    "w14_longest_interval",
    f"SELECT provider, round(max(gap_s), 6) AS longest_gap_s, max(gap_s) > 7200 AS over_limit FROM ({GAP_SQL}) GROUP BY provider",
)
def w14(spark: SparkSession, sf_dir: str) -> DataFrame:
    longest = requestlog.longest_gap(log(spark, sf_dir))
    return longest.select(
        "provider", F.round("longest_gap_s", 6).alias("longest_gap_s"),
        (F.col("longest_gap_s") > 7200).alias("over_limit"),
    )
