"""Payloads for a vector store, provider mappings, delivery reports, snapshot diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.rates import report_rate
from ..functions.text import percent_encode

# Fixed value: metadata arrays longer than this are taken for vectors and left out.
MAX_METADATA_ARRAY = 50


def eligible_providers(providers: DataFrame, blacklist: DataFrame) -> DataFrame:
    return providers.join(blacklist.select("provider"), "provider", "left_anti")


def resume(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows at or after their provider's resume position; no entry means from the start."""
    joined = rows.join(plan.select("provider", "resume_from"), "provider", "left")
    return joined.filter(
        F.col("row_idx") >= F.coalesce("resume_from", F.lit(0))
    ).drop("resume_from")


def _member(name: str, value: Column) -> Column:
    """``"name":value`` as JSON text, null spelled out."""
    text = F.to_json(F.struct(value.alias(name)), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(2), F.length(text) - 2)


def metadata_json(docs: DataFrame, exclude: tuple[str, ...] = ("content",)) -> Column:
    """JSON of all other fields; nulls stay, arrays longer than the limit go."""
    members = []
    for field in docs.schema:
        if field.name in exclude:
            continue
        column = F.col(f"`{field.name}`")
        member = _member(field.name, column)
        if isinstance(field.dataType, T.ArrayType):
            fits = column.isNull() | (F.size(column) <= MAX_METADATA_ARRAY)
            member = F.when(fits, member)
        members.append(member)
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def payloads(docs: DataFrame, store: DataFrame, routes: DataFrame, user: str) -> DataFrame:
    """One payload row per stored vector that has a document and a route.

    ``docs`` has url, content and metadata; ``store`` has provider, doc_id, embedding;
    ``routes`` maps a provider to project and instance.
    """
    described = docs.select(
        F.col("url").alias("doc_id"),
        F.col("content").alias("text"),
        metadata_json(docs).alias("metadata"),
    )
    vectors = store.filter(F.size("embedding") > 0)
    return vectors.join(described, "doc_id").join(routes, "provider").select(
        "provider",
        percent_encode("doc_id").alias("text_id"),
        F.lit(user).alias("user_handle"),
        "project_handle",
        "instance_owner",
        "instance_handle",
        "text",
        F.col("embedding").alias("vector"),
        F.size("embedding").cast("bigint").alias("vector_dim"),
        "metadata",
    )


# Field order of one delivered object, metadata last.
PAYLOAD_FIELDS = (
    "text_id", "user_handle", "project_handle", "instance_owner", "instance_handle",
    "text", "vector", "vector_dim",
)


def payload_json(rows: DataFrame) -> DataFrame:
    """Project and JSON text per payload, ``{"embeddings":[...]}`` around one object."""
    head = F.concat_ws(",", *[_member(f, F.col(f)) for f in PAYLOAD_FIELDS])
    body = F.concat(
        F.lit('{"embeddings":[{'), head, F.lit(',"metadata":'), F.col("metadata"), F.lit("}]}")
    )
    return rows.select(F.col("project_handle").alias("project"), body.alias("value"))


def unmatched(store: DataFrame, docs: DataFrame) -> DataFrame:
    """Vectors without a document."""
    known = docs.select(F.col("url").alias("doc_id"))
    return store.select("provider", "doc_id").join(known, "doc_id", "left_anti")


def routed(providers: DataFrame, projects: DataFrame, instances: DataFrame) -> DataFrame:
    """Provider to project to instance; a gap at either step is noted, not dropped silently."""
    joined = providers.join(projects, "provider", "left").join(
        instances, "project_handle", "left"
    )
    note = (
        F.when(F.col("project_handle").isNull(), "no project")
        .when(F.col("instance_handle").isNull(), "no instance")
        .otherwise("ok")
    )
    return joined.withColumn("note", note)


def agreement(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Providers known to one side only."""
    left = manifest.select("provider", F.lit(True).alias("__m"))
    right = loaded.select("provider", F.lit(True).alias("__l"))
    joined = left.join(right, "provider", "full_outer")
    side = F.when(F.col("__l").isNull(), "not loaded").when(
        F.col("__m").isNull(), "not in manifest"
    )
    return joined.select("provider", side.alias("problem")).filter("problem is not null")


def snapshot_diff(
    before: DataFrame, after: DataFrame, key: str, count: str | None = "number_of_embeddings"
) -> DataFrame:
    """New, removed and changed entries; without ``count`` the content is not compared."""
    measure = count or "__one"
    old = before.select(key, (F.col(count) if count else F.lit(0)).alias("__b"))
    new = after.select(key, (F.col(count) if count else F.lit(0)).alias("__a"))
    change = (
        F.when(F.col("__b").isNull(), "new")
        .when(F.col("__a").isNull(), "removed")
        .when(F.col("__a") != F.col("__b"), "changed")
        .otherwise("same")
    )
    out = old.join(new, key, "full_outer").select(
        key, change.alias("change"), (F.col("__a") - F.col("__b")).alias("delta")
    )
    return out if measure != "__one" else out.drop("delta")


def page_results(log: DataFrame) -> DataFrame:
    """Sent, successful and failed per provider and page."""
    return log.groupBy("provider", "page_id").agg(
        F.count("*").alias("total_sent"),
        F.count_if(F.col("http_status") < 400).alias("successful"),
        F.count_if(F.col("http_status") >= 400).alias("failed"),
        F.sum("duration_s").alias("duration_s"),
    )


def provider_results(pages: DataFrame) -> DataFrame:
    """Page results rolled up, with the report's success rate."""
    rolled = pages.groupBy("provider").agg(
        F.count("*").alias("pages"),
        *[F.sum(c).alias(c) for c in ("total_sent", "successful", "failed", "duration_s")],
    )
    rate = report_rate(F.col("successful"), F.col("failed"), F.col("total_sent"))
    return rolled.withColumn("success_rate", rate)


def request_times(log: DataFrame) -> DataFrame:
    """Times over all successful requests, and the span from first start to last end."""
    end = F.unix_micros("ts") / 1e6 + F.col("duration_s")
    ok = F.when(F.col("http_status") < 400, F.col("duration_s"))
    return log.agg(
        F.count("*").alias("requests"),
        F.avg(ok).alias("avg_s"),
        F.max(ok).alias("max_s"),
        F.min(ok).alias("min_s"),
        F.sum(ok).alias("sum_s"),
        (F.max(end) - F.min(F.unix_micros("ts") / 1e6)).alias("elapsed_s"),
    )


def status_histogram(log: DataFrame) -> DataFrame:
    return log.groupBy("http_status").agg(F.count("*").alias("requests"))


def throughput(log: DataFrame) -> DataFrame:
    """Requests per second, seconds per delivered item, items per second, by provider."""
    ok = F.count_if(F.col("http_status") < 400)
    span = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6
    counted = log.groupBy("provider").agg(
        F.count("*").alias("requests"), ok.alias("delivered"), span.alias("elapsed_s")
    )
    over = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    return counted.select(
        "provider",
        "requests",
        "delivered",
        "elapsed_s",
        over(F.col("requests"), F.col("elapsed_s")).alias("requests_per_s"),
        over(F.col("elapsed_s"), F.col("delivered")).alias("s_per_item"),
        over(F.col("delivered"), F.col("elapsed_s")).alias("items_per_s"),
    )


def net_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Total vectors before and after, and the difference."""
    tagged = before.select(F.lit("b").alias("side"), "number_of_embeddings").unionByName(
        after.select(F.lit("a").alias("side"), "number_of_embeddings")
    )
    total = lambda s: F.coalesce(
        F.sum(F.when(F.col("side") == s, F.col("number_of_embeddings"))), F.lit(0)
    )
    return tagged.agg(total("b").alias("before"), total("a").alias("after")).withColumn(
        "change", F.col("after") - F.col("before")
    )
