"""Which documents have vectors, which still need them, which failed and where."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.rates import success_rate

STORE_KEY = ["provider", "doc_id"]


def usable(store: DataFrame, empty_is_done: bool = False) -> DataFrame:
    """Store rows that count as done; an empty vector is a failure unless told otherwise."""
    if empty_is_done:
        return store.filter(F.col("embedding").isNotNull())
    return store.filter(F.size("embedding") > 0)


def work_list(docs: DataFrame, store: DataFrame, empty_is_done: bool = False) -> DataFrame:
    """Docs without a vector in the store of one provider."""
    return docs.join(usable(store, empty_is_done).select("doc_id"), "doc_id", "left_anti")


def already_done(docs: DataFrame, store: DataFrame, empty_is_done: bool = False) -> DataFrame:
    """Docs that have a vector and count as success without work."""
    return docs.join(usable(store, empty_is_done).select("doc_id"), "doc_id", "left_semi")


def is_complete(docs: DataFrame, store: DataFrame) -> bool:
    return work_list(docs, store).isEmpty()


def latest(store: DataFrame, order: str = "completed_at") -> DataFrame:
    """Newest row per (provider, doc); an equal time is decided by the vector itself."""
    newest = Window.partitionBy(*STORE_KEY).orderBy(F.desc(order), F.desc("embedding"))
    return store.withColumn("__r", F.row_number().over(newest)).filter("__r = 1").drop("__r")


def merge_cached(cached: DataFrame, new: DataFrame, needed: DataFrame) -> DataFrame:
    """Cached and new vectors of the needed docs, the newest where both exist."""
    both = cached.unionByName(new).join(needed.select("doc_id"), "doc_id", "left_semi")
    return latest(both)


def by_document(store: DataFrame) -> DataFrame:
    """One row per doc with a map from provider to vector, as small as the provider list.

    Of several vectors for a provider and doc the newest counts, or the greatest without times.
    """
    order = "completed_at" if "completed_at" in store.columns else "embedding"
    entries = F.collect_list(F.struct("provider", "embedding"))
    return latest(store, order).groupBy("doc_id").agg(F.map_from_entries(entries).alias("embeddings"))


def union_stores(*stores: DataFrame) -> DataFrame:
    out = stores[0]
    for store in stores[1:]:
        out = out.unionByName(store)
    return out


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("doc_id").distinct().join(right.select("doc_id"), "doc_id", "left_anti")


def in_all_providers(store: DataFrame, n_providers: int) -> DataFrame:
    """Ids present for each of ``n_providers`` providers."""
    return (
        store.select(*STORE_KEY)
        .distinct()
        .groupBy("doc_id")
        .count()
        .filter(F.col("count") == n_providers)
        .select("doc_id")
    )


def outcomes(attempts: DataFrame) -> DataFrame:
    """One row per (provider, doc): did any attempt succeed, and the last error if none did."""
    failed = F.col("status") != "ok"
    return attempts.groupBy(*STORE_KEY).agg(
        F.bool_or(~failed).alias("ok"),
        F.max_by("error", "attempt").alias("error"),
    )


def provider_statistics(attempts: DataFrame) -> DataFrame:
    """Totals, rate, time and 429 hits per provider. Failed docs stay rows: `failed_docs`."""
    per_doc = outcomes(attempts).groupBy("provider").agg(
        F.count("*").alias("total"),
        F.count_if("ok").alias("success"),
        F.count_if(~F.col("ok")).alias("failed"),
    )
    per_request = attempts.groupBy("provider").agg(
        F.count_if(F.col("http_status") == 429).alias("rate_limit_hits"),
        ((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / 1e6).alias("seconds"),
    )
    return per_doc.join(per_request, "provider").select(
        "provider",
        "total",
        "success",
        "failed",
        success_rate(F.col("success"), F.col("total")).alias("success_rate"),
        F.round(F.coalesce("seconds", F.lit(0.0)), 2).alias("processing_time"),
        "rate_limit_hits",
    )


def failed_docs(attempts: DataFrame) -> DataFrame:
    return outcomes(attempts).filter(~F.col("ok")).select("provider", "doc_id", "error")


def failure_classes(docs: DataFrame, failed: DataFrame, n_providers: int) -> DataFrame:
    """critical: failed for all configured providers; partial: for some; full: for none."""
    counts = failed.select(*STORE_KEY).distinct().groupBy("doc_id").agg(F.count("*").alias("__f"))
    f = F.coalesce("__f", F.lit(0))
    kind = F.when(f == n_providers, "critical").when(f > 0, "partial").otherwise("full")
    return docs.join(counts, "doc_id", "left").select("doc_id", kind.alias("failure_class"))


def failures_per_provider(result: DataFrame) -> DataFrame:
    return result.groupBy("provider").agg(F.count_if(~F.col("ok")).alias("failed"))


def failure_preview(failed: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` failed ids per provider and how many more there are.

    The rank filter is applied inside the map tasks first, so no task sees a whole provider.
    """
    first = Window.partitionBy("provider").orderBy("doc_id")
    shown = (
        failed.select(*STORE_KEY)
        .withColumn("__r", F.row_number().over(first))
        .filter(F.col("__r") <= n)
        .groupBy("provider")
        .agg(F.array_sort(F.collect_list("doc_id")).alias("shown"))
    )
    totals = failed.groupBy("provider").agg(F.count("*").alias("failed"))
    return totals.join(shown, "provider").withColumn(
        "more", F.greatest(F.col("failed") - n, F.lit(0))
    )


def store_counts(store: DataFrame) -> DataFrame:
    """Rows, usable vectors and dimension per provider."""
    return store.groupBy("provider").agg(
        F.count("*").alias("rows"),
        F.count_if(F.size("embedding") > 0).alias("vectors"),
        F.max(F.size("embedding")).cast("bigint").alias("dimension"),
    )


def processed_counts(configured: DataFrame, store: DataFrame) -> DataFrame:
    """Processed documents of every configured provider, zero where there is none."""
    counts = usable(store).groupBy("provider").agg(F.count("*").alias("__n"))
    return configured.join(counts, "provider", "left").select(
        *configured.columns, F.coalesce("__n", F.lit(0)).alias("documents_processed")
    )


def store_health(store: DataFrame, manifest: DataFrame) -> DataFrame:
    """Store and manifest counts side by side, and which side is missing."""
    counts = store.groupBy("provider").agg(F.count("*").alias("stored"))
    listed = manifest.select("provider", F.col("num_embeddings").alias("listed"))
    state = (
        F.when(F.col("stored").isNull(), "not in store")
        .when(F.col("listed").isNull(), "not in manifest")
        .when(F.col("stored") != F.col("listed"), "counts differ")
        .otherwise("ok")
    )
    return counts.join(listed, "provider", "full_outer").withColumn("state", state)


def skip_decision(configured: DataFrame, manifest: DataFrame, store: DataFrame) -> DataFrame:
    """Skip a provider the manifest and the store both know as non-empty; redo false entries."""
    stored = store.groupBy("provider").agg(F.count("*").alias("__stored"))
    joined = configured.select("provider").join(
        manifest.select("provider", "num_embeddings"), "provider", "left"
    ).join(stored, "provider", "left")
    valid = (F.col("num_embeddings") > 0) & (F.coalesce("__stored", F.lit(0)) > 0)
    decision = (
        F.when(F.col("num_embeddings").isNull(), "process")
        .when(valid, "skip")
        .otherwise("redo")
    )
    return joined.select("provider", decision.alias("decision"))

