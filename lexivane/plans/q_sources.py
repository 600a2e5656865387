"""Sources and sinks, as round trips through the shared work folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import coverage, delivery, reduce
from ..session import work_dir
from ..sources import corpus as corpora, sinks, vectors as stores, wordlists
from .common import (
    ALPHA, ATTEMPTS_SQL, BETA, CORPUS_SQL, GAMMA, PROVIDERS_SQL, STOP_SQL, STORE_SQL, TOKENS_SQL, VECTORS_SQL,
    attempts,
    corpus, docs, labelled, providers, query, stop_words, store, table, texts, vectors,
)
from .q_functions import PAYLOAD_SQL, payload_rows, wide
from .q_topics import INFO_SQL, info

CORPUS_TYPES = (
    "url string, content string, lang string, source string, year int, n_chars bigint, doc_id bigint"
)

DIGEST_SQL = f"SELECT url, lang, year, n_chars, md5(content) AS digest FROM ({CORPUS_SQL})"


def _digest(df: DataFrame) -> DataFrame:
    return df.select("url", "lang", "year", "n_chars", F.md5("content").alias("digest"))


# --- sources -------------------------------------------------------------------------


@query("s01_corpus_csv", DIGEST_SQL)
def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "csv")
    sinks.write_csv(corpus(spark, sf_dir), path)
    return _digest(corpora.read_csv(spark, path, CORPUS_TYPES))


@query(
    "s02_required_columns",
    f"SELECT count(*) AS n_docs, count(*) FILTER (content IS NULL) AS n_null FROM ({CORPUS_SQL})",
)
def s02(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = corpora.require_columns(corpus(spark, sf_dir))
    return checked.agg(
        F.count("*").alias("n_docs"), F.count_if(F.col("content").isNull()).alias("n_null")
    )


@query("s03_docs_parquet", DIGEST_SQL)
def s03(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "docs")
    sinks.write_docs_parquet(wide(spark, sf_dir), path)
    return _digest(corpora.read_docs_parquet(spark, path))


@query(
    "s04_format_precedence",
    f"SELECT 'both' AS present, * FROM ({DIGEST_SQL}) UNION ALL SELECT 'csv' AS present, * FROM ({DIGEST_SQL})",
)
def s04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with both formats, whose CSV is out of date, and one with CSV alone."""
    both, alone = work_dir(spark, "formats"), work_dir(spark, "formats")
    rows = corpus(spark, sf_dir)
    sinks.write_docs_parquet(rows, f"{both}/all_docs.parquet")
    sinks.write_docs_csv(rows.withColumn("content", F.lit("out of date")), f"{both}/all_docs.csv")
    sinks.write_docs_csv(rows, f"{alone}/all_docs.csv")
    read = lambda root, name: _digest(corpora.read_docs(spark, root, schema=CORPUS_TYPES)).select(
        F.lit(name).alias("present"), "*"
    )
    return read(both, "both").unionByName(read(alone, "csv"))


@query("s05_latest_snapshot", "SELECT doc_id, lang FROM documents")
def s05(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "snapshots")
    rows = docs(spark, sf_dir).select("doc_id", "lang")
    older = rows.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    older.write.parquet(f"{root}/2024-01-01_all_docs.parquet")
    rows.write.parquet(f"{root}/2024-01-02_all_docs.parquet")
    return spark.read.parquet(corpora.latest_snapshot(spark, root, "*_all_docs.parquet"))


@query("s06_row_count", "SELECT count(*) AS n FROM documents")
def s06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).agg(F.count("*").alias("n"))


@query(
    "s07_pages",
    """SELECT doc_id, row_idx, CAST(row_idx // 128 AS BIGINT) AS page_id
       FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM documents)""",
)
def s07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.with_page_id(docs(spark, sf_dir).select("doc_id"), 128, "doc_id")


@query("s07_one_page", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 50 OFFSET 100")
def s07_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.page(docs(spark, sf_dir).select("doc_id"), 100, 50, "doc_id")


def _stored(spark: SparkSession, sf_dir: str) -> str:
    path = work_dir(spark, "store")
    sinks.write_store(store(spark, sf_dir), path)
    return path


@query(
    "s08_provider_vectors",
    f"""SELECT doc_id, round(sum(x), 5) AS total FROM (
          SELECT doc_id, unnest(embedding)::DOUBLE AS x FROM ({STORE_SQL})
          WHERE provider = '{ALPHA}' AND doc_id IN (SELECT doc_id FROM labels)) GROUP BY doc_id""",
)
def s08(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stores.read_store(spark, _stored(spark, sf_dir))
    rows = stores.provider_vectors(kept, ALPHA, table(spark, sf_dir, "labels"))
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return rows.select("doc_id", F.round(total, 5).alias("total"))


@query(
    "s09_nested_store",
    f"SELECT provider, doc_id, CAST(len(embedding) AS BIGINT) AS dim FROM ({STORE_SQL})",
)
def s09(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the nested form in rows of bounded size, one per provider and day of completion
    entry = F.struct("doc_id", "embedding")
    inner = store(spark, sf_dir).groupBy("provider", F.window("completed_at", "1 hour")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("m")
    )
    nested = inner.select(F.create_map("provider", "m").alias("store"))
    path = work_dir(spark, "nested")
    nested.write.parquet(path)
    rows = stores.explode_nested(spark.read.parquet(path), "store")
    return rows.select("provider", "doc_id", F.size("embedding").cast("bigint").alias("dim"))


@query(
    "s10_vectors_from_docs",
    f"""SELECT provider, doc_id, CAST(len(embedding) AS BIGINT) AS dim FROM ({STORE_SQL})
        WHERE doc_id IN (SELECT doc_id FROM documents)""",
)
def s10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stores.unpivot_wide(wide(spark, sf_dir), "doc_id")
    return rows.select("provider", "doc_id", F.size("embedding").cast("bigint").alias("dim"))


def _manifest(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A written store over urls and the manifest that describes it."""
    urls = corpus(spark, sf_dir).select("doc_id", "url")
    rows = store(spark, sf_dir).join(urls, "doc_id").withColumn("doc_id", F.col("url")).drop("url")
    path = work_dir(spark, "store")
    sinks.write_store(rows, path)
    manifest = work_dir(spark, "manifest")
    sinks.write_manifest(sinks.manifest_rows(rows, path), manifest)
    return path, manifest


@query(
    "s11_manifest_load",
    f"""SELECT url, a.dim AS alpha_dim, b.dim AS beta_dim, g.dim AS gamma_dim FROM ({CORPUS_SQL}) c
        LEFT JOIN (SELECT doc_id, CAST(len(embedding) AS BIGINT) AS dim FROM ({STORE_SQL}) WHERE provider = '{ALPHA}') a USING (doc_id)
        LEFT JOIN (SELECT doc_id, CAST(len(embedding) AS BIGINT) AS dim FROM ({STORE_SQL}) WHERE provider = '{BETA}') b USING (doc_id)
        LEFT JOIN (SELECT doc_id, CAST(len(embedding) AS BIGINT) AS dim FROM ({STORE_SQL}) WHERE provider = '{GAMMA}') g USING (doc_id)""",
)
def s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, manifest = _manifest(spark, sf_dir)
    loaded = stores.load_by_manifest(spark, corpus(spark, sf_dir).drop("doc_id"), manifest)
    size = lambda p: F.size(F.col(f"`embeddings_{p}`")).cast("bigint")
    known = lambda p: F.when(F.col(f"`embeddings_{p}`").isNotNull(), size(p))
    return loaded.select(
        "url",
        known(ALPHA).alias("alpha_dim"),
        known(BETA).alias("beta_dim"),
        known(GAMMA).alias("gamma_dim"),
    )


MANIFEST_SQL = f"""
SELECT provider, count(*) AS num_embeddings,
       strftime(max(completed_at), '%Y-%m-%dT%H:%M:%S') AS completed_at
FROM ({STORE_SQL}) WHERE doc_id IN (SELECT doc_id FROM documents) GROUP BY provider"""


@query("s12_manifest_json", MANIFEST_SQL)
def s12(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, manifest = _manifest(spark, sf_dir)
    return stores.read_manifest(spark, manifest).select("provider", "num_embeddings", "completed_at")


@query(
    "s13_seed_lines",
    r"""SELECT word, CAST(pos - 1 AS BIGINT) AS pos, count(*) AS n FROM (
          SELECT unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM (
            SELECT string_split(regexp_replace(line, '\s+$', ''), ',') AS words FROM (
              SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark)))
        GROUP BY ALL""",
)
def s13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "seeds")
    table(spark, sf_dir, "benchmark").select("text").write.text(path)
    rows = wordlists.read_seed_words(spark, path)
    return rows.groupBy("word", F.col("pos").cast("bigint").alias("pos")).agg(F.count("*").alias("n"))


@query("s14_stop_words", STOP_SQL)
def s14(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "stop")
    padded = F.concat(F.lit(" "), "word", F.lit("  "))
    stop_words(spark, sf_dir).select(padded.alias("value")).write.text(path)
    return wordlists.read_stop_words(spark, path)


DIMENSIONS_SQL = f"""
SELECT provider, CAST(min(len(embedding)) AS BIGINT) AS min_dim,
       CAST(max(len(embedding)) AS BIGINT) AS max_dim
FROM ({STORE_SQL}) WHERE len(embedding) > 0 GROUP BY provider"""


@query("s15_dimensions", DIMENSIONS_SQL)
def s15(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.vector import dimensions

    return dimensions(store(spark, sf_dir))


@query(
    "s16_row_to_text",
    "SELECT concat_ws(' ', conv_id, turn, role, text) AS line FROM conversations",
)
def s16(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.text import row_to_text

    rows = table(spark, sf_dir, "conversations")
    return rows.select(row_to_text(rows).alias("line"))


# --- sinks ---------------------------------------------------------------------------


@query(
    "k01_store_by_provider",
    f"""SELECT provider, count(*) AS n, CAST(max(len(embedding)) AS BIGINT) AS dim FROM (
          SELECT provider, embedding FROM ({STORE_SQL}) WHERE provider <> '{GAMMA}'
          UNION ALL SELECT '{GAMMA}', embedding FROM embeddings) GROUP BY provider""",
)
def k01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write replaces one provider and leaves the others."""
    path = _stored(spark, sf_dir)
    again = vectors(spark, sf_dir).select(F.lit(GAMMA).alias("provider"), "doc_id", "embedding")
    sinks.write_store(again, path)
    return stores.read_store(spark, path).groupBy("provider").agg(
        F.count("*").alias("n"), F.max(F.size("embedding")).cast("bigint").alias("dim")
    )


@query(
    "k02_manifest_update",
    MANIFEST_SQL.replace("SELECT provider,", "SELECT provider, 'provider=' || provider AS file,"),
)
def k02(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, manifest = _manifest(spark, sf_dir)
    return stores.read_manifest(spark, manifest).drop("filepath")


@query("k03_publish", "SELECT doc_id, lang, source FROM documents")
def k03(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "publish")
    rows = docs(spark, sf_dir).select("doc_id", "lang", "source")
    sinks.publish(rows.withColumn("lang", F.lit("old")), root)
    sinks.publish(rows, root)
    return sinks.read_published(spark, root)


@query(
    "k04_combined_store",
    f"""SELECT provider, doc_id, round(sum(x), 5) AS total FROM (
          SELECT provider, doc_id, unnest(embedding)::DOUBLE AS x FROM ({STORE_SQL})) GROUP BY ALL""",
)
def k04(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stores.read_store(spark, _stored(spark, sf_dir)).filter(F.size("embedding") > 0)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return rows.select("provider", "doc_id", F.round(total, 5).alias("total"))


@query(
    "k05_docs_with_vectors",
    f"""SELECT c.url, a.doc_id IS NOT NULL AS has_alpha, b.doc_id IS NOT NULL AS has_beta,
               g.doc_id IS NOT NULL AS has_gamma FROM ({CORPUS_SQL}) c
        LEFT JOIN (SELECT doc_id FROM ({STORE_SQL}) WHERE provider = '{ALPHA}') a USING (doc_id)
        LEFT JOIN (SELECT doc_id FROM ({STORE_SQL}) WHERE provider = '{BETA}') b USING (doc_id)
        LEFT JOIN (SELECT doc_id FROM ({STORE_SQL}) WHERE provider = '{GAMMA}') g USING (doc_id)""",
)
def k05(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "wide")
    sinks.write_docs_parquet(wide(spark, sf_dir), path)
    has = lambda p: F.col(f"`embeddings_{p}`").isNotNull()
    return spark.read.parquet(path).select(
        "url", has(ALPHA).alias("has_alpha"), has(BETA).alias("has_beta"), has(GAMMA).alias("has_gamma")
    )


@query("k06_docs_csv", DIGEST_SQL)
def k06(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "docs-csv")
    rows = wide(spark, sf_dir).select("*", F.col("doc_id").alias("id")).drop("doc_id")
    sinks.write_docs_csv(rows, path)
    schema = CORPUS_TYPES.replace("doc_id", "id")
    return _digest(corpora.read_csv(spark, path, schema))


@query("k07_ndjson", "SELECT doc_id, lang, true AS placed FROM documents JOIN embeddings ON doc_id = vec_id")
def k07(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "ndjson")
    placed = reduce.with_coordinates(labelled(spark, sf_dir)).drop("embedding", "text")
    sinks.write_ndjson(placed, path)
    back = spark.read.schema(
        "doc_id bigint, lang string, topic bigint, proj_x float, proj_y float, proj_z float"
    ).json(path)
    ok = F.col("proj_x").isNotNull() & F.col("proj_y").isNotNull() & F.col("proj_z").isNotNull()
    return back.select("doc_id", "lang", ok.alias("placed"))


STATISTICS_SQL = f"""
WITH outcome AS (SELECT provider, doc_id, bool_or(status = 'ok') AS ok FROM ({ATTEMPTS_SQL}) GROUP BY ALL),
per_doc AS (SELECT provider, count(*) AS total, count(*) FILTER (ok) AS success,
                   count(*) FILTER (NOT ok) AS failed FROM outcome GROUP BY provider),
per_request AS (SELECT provider, count(*) FILTER (http_status = 429) AS rate_limit_hits,
                       (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds
                FROM ({ATTEMPTS_SQL}) GROUP BY provider)
SELECT provider, total, success, failed, round(100.0 * success / total, 2) AS success_rate,
       round(seconds, 2) AS processing_time, rate_limit_hits
FROM per_doc JOIN per_request USING (provider)"""


TRIED_SQL = f"SELECT provider, doc_id, bool_or(status = 'ok') AS ok FROM ({ATTEMPTS_SQL}) GROUP BY ALL"
CLASSES_SQL = f"""
SELECT count(*) AS total_documents, count(*) FILTER (f = 5) AS critical_failures,
       count(*) FILTER (f > 0 AND f < 5) AS partial_success, count(*) FILTER (f = 0) AS full_success
FROM (SELECT doc_id, count(*) FILTER (NOT ok) AS f FROM ({TRIED_SQL}) GROUP BY doc_id)"""


@query(
    "k08_statistics_json",
    f"""SELECT s.*, c.*, listed FROM ({STATISTICS_SQL}) s
        LEFT JOIN (SELECT provider, count(*) AS listed FROM ({TRIED_SQL}) WHERE NOT ok GROUP BY provider) l USING (provider)
        CROSS JOIN ({CLASSES_SQL}) c""",
)
def k08(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as one JSON object: time, totals, providers, summary. Failed ids may be any
    number, so they are a table beside it, a row each."""
    tried = attempts(spark, sf_dir)
    stats, failed = coverage.provider_statistics(tried), coverage.failed_docs(tried)
    fields = [c for c in stats.columns if c != "provider"]
    packed = F.map_from_entries(F.collect_list(F.struct("provider", F.struct(*fields))))
    classes = coverage.failure_classes(tried.select("doc_id").distinct(), failed, 5)
    of = lambda kind: F.count_if(F.col("failure_class") == kind)
    summary = classes.agg(
        F.count("*").alias("total_documents"),
        F.struct(
            of("critical").alias("critical_failures"), of("partial").alias("partial_success"),
            of("full").alias("full_success"),
        ).alias("summary"),
    ).first()
    row = stats.agg(packed.alias("providers")).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit(summary["total_documents"]).alias("total_documents"),
        "providers",
        F.struct(*(F.lit(v).alias(k) for k, v in summary["summary"].asDict().items())).alias("summary"),
    )
    path, beside = work_dir(spark, "statistics"), work_dir(spark, "failed")
    sinks.write_json_row(row, path)
    failed.write.json(beside)
    kinds = T.StructType([stats.schema[c] for c in fields])
    counts = "critical_failures bigint, partial_success bigint, full_success bigint"
    schema = T.StructType([
        T.StructField("timestamp", T.StringType()), T.StructField("total_documents", T.LongType()),
        T.StructField("providers", T.MapType(T.StringType(), kinds)),
        T.StructField("summary", T.StructType.fromDDL(counts)),
    ])
    back = spark.read.schema(schema).json(path).filter(F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\dT"))
    listed = spark.read.schema("provider string, doc_id bigint").json(beside).groupBy("provider").agg(
        F.count("*").alias("listed")
    )
    return (
        back.select(F.explode("providers").alias("provider", "s"), "total_documents", "summary.*")
        .select("provider", "s.*", "total_documents", "critical_failures", "partial_success", "full_success")
        .join(listed, "provider", "left")
    )


MIN_TOKENS = 10


@query(
    "k09_metadata_json",
    f"""SELECT p.provider, total_available, processed, {MIN_TOKENS} AS min_tokens_threshold,
               coalesce(n, 0) AS documents_processed, dimensions,
               string_split(p.provider, '_')[1] AS name, CAST(NULL AS VARCHAR) AS base_url
        FROM ({PROVIDERS_SQL}) p LEFT JOIN (SELECT provider, count(*) AS n, CAST(max(len(embedding)) AS BIGINT) AS dimensions FROM ({STORE_SQL})
             WHERE len(embedding) > 0 GROUP BY provider) USING (provider)
        CROSS JOIN (SELECT count(*) AS total_available, count(*) FILTER (len({TOKENS_SQL}) >= {MIN_TOKENS}) AS processed FROM documents)""",
)
def k09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date, document counts, the token threshold, and the settings of every provider, nulls kept."""
    from ..functions.text import token_count
    from ..functions.vector import dimensions

    size = dimensions(store(spark, sf_dir)).select("provider", F.col("max_dim").alias("dimensions"))
    counts = coverage.processed_counts(providers(spark), store(spark, sf_dir)).join(size, "provider", "left")
    total = texts(spark, sf_dir).agg(
        F.count("*").alias("total_available"),
        F.count_if(token_count("text") >= MIN_TOKENS).alias("processed"),
    ).first()
    detail = F.struct(
        F.split("provider", "_")[0].alias("name"), F.lit(None).cast("string").alias("base_url"),
        "dimensions", "documents_processed",
    )
    row = counts.agg(F.map_from_entries(F.collect_list(F.struct("provider", detail))).alias("providers")).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("processing_date"),
        F.struct(
            *(F.lit(v).alias(k) for k, v in total.asDict().items()), F.lit(MIN_TOKENS).alias("min_tokens_threshold")
        ).alias("documents"),
        "providers",
    )
    path = work_dir(spark, "metadata")
    sinks.write_json_row(row, path)
    back = spark.read.schema(
        "processing_date string, documents struct<total_available:bigint, processed:bigint, min_tokens_threshold:int>, "
        "providers map<string, struct<name:string, base_url:string, dimensions:bigint, documents_processed:bigint>>"
    ).json(path).filter("processing_date IS NOT NULL")
    return back.select("documents.*", F.explode("providers").alias("provider", "p")).select(
        "provider", "total_available", "processed", "min_tokens_threshold", "p.*"
    )


@query(
    "k10_topic_csv",
    f"""WITH info AS ({INFO_SQL})
        SELECT d.doc_id, i.topic, i.count, i.name, i.representation FROM documents d
        JOIN ({VECTORS_SQL}) v USING (doc_id) JOIN info i ON i.topic = v.topic""",
)
def k10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic table and the documents with their topic, as CSV and read back."""
    table_path, docs_path = work_dir(spark, "topic-csv"), work_dir(spark, "topic-docs-csv")
    columns = ["topic", "count", "name", "representation"]
    sinks.write_topic_csv(info(spark, sf_dir).select(*columns), table_path)
    placed = docs(spark, sf_dir).select("doc_id").join(vectors(spark, sf_dir).select("doc_id", "topic"), "doc_id")
    sinks.write_docs_csv(placed, docs_path)
    known = corpora.read_csv(spark, table_path, "topic bigint, count bigint, name string, representation string")
    return corpora.read_csv(spark, docs_path, "doc_id bigint, topic bigint").join(known, "topic").select(
        "doc_id", *columns
    )


@query(
    "k12_delivery_batches",
    f"SELECT project_handle AS project, text_id, vector_dim, md5(text) AS digest FROM ({PAYLOAD_SQL})",
)
def k12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "delivery")
    sinks.write_lines(delivery.payload_json(payload_rows(spark, sf_dir)), path)
    item = (
        "struct<text_id:string,user_handle:string,text:string,vector:array<float>,"
        "vector_dim:bigint,metadata:struct<url:string,lang:string>>"
    )
    lines = spark.read.text(path)
    parsed = lines.select(
        "project", F.inline(F.from_json("value", f"embeddings array<{item}>")["embeddings"])
    )
    good = parsed.filter(
        (F.size("vector") == F.col("vector_dim")) & (F.col("metadata.url").isNotNull())
    )
    return good.select("project", "text_id", "vector_dim", F.md5("text").alias("digest"))


@query(
    "k13_json_sample",
    """SELECT json_object('doc_id', doc_id, 'lang', lang)::VARCHAR AS json FROM documents
       ORDER BY doc_id LIMIT 3""",
)
def k13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.json_sample(docs(spark, sf_dir).select("doc_id", "lang"), 3, "doc_id")
