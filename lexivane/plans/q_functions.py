"""Projections, filters and scalar functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import rates, text, vector
from ..operators import coverage, delivery, termcounts
from ..sources import corpus as corpora, vectors as stores
from .common import (
    ALPHA, BETA, CORPUS_SQL, GAMMA, LOG_SQL, STORE_SQL, TOKENS_SQL, corpus, docs,
    grams_sql, log, query, stop_words, store, table, texts, vectors, units_sql,
)

MIN_TOKENS = 10

# --- projections and filters ---------------------------------------------------------


@query("p01_cast_content", "SELECT doc_id, CAST(n_chars AS VARCHAR) AS content FROM documents")
def p01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.col("n_chars").cast("string").alias("content"))


@query("p02_content_length", "SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM documents")
def p02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.length("text").cast("bigint").alias("n"))


@query(
    "p03_min_tokens",
    f"SELECT doc_id, len({TOKENS_SQL}) AS tokens FROM documents WHERE len({TOKENS_SQL}) >= {MIN_TOKENS}",
)
def p03(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = texts(spark, sf_dir).select("doc_id", text.token_count("text").alias("tokens"))
    return counted.filter(F.col("tokens") >= MIN_TOKENS)


@query("p04_min_characters", "SELECT doc_id FROM documents WHERE length(text) >= 10")
def p04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).filter(F.length("text") >= 10).select("doc_id")


@query("p05_first_documents", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def p05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.first_rows(docs(spark, sf_dir).select("doc_id", "lang"), 100, "doc_id")


@query(
    "p06_drop_null_vectors",
    f"""SELECT d.doc_id, d.lang FROM documents d JOIN ({STORE_SQL}) s USING (doc_id)
        WHERE provider = '{ALPHA}' AND embedding IS NOT NULL""",
)
def p06(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = stores.provider_vectors(store(spark, sf_dir), ALPHA)
    joined = stores.attach_vectors(docs(spark, sf_dir).select("doc_id", "lang"), one, "doc_id")
    return joined.filter(F.col("embedding").isNotNull()).select("doc_id", "lang")


@query(
    "p07_id_membership",
    "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def p07(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "labels").select("doc_id")
    return docs(spark, sf_dir).select("doc_id", "lang").join(ids, "doc_id", "left_semi")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus with one vector column for each provider."""
    return stores.attach_providers(
        corpus(spark, sf_dir), store(spark, sf_dir), [ALPHA, BETA, GAMMA], "doc_id"
    )


@query("p08_columns_by_prefix", f"SELECT url, content, lang, source, year, n_chars, doc_id FROM ({CORPUS_SQL})")
def p08(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpora.without_vectors(wide(spark, sf_dir))


@query(
    "p09_blacklist_and_resume",
    f"""SELECT provider, doc_id, row_idx FROM (
          SELECT provider, doc_id, row_number() OVER (PARTITION BY provider ORDER BY doc_id) - 1 AS row_idx
          FROM ({STORE_SQL}))
        WHERE provider <> '{GAMMA}' AND row_idx >= CASE WHEN provider = '{BETA}' THEN 40 ELSE 0 END""",
)
def p09(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocked = spark.createDataFrame([(GAMMA,)], "provider string")
    plan = spark.createDataFrame([(BETA, 40)], "provider string, resume_from bigint")
    rows = store(spark, sf_dir).select("provider", "doc_id")
    # the position of a provider's row is its distance to the provider's first row
    keyed = rows.withColumn("__row", F.struct("provider", "doc_id"))
    indexed = corpora.with_row_index(keyed, ["__row"], "__row").drop("__row")
    first = indexed.groupBy("provider").agg(F.min("row_idx").alias("first"))
    placed = indexed.join(first, "provider").withColumn("row_idx", F.col("row_idx") - F.col("first"))
    kept = delivery.eligible_providers(placed.drop("first"), blocked)
    return delivery.resume(kept, plan).select("provider", "doc_id", "row_idx")


@query("p10_drop_empty_vectors", f"SELECT provider, doc_id FROM ({STORE_SQL}) WHERE len(embedding) > 0")
def p10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.usable(store(spark, sf_dir)).select("provider", "doc_id")


@query(
    "p11_vector_problems",
    f"""SELECT provider, problem, count(*) AS n FROM (
          SELECT provider, CASE WHEN embedding IS NULL THEN 'missing' WHEN len(embedding) = 0 THEN 'empty'
                 WHEN len(embedding) <> 64 THEN 'dimension' ELSE 'none' END AS problem FROM ({STORE_SQL}))
        GROUP BY ALL""",
)
def p11(spark: SparkSession, sf_dir: str) -> DataFrame:
    problem = F.coalesce(vector.vector_problem("embedding", 64), F.lit("none"))
    checked = store(spark, sf_dir).select("provider", problem.alias("problem"))
    return checked.groupBy("provider", "problem").agg(F.count("*").alias("n"))


@query(
    "p11_all_rules",
    """SELECT vec_id AS doc_id, CASE vec_id % 7 WHEN 1 THEN 'missing' WHEN 2 THEN 'empty' WHEN 3 THEN 'null element'
              WHEN 4 THEN 'not a number' WHEN 5 THEN 'dimension' WHEN 6 THEN 'zero' ELSE 'none' END AS problem
       FROM embeddings""",
)
def p11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six of seven vectors are damaged, each in a way that one rule has to find."""
    v, kind = F.col("v"), F.col("vec_id") % 7
    first = lambda value: F.transform(v, lambda x, i: F.when(i == 0, value).otherwise(x))
    damaged = (
        F.when(kind == 1, F.lit(None))
        .when(kind == 2, F.slice(v, 1, 0))
        .when(kind == 3, first(F.lit(None).cast("double")))
        .when(kind == 4, first(F.lit(float("nan"))))
        .when(kind == 5, F.slice(v, 1, 63))
        .when(kind == 6, F.transform(v, lambda x: x * 0.0))
        .otherwise(v)
    )
    rows = table(spark, sf_dir, "embeddings").withColumn("v", F.col("embedding").cast("array<double>"))
    return rows.select(
        F.col("vec_id").alias("doc_id"),
        F.coalesce(vector.vector_problem(damaged, 64), F.lit("none")).alias("problem"),
    )


@query(
    "p12_allowed_hours",
    """SELECT event_id, hour(ts) >= 19 OR hour(ts) < 7 AS night, hour(ts) >= 7 AND hour(ts) < 19 AS day,
              true AS always FROM events""",
)
def p12(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.hour("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        rates.allowed_hour(hour, 19, 7).alias("night"),
        rates.allowed_hour(hour, 7, 19).alias("day"),
        rates.allowed_hour(hour, None, None).alias("always"),
    )


@query(
    "p13_metadata",
    f"""SELECT doc_id, CASE WHEN vec_id IS NULL
          THEN json_object('doc_id', doc_id, 'url', url, 'lang', lang, 'source', source, 'year', year,
                           'n_chars', n_chars, 'embeddings_{ALPHA}', NULL)
          ELSE json_object('doc_id', doc_id, 'url', url, 'lang', lang, 'source', source, 'year', year,
                           'n_chars', n_chars) END::VARCHAR AS metadata
        FROM ({CORPUS_SQL}) LEFT JOIN embeddings ON vec_id = doc_id""",
)
def p13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stores.attach_providers(
        corpus(spark, sf_dir), store(spark, sf_dir), [ALPHA], "doc_id"
    )
    return rows.select("doc_id", delivery.metadata_json(rows).alias("metadata"))


def routes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(ALPHA, "proj-a", "owner", "inst-a"), (BETA, "proj-b", "owner", "inst-b")],
        "provider string, project_handle string, instance_owner string, instance_handle string",
    )


# Characters of a url, percent-encoded one by one.
ENCODE_SQL = (
    "replace(replace(replace(replace(url, ':', '%3A'), '/', '%2F'), '?', '%3F'), '=', '%3D')"
)

PAYLOAD_SQL = f"""
SELECT s.provider, {ENCODE_SQL} AS text_id, 'user' AS user_handle,
       CASE s.provider WHEN '{ALPHA}' THEN 'proj-a' ELSE 'proj-b' END AS project_handle,
       'owner' AS instance_owner,
       CASE s.provider WHEN '{ALPHA}' THEN 'inst-a' ELSE 'inst-b' END AS instance_handle,
       content AS text, s.embedding AS vector, CAST(len(s.embedding) AS BIGINT) AS vector_dim,
       json_object('url', url, 'lang', lang, 'source', source, 'year', year)::VARCHAR AS metadata
FROM ({STORE_SQL}) s JOIN ({CORPUS_SQL}) c USING (doc_id)
WHERE len(s.embedding) > 0 AND s.provider IN ('{ALPHA}', '{BETA}')"""


def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = corpus(spark, sf_dir)
    urls = texts.select("doc_id", "url")
    keyed = store(spark, sf_dir).join(urls, "doc_id").select(
        "provider", F.col("url").alias("doc_id"), "embedding"
    )
    return delivery.payloads(
        texts.select("url", "content", "lang", "source", "year"), keyed, routes(spark), "user"
    )


@query(
    "p14_payload",
    f"""SELECT provider, text_id, project_handle, instance_handle, vector_dim, metadata,
               md5(text) AS digest FROM ({PAYLOAD_SQL})""",
)
def p14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_rows(spark, sf_dir).select(
        "provider", "text_id", "project_handle", "instance_handle", "vector_dim", "metadata",
        F.md5("text").alias("digest"),
    )


@query(
    "p15_float_vectors",
    """SELECT vec_id, CAST(sum(CAST(round(x * 127) AS BIGINT)) AS DOUBLE) AS total
       FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY vec_id""",
)
def p15(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = F.transform(
        vector.as_double("embedding"), lambda x: F.round(x * 127).cast("tinyint")
    )
    floats = table(spark, sf_dir, "embeddings").select("vec_id", vector.as_float32(small).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x)
    return floats.select("vec_id", total.alias("total"))


@query(
    "p16_shape",
    "SELECT count(*) AS n_rows, CAST(5 AS BIGINT) AS n_columns FROM documents",
)
def p16(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir)
    return rows.agg(
        F.count("*").alias("n_rows"), F.lit(len(rows.columns)).cast("bigint").alias("n_columns")
    )


# --- scalar functions ----------------------------------------------------------------


@query("f01_token_count", f"SELECT doc_id, CAST(len({TOKENS_SQL}) AS BIGINT) AS tokens FROM documents")
def f01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", text.token_count("text").alias("tokens"))


@query(
    "f02_batched",
    f"""SELECT doc_id, CAST(ceil(n / 100) AS BIGINT) AS n_groups,
               CAST(CASE WHEN n = 0 THEN 0 ELSE (n - 1) % 100 + 1 END AS BIGINT) AS last_size
        FROM (SELECT doc_id, len({TOKENS_SQL}) AS n FROM documents)""",
)
def f02(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = texts(spark, sf_dir).select("doc_id", text.tokens("text").alias("t")).select(
        "doc_id", text.batched("t", 100).alias("g")
    )
    last = F.coalesce(F.size(F.try_element_at("g", F.lit(-1))), F.lit(0))
    return grouped.select(
        "doc_id",
        F.size("g").cast("bigint").alias("n_groups"),
        F.greatest(last, F.lit(0)).cast("bigint").alias("last_size"),
    )


@query(
    "f03_token_chunks",
    f"""WITH toks AS ({units_sql('documents', 'doc_id')}),
        pieces AS (SELECT doc_id, i // 510 AS chunk_no,
                          CASE WHEN i = 0 THEN g[1] ELSE '' END || array_to_string(u[i+1:i+510], '') AS chunk
                   FROM (SELECT doc_id, u, g, unnest(range(0, greatest(len(u), least(length(text), 1)), 510)) AS i FROM toks))
        SELECT doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, CAST(length(chunk) AS BIGINT) AS weight,
               md5(chunk) AS digest FROM pieces""",
)
def f03(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = text.explode_chunks(texts(spark, sf_dir), text.token_chunks("text", 512, 2))
    return chunks.select(
        "doc_id", F.col("chunk_no").cast("bigint").alias("chunk_no"), "weight",
        F.md5("chunk").alias("digest"),
    )


def _char_chunks_sql(fits: str) -> str:
    return f"""
    WITH cut AS (SELECT doc_id, text, unnest(CASE WHEN {fits} THEN [0] ELSE range(0, length(text), 2048) END) AS i,
                        {fits} AS fits FROM documents WHERE length(text) > 0),
    pieces AS (SELECT doc_id, i // 2048 AS chunk_no,
                      CASE WHEN fits THEN text ELSE substr(text, i + 1, 2048) END AS chunk FROM cut)
    SELECT doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, CAST(length(chunk) AS BIGINT) AS weight,
           md5(chunk) AS digest FROM pieces"""


def _char_chunks(spark: SparkSession, sf_dir: str, test: str) -> DataFrame:
    chunks = text.explode_chunks(texts(spark, sf_dir), text.char_chunks("text", 512, test))
    return chunks.select(
        "doc_id", F.col("chunk_no").cast("bigint").alias("chunk_no"), "weight",
        F.md5("chunk").alias("digest"),
    )


@query("f04_char_chunks", _char_chunks_sql("length(text) <= 2048"))
def f04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _char_chunks(spark, sf_dir, "chars")


@query("f04_char_chunks_by_tokens", _char_chunks_sql(f"len({TOKENS_SQL}) <= 512"))
def f04_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _char_chunks(spark, sf_dir, "tokens")


@query(
    "f05_pool_chunks",
    """WITH chunk AS (SELECT label AS doc_id, n_chars AS weight, embedding
                      FROM embeddings JOIN documents ON doc_id = vec_id),
       dims AS (SELECT doc_id, weight, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM chunk),
       means AS (SELECT doc_id, dim, sum(weight * x) / sum(weight) AS y, count(*) AS n_chunks FROM dims GROUP BY doc_id, dim)
       SELECT CAST(doc_id AS BIGINT) AS doc_id, n_chunks, CAST(dim - 1 AS BIGINT) AS dim,
              round(y / sqrt(sum(y * y) OVER (PARTITION BY doc_id)), 6) AS value FROM means""",
)
def f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = docs(spark, sf_dir).select("doc_id", F.col("n_chars").alias("weight"))
    chunks = vectors(spark, sf_dir).join(weights, "doc_id").select(
        F.col("topic").alias("doc_id"), F.col("embedding").alias("vector"), "weight"
    )
    pooled = vector.pool_chunks(chunks)
    return pooled.select("doc_id", "n_chunks", F.posexplode("embedding").alias("dim", "v")).select(
        "doc_id", "n_chunks", F.col("dim").cast("bigint").alias("dim"), F.round("v", 6).alias("value")
    )


@query(
    "f06_l2_normalise",
    """SELECT vec_id, dim, round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) AS value
       FROM (SELECT vec_id, unnest(embedding)::DOUBLE * 3 AS x,
                    CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS dim FROM embeddings)""",
)
def f06(spark: SparkSession, sf_dir: str) -> DataFrame:
    tripled = F.transform(vector.as_double("embedding"), lambda x: x * 3)
    unit = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode(vector.l2_normalise(tripled)).alias("dim", "v")
    )
    return unit.select("vec_id", F.col("dim").cast("bigint").alias("dim"), F.round("v", 6).alias("value"))


CONFIG_SQL = """
SELECT lower(r_name) || '-cloud' AS provider, lower(n_name) || '-v' || n_nationkey AS model,
       CASE r_regionkey WHEN 1 THEN 'cohere' WHEN 2 THEN 'google' WHEN 3 THEN 'google' ELSE 'openai' END AS api_spec,
       CASE r_regionkey WHEN 1 THEN 'search_document' WHEN 2 THEN 'retrieval' END AS kind
FROM nation JOIN region ON n_regionkey = r_regionkey"""

IDENTIFIER_SQL = f"""
SELECT provider || '_' || model || CASE api_spec WHEN 'openai' THEN '' ELSE '_' || coalesce(kind, 'default') END
         AS identifier FROM ({CONFIG_SQL})"""


def _identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("r_regionkey")
    config = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == key
    ).select(
        F.concat(F.lower("r_name"), F.lit("-cloud")).alias("provider"),
        F.concat(F.lower("n_name"), F.lit("-v"), F.col("n_nationkey")).alias("model"),
        F.when(key == 1, "cohere").when(key.isin(2, 3), "google").otherwise("openai").alias("api_spec"),
        F.when(key == 1, "search_document").when(key == 2, "retrieval").alias("kind"),
    )
    identifier = text.provider_id(*[F.col(c) for c in ("provider", "model", "api_spec", "kind")])
    return config.select(identifier.alias("identifier"))


@query("f07_provider_id", IDENTIFIER_SQL)
def f07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identifiers(spark, sf_dir)


@query(
    "f08_provider_display",
    f"""SELECT identifier, array_to_string([upper(w[1]) || w[2:] FOR w IN
                 string_split(replace(split_part(identifier, '_', 1), '-', ' '), ' ')], ' ') AS provider, substr(identifier, strpos(identifier, '_') + 1) AS model
        FROM ({IDENTIFIER_SQL})""",
)
def f08(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = text.provider_display(F.col("identifier"))
    return _identifiers(spark, sf_dir).select("identifier", shown.alias("d")).select("identifier", "d.*")


@query(
    "f09_percent_encode",
    """SELECT page_id, replace(replace(replace(replace(replace(replace(replace(url, '%', '%25'), ':', '%3A'),
       '/', '%2F'), '?', '%3F'), '=', '%3D'), '&', '%26'), '#', '%23') AS encoded FROM pages""",
)
def f09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.percent_encode("url").alias("encoded"))


@query(
    "f10_cosine",
    """SELECT vec_id, round(sum(x * y) / (sqrt(sum(x * x)) * sqrt(sum(y * y))), 6) AS similarity
       FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(list_reverse(embedding))::DOUBLE AS y FROM embeddings)
       GROUP BY vec_id""",
)
def f10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = table(spark, sf_dir, "embeddings").withColumn("other", F.reverse("embedding"))
    return pair.select("vec_id", F.round(vector.cosine("embedding", "other"), 6).alias("similarity"))


@query(
    "f11_retry_wait",
    """SELECT event_id, round(CASE
              WHEN event_type = 'click' THEN floor(value)
              WHEN event_type = 'view' THEN (epoch_us(date_trunc('second', ts) + INTERVAL 90 SECOND) - epoch_us(ts)) / 1e6
              ELSE least(60, power(2, user_id % 10)) END, 6) AS wait_s FROM events""",
)
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    later = F.date_trunc("second", "ts") + F.expr("INTERVAL 90 SECONDS")
    header = (
        F.when(kind == "click", F.floor("value").cast("string"))
        .when(kind == "view", F.date_format(later, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(kind == "error", "soon")
    )
    wait = rates.retry_wait(header, F.col("ts"), F.col("user_id") % 10)
    return table(spark, sf_dir, "events").select("event_id", F.round(wait, 6).alias("wait_s"))


@query(
    "f12_success_rate",
    f"""SELECT provider, round(100.0 * count(*) FILTER (http_status < 400) / count(*), 2) AS success_rate,
               CASE WHEN count(*) FILTER (http_status >= 400) = 0 THEN 100.0
                    ELSE round(100.0 * count(*) FILTER (http_status < 400) / count(*), 2) END AS report_rate,
               0.0::DOUBLE AS nothing_tried, 100.0::DOUBLE AS nothing_sent
        FROM ({LOG_SQL}) GROUP BY provider""",
)
def f12(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, bad, n = F.col("ok"), F.col("bad"), F.col("n")
    zero = F.lit(0)
    return (
        log(spark, sf_dir)
        .groupBy("provider")
        .agg(
            F.count_if(F.col("http_status") < 400).alias("ok"),
            F.count_if(F.col("http_status") >= 400).alias("bad"),
            F.count("*").alias("n"),
        )
        .select(
            "provider",
            rates.success_rate(ok, n).alias("success_rate"),
            rates.report_rate(ok, bad, n).alias("report_rate"),
            rates.success_rate(zero, zero).alias("nothing_tried"),
            rates.report_rate(zero, zero, zero).alias("nothing_sent"),
        )
    )


@query(
    "f13_run_stamps",
    """SELECT event_id, strftime(ts, '%Y-%m-%d_') AS date_prefix, strftime(ts, '%Y%m%d_%H%M%S') AS file_stamp,
              strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso_time FROM events""",
)
def f13(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamps = rates.run_stamps(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", stamps.alias("s")).select("event_id", "s.*")


@query(
    "f14_quota_band",
    """SELECT band, count(*) AS n FROM (SELECT CASE WHEN 100.0 * value / 80 > 50 THEN 'green'
       WHEN 100.0 * value / 80 > 20 THEN 'yellow' ELSE 'red' END AS band FROM events) GROUP BY band""",
)
def f14(spark: SparkSession, sf_dir: str) -> DataFrame:
    band = rates.quota_band(F.col("value"), F.lit(80))
    return table(spark, sf_dir, "events").select(band.alias("band")).groupBy("band").agg(
        F.count("*").alias("n")
    )


@query(
    "f15_ngrams",
    f"""WITH {grams_sql(3)}
        SELECT lang, term, count(*) AS tf FROM grams GROUP BY ALL""",
)
def f15(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = texts(spark, sf_dir).select("doc_id", "lang", text.tokens("text").alias("t"))
    words = text.drop_stop_words(words, "t", stop_words(spark, sf_dir), "doc_id")
    parts = max(docs(spark, sf_dir).rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    return termcounts.every_count(words, "lang", terms="t", high=3, slices=termcounts.SLICES * parts)


@query(
    "f16_fill_prompt",
    f"""SELECT conv_id, turn, 'Keywords: ' || role || '. Text: ' || text AS prompt FROM conversations""",
)
def f16(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = "Keywords: [KEYWORDS]. Text: [DOCUMENTS]"
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", text.fill_prompt(F.col("role"), F.col("text"), template).alias("prompt")
    )


@query(
    "f17_label_lookup",
    """SELECT vec_id, n_name AS label FROM embeddings LEFT JOIN nation ON n_nationkey = label + 20""",
)
def f17(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.topics import label_topics

    names = table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") - 20).cast("bigint").alias("topic"), F.col("n_name").alias("label")
    )
    rows = vectors(spark, sf_dir).select(F.col("doc_id").alias("vec_id"), "topic")
    return label_topics(rows, names).select("vec_id", "label")


# --- the Python function surface -----------------------------------------------------


@query(
    "u01_scalar_function",
    "SELECT doc_id, CAST(len(string_split_regex(trim(text, E' \\n\\t\\r'), '\\s+')) AS BIGINT) AS words FROM documents",
)
def u01(spark: SparkSession, sf_dir: str) -> DataFrame:
    @F.pandas_udf("bigint")
    def count_words(texts: pd.Series) -> pd.Series:
        return texts.str.split().str.len()

    return texts(spark, sf_dir).select("doc_id", count_words("text").alias("words"))
