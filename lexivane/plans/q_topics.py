"""Terms and topics: vocabulary, weights, top words, names, classes, periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import terms, topics
from ..operators.topicmodel import TopicModel
from ..session import durable
from .common import (
    LABELLED_SQL, STOP_SQL, TOKENS_SQL, VECTORS_SQL, classed, docs, grams_sql, labelled, query, seeds,
    stop_words, vectors, weights_sql,
)


def counted(spark: SparkSession, sf_dir: str, *groups: str) -> tuple[DataFrame, DataFrame]:
    """Term counts by topic (and group) and the vocabulary, written down for several uses."""
    words = terms.term_arrays(classed(spark, sf_dir), stop_words(spark, sf_dir), 1)
    return terms.ranked_vocabulary(durable(words.select("topic", *groups, "terms")), "topic", *groups)


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, vocab = counted(spark, sf_dir)
    return terms.class_weights(counts, vocab, seeds(spark, sf_dir))


def best(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    return terms.top_terms(weights(spark, sf_dir), n)


def best_sql(n: int | None) -> str:
    cut = "" if n is None else f"WHERE rank <= {n}"
    return f"""
WITH {weights_sql()},
ranked AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(score, 9) DESC, term) AS rank FROM weights)
SELECT topic, term, rank, round(score, 6) AS score FROM ranked {cut}"""


def rounded(ranked: DataFrame) -> DataFrame:
    return ranked.select("topic", "term", "rank", F.round("score", 6).alias("score"))


@query("a13_topic_frequency", f"SELECT topic, count(*) AS count FROM ({VECTORS_SQL}) GROUP BY topic")
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.topic_frequency(vectors(spark, sf_dir))


@query(
    "a15_vocabulary",
    f"""WITH {grams_sql(3)}
        SELECT term, count(*) AS f, count(DISTINCT doc_id) AS df FROM grams GROUP BY term
        HAVING count(DISTINCT doc_id) >= 6 ORDER BY f DESC, term LIMIT 100000""",
)
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(spark, sf_dir)[1]


@query(
    "a15_vocabulary_by_topic",
    f"""WITH {grams_sql(1)}
        SELECT term, count(*) AS f, count(DISTINCT topic) AS df FROM grams GROUP BY term
        HAVING count(DISTINCT topic) >= 6 ORDER BY f DESC, term LIMIT 100000""",
)
def a15_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = terms.term_arrays(classed(spark, sf_dir), stop_words(spark, sf_dir), 1)
    return terms.vocabulary(terms.group_counts(words, "topic"), df_scope="topic")


@query(
    "a16_class_weights",
    f"WITH {weights_sql()} SELECT topic, term, tf, round(score, 6) AS score FROM weights",
)
def a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights(spark, sf_dir).select("topic", "term", "tf", F.round("score", 6).alias("score"))


@query("w01_top_words", best_sql(terms.TOP_WORDS))
def w01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(best(spark, sf_dir, terms.TOP_WORDS))


@query("w02_bar_words", best_sql(terms.BAR_WORDS))
def w02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(best(spark, sf_dir, terms.BAR_WORDS))


@query("w12_term_rank", best_sql(None))
def w12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(terms.top_terms(weights(spark, sf_dir), None))


CENTROID_SQL = f"""
SELECT topic, dim, avg(x) AS y FROM (
  SELECT topic, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim
  FROM ({VECTORS_SQL})) GROUP BY topic, dim"""

CENTRES_SQL = f"SELECT topic, list(y ORDER BY dim) AS centroid FROM ({CENTROID_SQL}) GROUP BY topic"

REPRESENTATIVE_SQL = f"""
SELECT topic, doc_id, similarity, row_number() OVER (PARTITION BY topic ORDER BY round(similarity, 9) DESC, doc_id) AS rank
FROM (SELECT topic, doc_id, list_cosine_similarity(embedding::DOUBLE[], centroid) AS similarity
      FROM ({VECTORS_SQL}) JOIN ({CENTRES_SQL}) USING (topic))"""


@query(
    "a17_centroids",
    f"SELECT topic, CAST(dim - 1 AS BIGINT) AS dim, round(y, 6) AS value FROM ({CENTROID_SQL})",
)
def a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    centres = topics.centroids(vectors(spark, sf_dir))
    return centres.select("topic", F.posexplode("centroid").alias("d", "v")).select(
        "topic", F.col("d").cast("bigint").alias("dim"), F.round("v", 6).alias("value")
    )


def representatives(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    rows = vectors(spark, sf_dir)
    return topics.representative_docs(rows, topics.centroids(rows), n)


@query(
    "w03_representative_docs",
    f"SELECT topic, doc_id, rank, round(similarity, 6) AS similarity FROM ({REPRESENTATIVE_SQL}) WHERE rank <= 5",
)
def w03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return representatives(spark, sf_dir, 5).select(
        "topic", "doc_id", "rank", F.round("similarity", 6).alias("similarity")
    )


@query(
    "w04_topic_order",
    """SELECT d.doc_id, coalesce(t.topic, -1) AS topic FROM documents d LEFT JOIN (
         SELECT lang, row_number() OVER (ORDER BY count(*) DESC, min(doc_id)) - 1 AS topic
         FROM documents WHERE lang <> 'de' GROUP BY lang) t ON t.lang = d.lang""",
)
def w04(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.density import order_topics

    cluster = F.when(F.col("lang") != "de", F.col("lang"))
    return order_topics(docs(spark, sf_dir).select("doc_id", cluster.alias("cluster")))


# --- terms and vectors together: label as topic --------------------------------------

LABEL_TERMS_SQL = f"""
stop AS ({STOP_SQL}), stops AS (SELECT list(word) AS sw FROM stop),
labelled AS ({LABELLED_SQL}),
cut AS (SELECT doc_id, topic, [w FOR w IN {TOKENS_SQL} IF NOT list_contains(sw, w)] AS t FROM labelled, stops),
grams AS (SELECT doc_id, topic, unnest(t || [t[i] || ' ' || t[i+1] FOR i IN range(1, len(t))]
                 || [t[i] || ' ' || t[i+1] || ' ' || t[i+2] FOR i IN range(1, len(t) - 1)]) AS term FROM cut),
vocab AS (SELECT term, count(*) AS f FROM grams GROUP BY term HAVING count(DISTINCT doc_id) >= 6
          ORDER BY f DESC, term LIMIT 100000),
tfs AS (SELECT topic, term, count(*) AS tf FROM grams SEMI JOIN vocab USING (term) GROUP BY ALL),
totals AS (SELECT topic, sum(tf) AS total FROM tfs GROUP BY topic),
weights AS (SELECT topic, term, tf, sqrt(tf / total) * ln(1 + (SELECT avg(total) FROM totals) / f) AS score
            FROM tfs JOIN totals USING (topic) JOIN vocab USING (term)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(score, 9) DESC, term) AS rank FROM weights),
named AS (SELECT topic, topic || '_' || string_agg(term, '_' ORDER BY rank) FILTER (rank <= 4) AS name,
                 string_agg(term, ', ' ORDER BY rank) FILTER (rank <= 35) AS representation
          FROM ranked GROUP BY topic),
reps AS (SELECT * FROM ({REPRESENTATIVE_SQL}) WHERE rank <= 3)"""


def label_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked terms per label, as the model's description step gives them."""
    rows = labelled(spark, sf_dir)
    model = TopicModel(stop_words=stop_words(spark, sf_dir))
    return model.terms(rows, rows)["topic_terms"]


def info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.topic_info(
        topics.topic_frequency(vectors(spark, sf_dir)),
        label_terms(spark, sf_dir),
        representatives(spark, sf_dir, 3),
    )


INFO_SQL = f"""
WITH {LABEL_TERMS_SQL}
SELECT f.topic, f.count, name, representation,
       (SELECT string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) FROM reps WHERE reps.topic = f.topic) AS representative_docs
FROM (SELECT topic, count(*) AS count FROM ({VECTORS_SQL}) GROUP BY topic) f JOIN named USING (topic)"""


def flat_info(rows: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("representative_docs").cast("array<string>"), ",")
    return rows.withColumn("representation", F.array_join("representation", ", ")).withColumn(
        "representative_docs", ids
    )


@query("a14_topic_info", INFO_SQL)
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_info(info(spark, sf_dir))


@query(
    "j14_document_info",
    f"""SELECT d.doc_id, d.lang, v.topic, i.count, i.name FROM documents d
        LEFT JOIN ({VECTORS_SQL}) v USING (doc_id) LEFT JOIN ({INFO_SQL}) i ON i.topic = v.topic""",
)
def j14(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = docs(spark, sf_dir).select("doc_id", "lang")
    assigned = vectors(spark, sf_dir).select("doc_id", "topic")
    return topics.document_info(rows, assigned, info(spark, sf_dir)).select(
        "doc_id", "lang", "topic", "count", "name"
    )


@query(
    "m19_prompts",
    f"""WITH {LABEL_TERMS_SQL}
        SELECT topic, md5('Words: ' || representation || chr(10) || 'Texts: ' || texts) AS digest FROM named JOIN (
          SELECT reps.topic, string_agg(text, chr(10) ORDER BY rank) AS texts FROM reps JOIN labelled USING (doc_id)
          GROUP BY reps.topic) USING (topic)""",
)
def m19(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts over the topics whose representatives have a text."""
    filled = topics.prompts(
        label_terms(spark, sf_dir), representatives(spark, sf_dir, 3), docs(spark, sf_dir),
        template="Words: [KEYWORDS]\nTexts: [DOCUMENTS]",
    )
    return filled.select("topic", F.md5("prompt").alias("digest"))


@query(
    "m10_update_terms",
    f"""WITH {weights_sql(2, False, 10)},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY round(score, 9) DESC, term) AS rank FROM weights)
        SELECT topic, term, rank, round(score, 6) AS score FROM ranked WHERE rank <= 10""",
)
def m10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New vectorizer settings on stored assignments."""
    rows = classed(spark, sf_dir)
    model = TopicModel(stop_words=stop_words(spark, sf_dir), ngrams=2, min_df=10, top_words=10)
    return rounded(model.terms(rows, rows)["topic_terms"])


@query(
    "m11_merge_topics",
    "SELECT CASE WHEN label IN (7, 8, 9) THEN 1 ELSE CAST(label AS BIGINT) END AS topic, count(*) AS count FROM embeddings GROUP BY 1",
)
def m11(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = spark.createDataFrame([(7, 1), (8, 1), (9, 1)], "topic bigint, into bigint")
    merged = topics.merge_topics(vectors(spark, sf_dir).select("doc_id", "topic"), mapping)
    return topics.topic_frequency(merged)


# --- classes and periods -------------------------------------------------------------


def local_sql(group: str) -> str:
    return f"""
counts AS (SELECT topic, {group}, term, count(*) AS tf FROM grams SEMI JOIN vocab USING (term) GROUP BY ALL),
sums AS (SELECT topic, {group}, sum(tf) AS total FROM counts GROUP BY ALL),
local AS (SELECT topic, {group}, term, sqrt(tf / total) * idf AS score
          FROM counts JOIN sums USING (topic, {group}) JOIN idfs USING (term)),
freq AS (SELECT topic, {group}, count(*) AS frequency FROM words GROUP BY ALL)"""


def top_sql(source: str, group: str, n: int = 5) -> str:
    return f"""
best AS (SELECT topic, {group}, string_agg(term, ', ' ORDER BY r) AS words FROM (
           SELECT *, row_number() OVER (PARTITION BY topic, {group} ORDER BY round(score, 9) DESC, term) AS r
           FROM {source}) WHERE r <= {n} GROUP BY ALL)"""


PER_CLASS_SQL = f"""
WITH {weights_sql()}, {local_sql('lang')}, {top_sql('local', 'lang')}
SELECT topic, lang, words, frequency FROM freq LEFT JOIN best USING (topic, lang)"""


def per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts, vocab = counted(spark, sf_dir, "lang")
    rows = classed(spark, sf_dir).drop("text")
    return topics.topics_per_class(rows, counts, vocab, seeds(spark, sf_dir), "lang")


@query("a18_topics_per_class", PER_CLASS_SQL)
def a18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return per_class(spark, sf_dir).withColumn("words", F.array_join("words", ", "))


@query(
    "w06_normalised_frequency",
    """SELECT topic, lang, frequency, round(frequency / sqrt(sum(frequency * frequency) OVER (PARTITION BY topic)), 6) AS normalised
       FROM (SELECT CAST(substr(source, 4) AS BIGINT) AS topic, lang, count(*) AS frequency FROM documents GROUP BY ALL)""",
)
def w06(spark: SparkSession, sf_dir: str) -> DataFrame:
    frequency = topics.group_frequency(classed(spark, sf_dir), "lang")
    return topics.normalised_frequency(frequency).withColumn("normalised", F.round("normalised", 6))


TUNED_SQL = f"""
WITH {weights_sql()}, {local_sql('period')},
shares AS (SELECT topic, period, term, score / sum(score) OVER (PARTITION BY topic, period) AS s FROM local),
whole AS (SELECT topic, term, score / sum(score) OVER (PARTITION BY topic) AS g FROM weights),
grid AS (SELECT topic, period, term, g, coalesce(s, 0) AS s
         FROM freq JOIN whole USING (topic) LEFT JOIN shares USING (topic, period, term)),
chained AS (SELECT c.*, p.topic IS NOT NULL AS had, coalesce(o.s, 0) AS o FROM grid c
            LEFT JOIN freq p ON p.topic = c.topic AND p.period = c.period - 1
            LEFT JOIN shares o ON o.topic = c.topic AND o.period = c.period - 1 AND o.term = c.term),
tuned AS (SELECT topic, period, term, (CASE WHEN had THEN (s + o) / 2 ELSE s END + g) / 2 AS score FROM chained)"""


def over_time(spark: SparkSession, sf_dir: str, **tuning) -> DataFrame:
    counts, vocab = counted(spark, sf_dir, "period")
    seed = durable(seeds(spark, sf_dir))
    whole = durable(terms.class_weights(counts, vocab, seed))
    rows = classed(spark, sf_dir).drop("text")
    return topics.topics_over_time(rows, counts, vocab, seed, whole, "period", **tuning)


@query(
    "a19_topics_over_time",
    f"""WITH {weights_sql()}, {local_sql('period')}, {top_sql('local', 'period')}
        SELECT topic, period, words, frequency FROM freq LEFT JOIN best USING (topic, period)""",
)
def a19(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = over_time(spark, sf_dir, evolution=False, global_tuning=False)
    return rows.withColumn("words", F.array_join("words", ", "))


@query(
    "w05_tuned_over_time",
    f"{TUNED_SQL}, {top_sql('tuned', 'period')} SELECT topic, period, words, frequency FROM freq LEFT JOIN best USING (topic, period)",
)
def w05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_time(spark, sf_dir).withColumn("words", F.array_join("words", ", "))


@query(
    "w13_top_topics",
    f"""SELECT topic, doc_id FROM ({VECTORS_SQL}) WHERE topic IN (
          SELECT topic FROM ({VECTORS_SQL}) GROUP BY topic ORDER BY count(*) DESC, topic LIMIT 6)""",
)
def w13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir).select("topic", "doc_id")
    return topics.keep_topics(rows, topics.top_topics(topics.topic_frequency(rows), 6))


@query(
    "w13_listed_topics",
    f"SELECT topic, doc_id FROM ({VECTORS_SQL}) WHERE topic IN (1, 4, 7)",
)
def w13_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.keep_topics(vectors(spark, sf_dir).select("topic", "doc_id"), [1, 4, 7])


@query(
    "u04_lemma_tokenizer",
    f"""WITH words AS (SELECT doc_id, regexp_replace(unnest({TOKENS_SQL}), '(ing|tion|s)$', '') AS term FROM documents)
        SELECT term, count(*) AS f, count(DISTINCT doc_id) AS df FROM words WHERE term <> '' GROUP BY term
        HAVING count(DISTINCT doc_id) >= 6""",
)
def u04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokenizer is exchangeable: here one that cuts a few endings."""
    from ..functions.text import tokens

    def stems(text):
        cut = F.transform(tokens(text), lambda w: F.regexp_replace(w, "(ing|tion|s)$", ""))
        return F.filter(cut, lambda w: w != "")

    rows = terms.term_arrays(classed(spark, sf_dir), None, 1, tokenizer=stems)
    return terms.vocabulary(terms.group_counts(rows, "topic"))
