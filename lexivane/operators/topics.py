"""Describing topics: frequency, names, representatives, per class and over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import SUMMARY_PROMPT, fill_prompt
from ..functions.vector import dot, mean_vector, norm
from ..session import durable
from .terms import CLASS_WORDS, SEED_BOOST, in_vocabulary, top_terms, weigh, words_of


def topic_frequency(assignment: DataFrame) -> DataFrame:
    return assignment.groupBy("topic").agg(F.count("*").alias("count"))


def top_topics(frequency: DataFrame, n: int) -> DataFrame:
    """The n biggest real topics."""
    return frequency.filter("topic >= 0").orderBy(F.desc("count"), "topic").limit(n)


def keep_topics(rows: DataFrame, topics: DataFrame | list[int]) -> DataFrame:
    if isinstance(topics, list):
        return rows.filter(F.col("topic").isin(topics))
    return rows.join(topics.select("topic"), "topic", "left_semi")


def centroids(assigned: DataFrame, vector: str = "embedding") -> DataFrame:
    """(topic, centroid) as means of doc vectors, partially aggregated per task."""
    return assigned.groupBy("topic").agg(mean_vector(vector).alias("centroid"))


def representative_docs(
    assigned: DataFrame, centres: DataFrame, n: int, vector: str = "embedding", key: str = "doc_id"
) -> DataFrame:
    """The n docs of every topic closest to its centroid: (topic, doc, similarity, rank)."""
    # one norm per topic, so only the dot product and one norm are left per row
    unit = centres.select("topic", "centroid", norm("centroid").alias("__len"))
    similarity = dot(F.col(vector), F.col("centroid")) / (norm(vector) * F.col("__len"))
    scored = assigned.join(unit, "topic").select("topic", key, similarity.alias("similarity"))
    by = Window.partitionBy("topic").orderBy(F.desc(F.round("similarity", 9)), key)
    return (
        scored.withColumn("rank", F.row_number().over(by))
        .filter(F.col("rank") <= n)
        .withColumn("rank", F.col("rank").cast("bigint"))
    )


def topic_names(ranked: DataFrame, n: int = 4) -> DataFrame:
    """``id_w1_w2_w3_w4``."""
    words = words_of(ranked.filter(F.col("rank") <= n))
    name = F.concat_ws("_", F.col("topic").cast("string"), F.array_join("words", "_"))
    return words.select("topic", name.alias("name"))


def topic_info(
    frequency: DataFrame, ranked: DataFrame, representatives: DataFrame, key: str = "doc_id"
) -> DataFrame:
    """(topic, count, name, representation, representative_docs)."""
    docs = representatives.groupBy("topic").agg(
        F.array_sort(F.collect_list(F.struct("rank", key))).alias("__d")
    ).select("topic", F.col(f"__d.{key}").alias("representative_docs"))
    return (
        frequency.join(topic_names(ranked), "topic", "left")
        .join(words_of(ranked, out="representation"), "topic", "left")
        .join(docs, "topic", "left")
    )


def document_info(docs: DataFrame, assignment: DataFrame, info: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every document with its topic row."""
    return docs.join(assignment, key, "left").join(info, "topic", "left")


def label_topics(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Add a label by topic id; null without one."""
    return rows.join(labels.select("topic", "label"), "topic", "left")


def prompts(
    ranked: DataFrame, representatives: DataFrame, docs: DataFrame, key: str = "doc_id",
    text: str = "text", template: str = SUMMARY_PROMPT,
) -> DataFrame:
    """Prompt text per topic from its keywords and the full text of its representatives."""
    lines = (
        representatives.select("topic", "rank", key)
        .join(docs.select(key, text), key)
        .groupBy("topic")
        .agg(F.array_sort(F.collect_list(F.struct("rank", text))).alias("__t"))
        .select("topic", F.array_join(F.col(f"__t.{text}"), "\n").alias("__docs"))
    )
    words = words_of(ranked)
    return words.join(lines, "topic").select(
        "topic", fill_prompt(F.array_join("words", ", "), F.col("__docs"), template).alias("prompt")
    )


def merge_topics(assignment: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace topic ids by ``mapping`` (topic, into); ids without an entry stay."""
    joined = assignment.join(mapping.select("topic", "into"), "topic", "left")
    return joined.withColumn("topic", F.coalesce("into", "topic")).drop("into")


def grouped_weights(
    counts: DataFrame, vocab: DataFrame, seeds: DataFrame | None, group: str
) -> DataFrame:
    """Weights of (topic, group, term): shares inside the group, idf of the whole corpus.

    ``counts`` is group_counts by topic and group; the topic totals are rolled up from it.
    """
    kept = in_vocabulary(counts, vocab, seeds, SEED_BOOST, "topic", group)
    corpus = kept.groupBy("topic").agg(F.sum("tf").alias("total"))
    return weigh(kept, corpus, True, "topic", group)


def group_frequency(docs: DataFrame, group: str) -> DataFrame:
    return docs.groupBy("topic", group).agg(F.count("*").alias("frequency"))


def topics_per_class(
    docs: DataFrame, counts: DataFrame, vocab: DataFrame, seeds: DataFrame | None, group: str,
    n: int = CLASS_WORDS,
) -> DataFrame:
    """(topic, class, words, frequency), words scored with the corpus idf."""
    best = top_terms(grouped_weights(counts, vocab, seeds, group), n, "topic", group)
    words = words_of(best, "topic", group)
    return group_frequency(docs, group).join(words, ["topic", group], "left")


def normalised_frequency(per_class: DataFrame) -> DataFrame:
    """Frequencies of a topic over its classes scaled to unit length."""
    lengths = per_class.groupBy("topic").agg(
        F.sqrt(F.sum(F.col("frequency") * F.col("frequency"))).alias("__len")
    )
    return per_class.join(lengths, "topic").withColumn(
        "normalised", F.col("frequency") / F.col("__len")
    ).drop("__len")


def l1_share(weights: DataFrame, *groups: str) -> DataFrame:
    """Scores divided by their group's sum."""
    sums = weights.groupBy(*groups).agg(F.sum("score").alias("__sum"))
    return weights.join(sums, list(groups)).withColumn(
        "score", F.col("score") / F.col("__sum")
    ).drop("__sum")


def tuned_weights(
    weights: DataFrame, global_weights: DataFrame, present: DataFrame, period: str, n: int,
    evolution: bool = True, global_tuning: bool = True,
) -> DataFrame:
    """Smoothed (topic, period, term, score).

    Vectors are scaled to sum one. A topic that occurred in the preceding period is
    averaged with its vector there; then the result is averaged with the topic's global
    vector. Of the global vector only the ``n`` best terms per topic are carried into every
    period: a term outside both period vectors and below those n cannot reach the top n.
    """
    periods = present.select(period).distinct()
    order = Window.orderBy(period)
    following = periods.select(period, F.lead(period).over(order).alias("__next"))
    local = durable(l1_share(weights.select("topic", period, "term", "score"), "topic", period))
    parts = local.select("topic", period, "term", F.col("score").alias("now"), F.lit(0.0).alias("old"))
    occurs = present.select("topic", period).distinct()
    if evolution:
        carried = (
            local.join(following.filter("__next is not null"), period)
            .select("topic", F.col("__next").alias(period), "term", F.lit(0.0).alias("now"), F.col("score").alias("old"))
            .join(occurs, ["topic", period], "left_semi")
        )
        parts = parts.unionByName(carried)
        before = occurs.join(following, period).select(
            "topic", F.col("__next").alias(period), F.lit(True).alias("__had")
        )
        occurs = occurs.join(before, ["topic", period], "left")
    else:
        occurs = occurs.withColumn("__had", F.lit(None).cast("boolean"))
    shares = l1_share(global_weights.select("topic", "term", "score"), "topic")
    if global_tuning:
        best = top_terms(shares, n).select("topic", "term")
        parts = parts.unionByName(
            best.join(occurs.select("topic", period), "topic").select(
                "topic", period, "term", F.lit(0.0).alias("now"), F.lit(0.0).alias("old")
            )
        )
    merged = parts.groupBy("topic", period, "term").agg(
        F.sum("now").alias("now"), F.sum("old").alias("old")
    ).join(occurs, ["topic", period])
    score = F.when(F.col("__had"), (F.col("now") + F.col("old")) / 2).otherwise(F.col("now"))
    merged = merged.withColumn("score", score)
    if global_tuning:
        wide = shares.select("topic", "term", F.col("score").alias("__g"))
        merged = merged.join(wide, ["topic", "term"], "left").withColumn(
            "score", (F.col("score") + F.coalesce("__g", F.lit(0.0))) / 2
        )
    return merged.select("topic", period, "term", "score")


def topics_over_time(
    docs: DataFrame, counts: DataFrame, vocab: DataFrame, seeds: DataFrame | None,
    global_weights: DataFrame, period: str, n: int = CLASS_WORDS, evolution: bool = True,
    global_tuning: bool = True,
) -> DataFrame:
    """(topic, period, words, frequency) with both kinds of smoothing by default."""
    weights = grouped_weights(counts, vocab, seeds, period)
    frequency = group_frequency(docs, period)
    if evolution or global_tuning:
        weights = tuned_weights(
            weights, global_weights, frequency, period, n, evolution, global_tuning
        )
    words = words_of(top_terms(weights, n, "topic", period), "topic", period)
    return frequency.join(words, ["topic", period], "left")
