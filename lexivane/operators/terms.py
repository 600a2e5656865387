"""Vocabulary, term counts and class-based term weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import add_ngrams, drop_stop_words, tokens
from ..session import durable
from ..sources.corpus import with_row_index
from .termcounts import ranked_counts

# Fixed values of the published setting.
MIN_DF = 6
MAX_FEATURES = 100_000
SEED_BOOST = 10.0
TOP_WORDS = 35
BAR_WORDS = 8
CLASS_WORDS = 5


def term_arrays(
    docs: DataFrame, stop_words: DataFrame | None = None, high: int = 3,
    text: str = "text", key: str = "doc_id", tokenizer=tokens,
) -> DataFrame:
    """Docs with a ``terms`` array: tokens without stop words, as 1- to ``high``-grams.

    ``tokenizer`` maps a text column to an array of tokens and may be exchanged.
    """
    df = docs.withColumn("terms", tokenizer(text)).drop(text)
    if stop_words is not None:
        df = drop_stop_words(df, "terms", stop_words, key)
    return add_ngrams(df, "terms", "terms", 1, high)


def group_counts(arrays: DataFrame, *groups: str) -> DataFrame:
    """tf and number of docs per (groups, term), counted right behind the explode.

    A document contributes its terms once with their repetitions and once without, so one
    pass and one shuffle of partial sums give both counts.
    """
    every = F.transform(
        "terms", lambda t: F.struct(t.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("docs"))
    )
    once = F.transform(
        F.array_distinct("terms"),
        lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("docs")),
    )
    return (
        arrays.select(*groups, F.inline(F.concat(every, once)))
        .groupBy(*groups, "term")
        .agg(F.sum("tf").alias("tf"), F.sum("docs").alias("docs"))
    )


def vocabulary(
    counts: DataFrame, min_df: int = MIN_DF, max_features: int = MAX_FEATURES,
    df_scope: str = "doc", topic: str = "topic",
) -> DataFrame:
    """(term, f, df): terms frequent enough, the ``max_features`` most frequent of them.

    ``df_scope='doc'`` counts documents, ``'topic'`` counts topics. Ties go by term. The cut
    frequency comes from a histogram of frequencies; only the terms that have exactly it are
    put in order, by a distributed sort, so no task holds the vocabulary.
    """
    df = {"doc": F.sum("docs"), "topic": F.count_distinct(topic)}[df_scope]
    terms = counts.groupBy("term").agg(F.sum("tf").alias("f"), df.alias("df"))
    found = durable(terms.filter(F.col("df") >= min_df))
    down = Window.orderBy(F.desc("f")).rowsBetween(Window.unboundedPreceding, 0)
    histogram = found.groupBy("f").agg(F.count("*").alias("n")).withColumn("most", F.sum("n").over(down))
    cut = histogram.filter(F.col("most") > max_features).orderBy(F.desc("f")).first()
    if cut is None:
        return found
    room = max_features - (cut["most"] - cut["n"])
    tied = with_row_index(found.filter(F.col("f") == cut["f"]), ["term"], "term", "__place")
    kept = tied.filter(F.col("__place") < room).select(*found.columns)
    return found.filter(F.col("f") > cut["f"]).unionByName(kept)


def ranked_vocabulary(
    arrays: DataFrame, *groups: str, high: int = 3, min_df: int = MIN_DF,
    max_features: int = MAX_FEATURES, df_scope: str = "doc", topic: str = "topic",
) -> tuple[DataFrame, DataFrame]:
    """(counts, vocabulary) of the n-grams of token arrays, as ``group_counts`` and ``vocabulary``
    give them but for the counts of terms outside the vocabulary, most of which are missing."""
    return ranked_counts(
        arrays, *groups, most=max_features, high=high, min_df=min_df,
        vocabulary=lambda counts: vocabulary(counts, min_df, max_features, df_scope, topic),
    )


def in_vocabulary(
    counts: DataFrame, vocab: DataFrame, seeds: DataFrame | None, boost: float, *groups: str
) -> DataFrame:
    """Counts (groups, term, tf) of vocabulary terms with their ``f`` and ``boost``, written down.

    The vocabulary is joined first: rare terms are most rows and need no aggregation.
    """
    terms = vocab.select("term", "f").withColumn("boost", F.lit(1.0))
    if seeds is not None:
        flagged = seeds.select("term", F.lit(boost).alias("__b"))
        terms = terms.join(flagged, "term", "left").select(
            "term", "f", F.coalesce("__b", "boost").alias("boost")
        )
    kept = counts.select(*groups, "term", "tf").join(terms, "term")
    return durable(
        kept.groupBy(*groups, "term").agg(
            F.sum("tf").alias("tf"), F.first("f").alias("f"), F.first("boost").alias("boost")
        )
    )


def weigh(kept: DataFrame, topic_totals: DataFrame, reduce_frequent: bool, *groups: str) -> DataFrame:
    """Score rows by their share in the group and by idf.

    score = sqrt(tf / group total) * ln(1 + A / f) * boost, with A the mean topic total.
    """
    totals = kept.groupBy(*groups).agg(F.sum("tf").alias("total"))
    mean = topic_totals.agg(F.avg("total")).scalar()
    share = F.col("tf") / F.col("total")
    damped = F.sqrt(share) if reduce_frequent else share
    return (
        kept.join(totals, list(groups))
        .withColumn("idf", F.log1p(mean / F.col("f")) * F.col("boost"))
        .withColumn("score", damped * F.col("idf"))
        .drop("f", "boost")
    )


def class_weights(
    counts: DataFrame, vocab: DataFrame, seeds: DataFrame | None = None,
    boost: float = SEED_BOOST, reduce_frequent: bool = True, topic: str = "topic",
) -> DataFrame:
    """Class TF-IDF over the vocabulary: (topic, term, tf, total, idf, score)."""
    kept = in_vocabulary(counts, vocab, seeds, boost, topic)
    totals = kept.groupBy(topic).agg(F.sum("tf").alias("total"))
    return weigh(kept, totals, reduce_frequent, topic)


def top_terms(weights: DataFrame, n: int | None, *groups: str, score: str = "score") -> DataFrame:
    """Rank terms within their group by descending score, ties by term; keep ``n`` or all.

    Scores are compared to nine digits. A group holds at most the vocabulary.
    """
    by = Window.partitionBy(*(groups or ("topic",))).orderBy(F.desc(F.round(score, 9)), "term")
    ranked = weights.withColumn("rank", F.row_number().over(by))
    ranked = ranked if n is None else ranked.filter(F.col("rank") <= n)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def words_of(ranked: DataFrame, *groups: str, out: str = "words") -> DataFrame:
    """One row per group with its ranked terms as an array in rank order."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return ranked.groupBy(*(groups or ("topic",))).agg(ordered.alias("__o")).select(
        *(groups or ("topic",)), F.col("__o.term").alias(out)
    )
