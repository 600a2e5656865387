"""Topic models: fit, assign, probabilities, zero-shot, updates, distributions."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.text import tokens
from ..functions.vector import bind, cosine
from ..session import durable
from ..sources.sinks import load_tables, save_tables
from .density import NOISE, centre_clusters, density_clusters
from .embed import word_vectors
from .neighbours import BROADCAST_BYTES, Metric, clean, fits, knn
from .reduce import fit_projection, project
from .termcounts import _cut
from .terms import (
    MAX_FEATURES, MIN_DF, SEED_BOOST, TOP_WORDS, class_weights, ranked_vocabulary,
    term_arrays, top_terms,
)
from .topics import centroids, topic_frequency

ZERO_SHOT_SIMILARITY = 0.3
MIN_PROBABILITY = 0.015
BLOCK_ROWS = 4096
TOPICS = 16  # compared with windows at once
WINDOW_TOKENS = 1 << 16  # at once


# --- assignment to known topics ------------------------------------------------------


def assign(docs: DataFrame, centres: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Nearest topic by cosine: (doc_id, topic, similarity)."""
    real = centres.filter(F.col("topic") >= 0)
    best = knn(
        docs, real, 1, query_key="doc_id", base_key="topic", vector="embedding",
        base_vector="centroid", broadcast_bytes=broadcast_bytes,
    )
    return best.select(
        F.col("id").alias("doc_id"), F.col("neighbour").alias("topic"),
        (1 - F.col("distance")).alias("similarity"),
    )


def zero_shot(
    docs: DataFrame, labels: DataFrame, min_similarity: float = ZERO_SHOT_SIMILARITY
) -> DataFrame:
    """Best label (label_id, embedding) per doc; below the threshold the topic is noise."""
    best = knn(docs, labels, 1, query_key="doc_id", base_key="label_id")
    similarity = F.round(1 - F.col("distance"), 9)
    topic = F.when(similarity >= min_similarity, F.col("neighbour")).otherwise(NOISE)
    return best.select(
        F.col("id").alias("doc_id"), topic.alias("topic"), similarity.alias("similarity")
    )


def reassign_noise(
    docs: DataFrame, assignment: DataFrame, centres: DataFrame, min_similarity: float = 0.0
) -> DataFrame:
    """Move noise docs to their nearest topic if it is similar enough."""
    noise = docs.join(assignment.filter(F.col("topic") == NOISE), "doc_id", "left_semi")
    near = assign(noise, centres).filter(F.col("similarity") >= min_similarity)
    moved = near.select("doc_id", F.col("topic").alias("__to"))
    return assignment.join(moved, "doc_id", "left").select(
        "doc_id", F.coalesce("__to", "topic").alias("topic")
    )


# --- dense scores against a list of vectors ------------------------------------------


def _blocks(base: DataFrame, budget: int) -> list[DataFrame]:
    """The base whole if it fits the budget, else in hash blocks that do."""
    if fits(base, budget):
        return [base]
    n = -(-base.count() // BLOCK_ROWS)
    return [base.filter(F.pmod(F.xxhash64("id"), F.lit(n)) == i) for i in range(n)]


def similarities(
    queries: DataFrame, base: DataFrame, broadcast_bytes: int = BROADCAST_BYTES,
    blocks: list[DataFrame] | None = None,
) -> DataFrame:
    """(id, block, scores) with ``scores`` an array of (id, similarity) over one block of base.

    Both sides are (id, vec). The result has one row per query and block, not per pair. ``blocks``
    are those of the base, if the caller has them already.
    """
    spark = queries.sparkSession
    kind = queries.schema["id"].dataType.simpleString()
    other = base.schema["id"].dataType.simpleString()
    schema = f"id {kind}, block int, scores array<struct<id:{other},similarity:double>>"
    ids_type = to_arrow_type(base.schema["id"].dataType)
    out = None
    for number, block in enumerate(_blocks(base, broadcast_bytes) if blocks is None else blocks):
        rows = sorted(block.collect())
        if not rows:
            continue
        ids = [r["id"] for r in rows]
        shared = spark.sparkContext.broadcast((ids, Metric("cosine").prepare([r["vec"] for r in rows])))

        def score(batches: Iterator[pa.RecordBatch], shared=shared, number=number):
            ids, b = shared.value
            names = pa.array(ids, ids_type)
            step = max(1, (1 << 20) // len(ids))
            for batch in batches:
                for i in range(0, batch.num_rows, step):
                    part = batch.slice(i, step)
                    flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    q = flat.reshape(part.num_rows, -1)
                    s = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ b.T
                    pairs = pa.StructArray.from_arrays(
                        [names.take(pa.array(np.tile(np.arange(len(ids)), len(s)))), pa.array(s.ravel())], ["id", "similarity"]
                    )
                    cuts = pa.array(np.arange(len(s) + 1, dtype=np.int32) * len(ids))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(np.full(len(s), number, np.int32)), pa.ListArray.from_arrays(cuts, pairs)],
                        names=["id", "block", "scores"],
                    )

        part = queries.select("id", "vec").mapInArrow(score, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def topic_probabilities(
    docs: DataFrame, centres: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(doc_id, probabilities): softmax of the similarities to all topics, one row per doc."""
    m = Metric("cosine")
    base = clean(centres.filter(F.col("topic") >= 0), "topic", "centroid", m)
    blocks = _blocks(base, broadcast_bytes)
    scored = similarities(clean(docs, "doc_id", "embedding", m), base, broadcast_bytes, blocks)
    if len(blocks) == 1:  # every row has all its scores already
        rows = scored.select("id", "scores")
    else:
        rows = scored.groupBy("id").agg(F.flatten(F.collect_list("scores")).alias("scores"))
    total = F.aggregate("scores", F.lit(0.0), lambda acc, s: acc + F.exp(s["similarity"]))
    shared = bind(
        F.struct(F.col("scores").alias("all"), total.alias("total")),
        lambda x: F.transform(
            x["all"],
            lambda s: F.struct(
                s["id"].alias("topic"), (F.exp(s["similarity"]) / x["total"]).alias("probability")
            ),
        ),
    )
    return rows.select(F.col("id").alias("doc_id"), shared.alias("probabilities"))


def likely_topics(probabilities: DataFrame, minimum: float = MIN_PROBABILITY) -> DataFrame:
    """Rows (doc_id, topic, probability) at or above a minimum."""
    kept = F.filter("probabilities", lambda p: p["probability"] >= minimum)
    return probabilities.select("doc_id", F.inline(kept))


def topic_matrix(centres: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(topic, scores): similarity of every topic to every topic, one row per topic and block."""
    base = clean(centres, "topic", "centroid", Metric("cosine"))
    return similarities(base, base, broadcast_bytes).select(
        F.col("id").alias("topic"), "scores"
    )


def merge_order(matrix: DataFrame) -> DataFrame:
    """Topic pairs (a, b, distance) with a < b, closest first."""
    pairs = matrix.select(F.col("topic").alias("a"), F.inline("scores").alias("b", "similarity"))
    return (
        pairs.filter("a < b")
        .select("a", "b", (1 - F.col("similarity")).alias("distance"))
        .orderBy(F.round("distance", 9), "a", "b")
    )


# --- model ---------------------------------------------------------------------------

MODEL_TABLES = ["assignment", "topic_terms", "centroids", "vocabulary", "frequency"]


def reduce_with_pca(k: int = 10) -> Callable[[DataFrame], DataFrame]:
    def reduce(points: DataFrame) -> DataFrame:
        done = project(points, fit_projection(points, k))
        return done.select("doc_id", F.col("projected").alias("embedding"))

    return reduce


@dataclass
class TopicModel:
    """A topic model as exchangeable stages; every stage is a function over DataFrames.

    ``reduce`` and ``cluster`` map (doc_id, embedding) to (doc_id, embedding) and
    (doc_id, topic). ``describe`` may re-rank the top terms.
    """

    reduce: Callable[[DataFrame], DataFrame] = field(default_factory=reduce_with_pca)
    cluster: Callable[[DataFrame], DataFrame] = density_clusters
    tokenizer: Callable = tokens
    stop_words: DataFrame | None = None
    seeds: DataFrame | None = None
    ngrams: int = 3
    min_df: int = MIN_DF
    max_features: int = MAX_FEATURES
    df_scope: str = "doc"
    boost: float = SEED_BOOST
    top_words: int = TOP_WORDS
    describe: Callable[[DataFrame], DataFrame] | None = None

    def terms(self, docs: DataFrame, assignment: DataFrame) -> dict[str, DataFrame]:
        """Vocabulary and ranked topic terms for stored assignments, without a new fit."""
        labelled = docs.select("doc_id", "text").join(assignment.select("doc_id", "topic"), "doc_id")
        words = term_arrays(labelled, self.stop_words, 1, tokenizer=self.tokenizer)
        words = durable(words.select("topic", "terms"))  # read twice
        counts, vocab = ranked_vocabulary(
            words, "topic", high=self.ngrams, min_df=self.min_df,
            max_features=self.max_features, df_scope=self.df_scope,
        )
        weights = class_weights(counts, vocab, self.seeds, self.boost)
        ranked = top_terms(weights, self.top_words)
        ranked = self.describe(ranked) if self.describe else ranked
        return {"vocabulary": vocab, "topic_terms": ranked.select("topic", "term", "score", "rank")}

    def fit(self, docs: DataFrame) -> dict[str, DataFrame]:
        """Model tables from docs (doc_id, text, embedding)."""
        vectors = docs.select("doc_id", "embedding").filter(F.size("embedding") > 0)
        topics = durable(self.cluster(self.reduce(vectors)))
        return self.tables(docs, topics)

    def tables(self, docs: DataFrame, topics: DataFrame) -> dict[str, DataFrame]:
        vectors = docs.select("doc_id", "embedding").filter(F.size("embedding") > 0)
        centres = durable(centroids(vectors.join(topics, "doc_id")))
        likely = topic_probabilities(vectors, centres)
        own = F.get(F.filter("probabilities", lambda p: p["topic"] == F.col("topic")), F.lit(0))
        assignment = topics.select("doc_id", "topic").join(likely, "doc_id", "left").select(
            "doc_id", "topic", F.coalesce(own["probability"], F.lit(0.0)).alias("probability")
        )
        return {
            "assignment": assignment,
            "centroids": centres,
            "frequency": topic_frequency(topics),
            **self.terms(docs, topics),
        }

    def fit_zero_shot(
        self, docs: DataFrame, labels: DataFrame, min_similarity: float = ZERO_SHOT_SIMILARITY
    ) -> DataFrame:
        """Label topics first, clusters for the rest behind them: (doc_id, topic).

        ``labels`` is (label_id, embedding) with ids from 0. Cluster ids start after them.
        """
        vectors = docs.select("doc_id", "embedding").filter(F.size("embedding") > 0)
        shot = durable(zero_shot(vectors, labels, min_similarity).select("doc_id", "topic"))
        matched = shot.filter(F.col("topic") != NOISE)
        rest = vectors.join(matched, "doc_id", "left_anti")
        offset = labels.agg(F.max("label_id") + 1).first()[0]
        clustered = self.cluster(self.reduce(rest)) if not rest.isEmpty() else matched.limit(0)
        shifted = clustered.select(
            "doc_id",
            F.when(F.col("topic") >= 0, F.col("topic") + offset).otherwise(NOISE).alias("topic"),
        )
        return matched.unionByName(shifted)


def save_model(tables: dict[str, DataFrame], path: str) -> None:
    save_tables(tables, path)


def load_model(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return load_tables(spark, path, MODEL_TABLES)


def load_or_fit(
    spark: SparkSession, path: str, fit: Callable[[], dict[str, DataFrame]]
) -> dict[str, DataFrame]:
    """The model saved at a path; if there is none, or not all of it, that of ``fit()``, saved there."""
    try:
        return load_model(spark, path)
    except AnalysisException as missing:  # a table that was never written, or not to its end
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    save_model(fit(), path)
    return load_model(spark, path)


CLUSTERERS: dict[str, Callable[..., DataFrame]] = {
    "density": density_clusters,
    "centres": centre_clusters,
}


# --- finer descriptions --------------------------------------------------------------


def rerank_by_similarity(
    candidates: DataFrame, term_vectors: DataFrame, topic_vectors: DataFrame, n: int
) -> DataFrame:
    """Candidate terms of a topic ordered by cosine to the topic's vector."""
    scored = (
        candidates.select("topic", "term")
        .join(term_vectors, "term")
        .join(topic_vectors, "topic")
        .select("topic", "term", cosine("vector", "centroid").alias("score"))
    )
    return top_terms(scored, n)


def word_space(docs: DataFrame, assignment: DataFrame, dimensions: int = 32, min_count: int = MIN_DF):
    """(term vectors, topic vectors) in one space: words, and the mean of their documents."""
    from pyspark.ml.functions import vector_to_array

    terms, model = word_vectors(docs, dimensions, min_count)
    words = docs.select("doc_id", tokens("text").alias("words")).join(assignment, "doc_id")
    placed = model.transform(words).select("topic", vector_to_array("vector").alias("embedding"))
    return terms, centroids(placed)


def window_distribution(
    docs: DataFrame, weights: DataFrame, window: int = 4, min_similarity: float = 0.1,
    tokenizer=tokens, broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Topic shares from token windows: (doc level, token level).

    Each run of ``window`` tokens (stride one; a shorter text is one window) is compared
    with every topic's term scores by cosine, tokens counted one by one. Similarities from
    the minimum up are spread over the tokens of the window and summed by token and by
    document; document rows add up to one. Documents are worked on where they are, against the
    weights as one table that every task gets; no token is a row of a join. Only documents that share
    their key, whose windows are added up, and weights beyond the budget take joins (``_window_rows``).
    """
    lengths = weights.groupBy("topic").agg(F.sqrt(F.sum(F.col("score") ** 2)).alias("__len"))
    scored = weights.select("topic", "term", "score", "idf").join(lengths, "topic")
    scored = scored.select(
        "topic", "term", "idf", (F.col("score") * F.col("idf") / F.col("__len")).alias("part")
    )
    words = docs.filter("doc_id IS NOT NULL").select(tokenizer("text").alias("__t"), "doc_id")
    most = broadcast_bytes // 64
    if scored.limit(most + 1).count() > most:
        by_token = _window_rows(words, scored, window, min_similarity)
        by_doc = by_token.groupBy("doc_id", "topic").agg(F.sum("score").alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(scored.toArrow())
        repeated = durable(words.groupBy("doc_id").count().filter("count > 1").select("doc_id"))
        some = not repeated.isEmpty()
        single = words.join(repeated, "doc_id", "left_anti").select("__t", "doc_id") if some else words
        key, topic = (df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (weights, "topic")))
        run = lambda whole: lambda b: _windows(b, shared.value, window, min_similarity, whole)
        by_token = single.mapInArrow(run(False), f"doc_id {key}, pos int, topic {topic}, score double")
        by_doc = single.mapInArrow(run(True), f"doc_id {key}, topic {topic}, score double")
        if some:
            rest = _window_rows(words.join(repeated, "doc_id", "left_semi"), scored, window, min_similarity)
            by_token = by_token.unionByName(rest)
            by_doc = by_doc.unionByName(rest.groupBy("doc_id", "topic").agg(F.sum("score").alias("score")))
    total = F.sum("score").over(Window.partitionBy("doc_id"))
    shares = by_doc.withColumn("probability", F.col("score") / total).drop("score")
    return shares, by_token


def _ahead(x: np.ndarray, left: np.ndarray, window: int) -> np.ndarray:
    """Sums over each token and those behind it in its text, ``window`` in all; ``left`` are to its end."""
    out = x.copy()
    for j in range(1, min(window, len(x))):
        out[:-j] += np.where(left[:-j] > j, x[j:].T, 0).T
    return out


def _windows(
    batches: Iterator[pa.RecordBatch], scored: pa.Table, window: int, min_similarity: float, whole: bool
) -> Iterator[pa.RecordBatch]:
    """(doc_id, pos, topic, score) of (tokens, doc_id), or (doc_id, topic, score) if ``whole``."""
    get = lambda c: scored[c].combine_chunks().dictionary_encode()
    terms, topics = get("term"), get("topic")
    term, topic = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (terms, topics))
    place, none = {w: i for i, w in enumerate(terms.dictionary.to_pylist())}, len(terms.dictionary)
    part, square = scored["part"].to_numpy(), np.full(none + 1, -np.inf)
    np.maximum.at(square, term, scored["idf"].to_numpy())
    square[none] = 0  # of tokens that no topic knows
    square *= square
    slices = []
    for i in range(0, len(topics.dictionary), TOPICS):
        held = (topic >= i) & (topic < i + TOPICS)
        slices.append((i, min(TOPICS, len(topics.dictionary) - i), term[held], topic[held] - i, part[held]))
    for batch in _cut(batches, WINDOW_TOKENS):
        flat = batch.column(0).cast(pa.large_list(pa.string())).flatten().dictionary_encode()
        lens = pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(flat):
            continue
        code = np.array([place.get(w, none) for w in flat.dictionary.to_pylist()])[flat.indices.to_numpy(zero_copy_only=False)]
        row, n = np.repeat(np.arange(len(lens)), lens), np.repeat(lens, lens)
        pos = np.arange(len(code)) - np.repeat(np.cumsum(lens) - lens, lens)
        norm = np.sqrt(_ahead(square[code], n - pos, window))
        begins = (pos <= np.maximum(n - window, 0)) & (norm > 0)
        for first, width, at, of, value in slices:
            table, known = np.zeros((none + 1, width)), np.zeros((none + 1, width), np.int64)
            np.add.at(table, (at, of), value)
            np.add.at(known, (at, of), 1)
            close = _ahead(table[code], n - pos, window) / np.where(begins, norm, 1)[:, None]
            held = begins[:, None] & (np.floor(close * 1e9 + 0.5) / 1e9 >= min_similarity)
            held &= _ahead(known[code], n - pos, window) > 0
            # the windows that hold a token begin at it or before it: the same sums, backwards
            back = lambda x: _ahead(x[::-1], pos[::-1] + 1, window)[::-1]  # noqa: E731,B023
            score, hit = back(np.where(held, close, 0)), back(held.astype(np.int64)) > 0
            if whole:
                each = [np.bincount(row, x, len(lens)) for x in (*score.T, *hit.T)]
                score, hit = np.stack(each[:width], 1), np.stack(each[width:], 1) > 0
            token, column = np.nonzero(hit)
            columns = {
                "doc_id": batch.column(1).take(pa.array(token if whole else row[token])), "pos": pa.array(pos[token], pa.int32()),
                "topic": topics.dictionary.take(pa.array(column + first)), "score": pa.array(score[token, column]),
            }
            if whole:
                del columns["pos"]
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _window_rows(words: DataFrame, scored: DataFrame, window: int, min_similarity: float) -> DataFrame:
    """(doc_id, pos, topic, score) as ``_windows`` gives it, by joins of tokens: texts of one key are added up."""
    per_term = scored.groupBy("term").agg(
        F.max("idf").alias("idf"), F.collect_list(F.struct("topic", "part")).alias("parts")
    )
    words = words.select("doc_id", F.size("__t").alias("n"), F.posexplode("__t").alias("pos", "term"))
    known = words.join(per_term, "term").repartition("doc_id")
    last = F.greatest(F.col("n") - window, F.lit(0))
    starts = F.sequence(F.greatest(F.col("pos") - window + 1, F.lit(0)), F.least("pos", last))
    spread = known.select("doc_id", "n", "idf", "parts", F.explode(starts).alias("start"))
    lengths2 = spread.groupBy("doc_id", "start").agg(
        F.sqrt(F.sum(F.col("idf") ** 2)).alias("__norm"), F.max("n").alias("n")
    )
    dots = spread.select("doc_id", "start", F.inline("parts")).groupBy(
        "doc_id", "start", "topic"
    ).agg(F.sum("part").alias("__dot"))
    close = (
        dots.join(lengths2, ["doc_id", "start"])
        .withColumn("similarity", F.col("__dot") / F.col("__norm"))
        .filter(F.round("similarity", 9) >= min_similarity)
    )
    end = F.least(F.col("start") + window, F.col("n")) - 1
    return (
        close.select("doc_id", "topic", "similarity", F.explode(F.sequence("start", end)).alias("pos"))
        .groupBy("doc_id", "pos", "topic")
        .agg(F.sum("similarity").alias("score"))
    )
