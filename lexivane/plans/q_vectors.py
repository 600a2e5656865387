"""Neighbours, projections, clusters, topic models and the embedding step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import (
    agglomerate, density, embed, forest, neighbours, reduce, spanning, spectral, terms, topicmodel, topics,
)
from ..session import durable, spread, work_dir
from ..sources.corpus import with_row_index
from .common import (
    VECTORS_SQL, classed, docs, grams_sql, hashed_sql, query, stop_words, table, texts, vectors,
)
from .q_topics import CENTRES_SQL

PAIRS_SQL = f"""
SELECT a.doc_id AS id, b.doc_id AS neighbour,
       round(1 - list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS distance
FROM ({VECTORS_SQL}) a JOIN ({VECTORS_SQL}) b ON a.doc_id <> b.doc_id"""

KNN_SQL = f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS rank FROM ({PAIRS_SQL}))
WHERE rank <= 15"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select("doc_id", "embedding")


def nearest(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    rows = points(spark, sf_dir)
    return neighbours.knn(spread(rows, "doc_id"), rows, 15, exclude_self=True, **how)


@query(
    "j13_nearest_neighbours",
    f"SELECT id, neighbour, rank, round(distance, 6) AS distance FROM ({KNN_SQL})",
)
def j13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, sf_dir).withColumn("distance", F.round("distance", 6))


@query(
    "j13_nearest_neighbours_by_cells",
    f"SELECT id, neighbour, rank, round(distance, 6) AS distance FROM ({KNN_SQL})",
)
def j13_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search by pivots and cells, as for a base beyond the broadcast budget."""
    found = nearest(spark, sf_dir, broadcast_bytes=0)
    return found.withColumn("distance", F.round("distance", 6))


@query(
    "j12_zero_shot",
    f"""SELECT doc_id, CASE WHEN s >= 0.3 THEN topic ELSE -1 END AS topic, round(s, 6) AS similarity FROM (
          SELECT v.doc_id, c.topic, round(list_cosine_similarity(v.embedding::DOUBLE[], c.centroid), 9) AS s,
                 row_number() OVER (PARTITION BY v.doc_id ORDER BY round(1 - list_cosine_similarity(v.embedding::DOUBLE[], c.centroid), 9), c.topic) AS r
          FROM ({VECTORS_SQL}) v, ({CENTRES_SQL}) c) WHERE r = 1""",
)
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir)
    labels = topics.centroids(rows).select(
        F.col("topic").alias("label_id"), F.col("centroid").alias("embedding")
    )
    found = topicmodel.zero_shot(rows.select("doc_id", "embedding"), labels)
    return found.withColumn("similarity", F.round("similarity", 6))


@query(
    "m07_assign",
    f"""SELECT doc_id, topic, round(s, 6) AS similarity FROM (
          SELECT v.doc_id, c.topic, list_cosine_similarity(v.embedding::DOUBLE[], c.centroid) AS s,
                 row_number() OVER (PARTITION BY v.doc_id ORDER BY round(1 - list_cosine_similarity(v.embedding::DOUBLE[], c.centroid), 9), c.topic) AS r
          FROM ({VECTORS_SQL}) v, ({CENTRES_SQL}) c) WHERE r = 1""",
)
def m07(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir)
    found = topicmodel.assign(rows.select("doc_id", "embedding"), topics.centroids(rows))
    return found.withColumn("similarity", F.round("similarity", 6))


PROBABILITY_SQL = f"""
SELECT doc_id, topic, e / sum(e) OVER (PARTITION BY doc_id) AS probability FROM (
  SELECT v.doc_id, c.topic, exp(list_cosine_similarity(v.embedding::DOUBLE[], c.centroid)) AS e
  FROM ({VECTORS_SQL}) v, ({CENTRES_SQL}) c)"""


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir)
    return topicmodel.topic_probabilities(rows.select("doc_id", "embedding"), topics.centroids(rows))


@query(
    "m08_probabilities",
    f"SELECT doc_id, topic, round(probability, 6) AS probability FROM ({PROBABILITY_SQL})",
)
def m08(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = probabilities(spark, sf_dir).select("doc_id", F.inline("probabilities"))
    return every.withColumn("probability", F.round("probability", 6))


@query(
    "m15_likely_topics",
    f"SELECT doc_id, topic, round(probability, 6) AS probability FROM ({PROBABILITY_SQL}) WHERE probability >= 0.1",
)
def m15(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = topicmodel.likely_topics(probabilities(spark, sf_dir), 0.1)
    return kept.withColumn("probability", F.round("probability", 6))


@query(
    "m12_reassign_noise",
    f"""WITH near AS (SELECT doc_id, topic AS best, s FROM (
          SELECT v.doc_id, c.topic, list_cosine_similarity(v.embedding::DOUBLE[], c.centroid) AS s,
                 row_number() OVER (PARTITION BY v.doc_id ORDER BY round(1 - list_cosine_similarity(v.embedding::DOUBLE[], c.centroid), 9), c.topic) AS r
          FROM ({VECTORS_SQL}) v, ({CENTRES_SQL}) c WHERE c.topic < 5) WHERE r = 1)
        SELECT doc_id, CASE WHEN topic < 5 THEN topic WHEN s >= 0.1 THEN best ELSE -1 END AS topic
        FROM ({VECTORS_SQL}) JOIN near USING (doc_id)""",
)
def m12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the topics are taken for noise and redistributed over the other half."""
    rows = vectors(spark, sf_dir)
    marked = rows.select(
        "doc_id", F.when(F.col("topic") < 5, F.col("topic")).otherwise(-1).alias("topic")
    )
    centres = topics.centroids(rows).filter("topic < 5")
    return topicmodel.reassign_noise(rows.select("doc_id", "embedding"), marked, centres, 0.1)


MATRIX_SQL = f"""
SELECT a.topic AS a, b.topic AS b, list_cosine_similarity(a.centroid, b.centroid) AS similarity
FROM ({CENTRES_SQL}) a, ({CENTRES_SQL}) b"""


@query("m14_topic_matrix", f"SELECT a, b, round(similarity, 6) AS similarity FROM ({MATRIX_SQL})")
def m14(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = topicmodel.topic_matrix(durable(topics.centroids(vectors(spark, sf_dir))))
    pairs = matrix.select(F.col("topic").alias("a"), F.inline("scores").alias("b", "similarity"))
    return pairs.withColumn("similarity", F.round("similarity", 6))


@query(
    "m17_merge_order",
    f"SELECT a, b, round(1 - similarity, 6) AS distance FROM ({MATRIX_SQL}) WHERE a < b ORDER BY 3, 1, 2",
)
def m17(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = topicmodel.topic_matrix(durable(topics.centroids(vectors(spark, sf_dir))))
    return topicmodel.merge_order(matrix).withColumn("distance", F.round("distance", 6))


# --- projections and graphs: checked by properties -----------------------------------


@query("m01_project_3d")
def m01(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = reduce.with_coordinates(vectors(spark, sf_dir), 3)
    return placed.select("doc_id", "proj_x", "proj_y", "proj_z")


@query("m02_project_10d")
def m02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topicmodel.reduce_with_pca(10)(points(spark, sf_dir)).select(
        "doc_id", F.posexplode("embedding").alias("axis", "value")
    )


@query("m02_document_map")
def m02_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce.with_coordinates(points(spark, sf_dir), 2).select("doc_id", "proj_x", "proj_y")


@query(
    "m17_merge_tree",
    f"""WITH RECURSIVE m AS (SELECT a, b, sqrt(greatest(2 - 2 * similarity, 0)) AS d FROM ({MATRIX_SQL}) WHERE a <> b),
        -- single linkage merges at the weights of the spanning tree: grow it from the first topic
        t AS (SELECT 0 AS step, a AS topic, false AS inside, NULL::DOUBLE AS came, d AS w FROM m WHERE b = (SELECT min(b) FROM m)
              UNION ALL
              SELECT n.step + 1, n.topic, n.inside OR n.topic = n.next, CASE WHEN n.topic = n.next THEN n.w ELSE n.came END,
                     least(n.w, m.d)
              FROM (SELECT *, first_value(topic) OVER (ORDER BY inside, w, topic) AS next, bool_and(inside) OVER () AS done FROM t) n
              LEFT JOIN m ON m.a = n.topic AND m.b = n.next WHERE NOT n.done)
        SELECT row_number() OVER (ORDER BY came) - 1 AS step, round(came, 6) AS distance
        FROM t WHERE step = (SELECT max(step) FROM t)""",
)
def m17_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At which distances topics merge by single linkage; other linkages are tested on small data."""
    matrix = topicmodel.topic_matrix(durable(topics.centroids(vectors(spark, sf_dir))))
    apart = topicmodel.merge_order(matrix).withColumn(
        "distance", F.sqrt(F.greatest(2 * F.col("distance"), F.lit(0.0)))
    )
    tree = agglomerate.merge_tree(apart, "single")
    return tree.select("step", F.round("distance", 6).alias("distance"))


# --- approximate neighbours and what keeps neighbourhoods ------------------------------


@query("j13_neighbours_by_forest")
def j13_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.approximate_knn(points(spark, sf_dir), 15)


@query(
    "j13_forest_recall",
    """SELECT count(*) AS searched, count(*) * least(15, count(*) - 1) AS found, true AS nine_of_ten,
              true AS distances_hold FROM embeddings""",
)
def j13_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approximate search measured against the exact one over the whole table."""
    found, exact = durable(forest.approximate_knn(points(spark, sf_dir), 15)), durable(nearest(spark, sf_dir))
    both = found.join(exact.withColumnRenamed("distance", "true"), ["id", "neighbour"])
    share = forest.recall(found, exact).first()["recall"]
    worst = both.agg(F.max(F.abs(F.col("distance") - F.col("true")))).first()[0]
    return found.agg(
        F.count_distinct("id").alias("searched"), F.count("*").alias("found"),
        F.lit(share >= 0.9).alias("nine_of_ten"), F.lit(worst < 2e-9).alias("distances_hold"),
    )


@query("m01_graph_coordinates")
def m01_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = spectral.with_graph_coordinates(points(spark, sf_dir), 3)
    return placed.select("doc_id", "proj_x", "proj_y", "proj_z")


@query(
    "m02_graph_axes",
    """SELECT axis, count(*) AS placed, true AS residual_small, true AS eigenvalue_fits, true AS centred
       FROM embeddings, (SELECT unnest(range(10)) AS axis) GROUP BY axis""",
)
def m02_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten axes of the neighbour graph, each with what must hold for an eigenvector."""
    rows, found = spectral.graph_coordinates(points(spark, sf_dir), 10)
    facts = spark.createDataFrame(
        [(i, r < spectral.TOLERANCE, -1 <= v < 1 + 1e-9) for i, (v, r) in enumerate(zip(found.eigenvalues, found.residuals))],
        "axis long, residual_small boolean, eigenvalue_fits boolean",
    )
    each = rows.select(F.posexplode("axes").alias("axis", "x")).groupBy(F.col("axis").cast("long").alias("axis")).agg(
        F.count("*").alias("placed"),
        # orthogonal to the trivial vector, so both signs occur
        (F.min("x") * F.max("x") < 0).alias("centred"),
    )
    return each.join(facts, "axis")


@query("m03_neighbour_graph")
def m03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbour_graph(nearest(spark, sf_dir), 15)


# --- clusters: vectors pulled towards their label, so that there is something to find --


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector with 1 at its label's axis added to 0.3 times itself."""
    moved = F.transform(
        "embedding",
        lambda x, i: x.cast("double") * 0.3 + F.when(i == F.col("topic"), 1.0).otherwise(0.0),
    )
    return vectors(spark, sf_dir).select("doc_id", moved.alias("embedding"))


PLANTED_SQL = """
SELECT vec_id AS doc_id, t.topic FROM embeddings JOIN (
  SELECT label, row_number() OVER (ORDER BY count(*) DESC, min(vec_id)) - 1 AS topic
  FROM embeddings GROUP BY label) t USING (label)"""


@query("m04_density_clusters", PLANTED_SQL)
def m04(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planted groups come back whole; every radius between 0.4 and 1.2 separates them."""
    return density.density_clusters(
        planted(spark, sf_dir), min_cluster_size=20, min_samples=5, radius=0.75
    )


UNEQUAL_SQL = """
SELECT vec_id AS doc_id, [CAST(x AS DOUBLE) * (0.05 + 0.03 * label) + CASE WHEN i - 1 = label THEN 1.0 ELSE 0.0 END
                          FOR x, i IN embedding] AS v FROM embeddings"""


def unequal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups on the axes of their labels, from tight to wide: no radius suits all of them."""
    moved = F.transform(
        "embedding",
        lambda x, i: x.cast("double") * (0.05 + 0.03 * F.col("topic"))
        + F.when(i == F.col("topic"), 1.0).otherwise(0.0),
    )
    return vectors(spark, sf_dir).select("doc_id", moved.alias("embedding"))


@query(
    "m04_excess_of_mass",
    """SELECT vec_id AS doc_id, coalesce(t.topic, -1) AS topic FROM embeddings LEFT JOIN (
         SELECT label, row_number() OVER (ORDER BY count(*) DESC, min(vec_id)) - 1 AS topic
         FROM embeddings GROUP BY label HAVING count(*) >= 10) t USING (label)""",
)
def m04_eom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.density_clusters(unequal(spark, sf_dir), min_cluster_size=10, min_samples=3)


@query(
    "m04_spanning_tree",
    f"""WITH RECURSIVE p AS ({UNEQUAL_SQL}),
        d AS (SELECT a.doc_id AS a, b.doc_id AS b, round(list_distance(a.v, b.v), 9) AS d
              FROM p a JOIN p b ON a.doc_id <> b.doc_id),
        c AS (SELECT a, max(d) AS core FROM (
                SELECT a, d, row_number() OVER (PARTITION BY a ORDER BY d) AS r FROM d) WHERE r <= 5 GROUP BY a),
        m AS (SELECT d.a, d.b, greatest(d.d, x.core, y.core) AS w FROM d JOIN c x ON d.a = x.a JOIN c y ON d.b = y.a),
        -- grow the tree from the first point: by step, every point's least weight to the tree
        t AS (SELECT 0 AS step, doc_id, doc_id = (SELECT min(doc_id) FROM p) AS inside, NULL::DOUBLE AS came,
                     CASE WHEN doc_id = (SELECT min(doc_id) FROM p) THEN NULL ELSE m.w END AS w
              FROM p LEFT JOIN m ON m.a = doc_id AND m.b = (SELECT min(doc_id) FROM p)
              UNION ALL
              SELECT n.step + 1, n.doc_id, n.inside OR n.doc_id = n.next,
                     CASE WHEN n.doc_id = n.next THEN n.w ELSE n.came END, least(n.w, m.w)
              FROM (SELECT *, first_value(doc_id) OVER (ORDER BY inside, w, doc_id) AS next,
                           bool_and(inside) OVER () AS full FROM t) n
              LEFT JOIN m ON m.a = n.doc_id AND m.b = n.next WHERE NOT n.full)
        SELECT row_number() OVER (ORDER BY came) AS place, round(came, 6) AS weight FROM t
        WHERE step = (SELECT max(step) FROM t) AND came IS NOT NULL""",
)
def m04_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights of the spanning tree in order; a tree's edges may differ, its weights not."""
    tree = durable(spanning.spanning_tree(unequal(spark, sf_dir), 5).withColumn("edge", F.concat_ws(" ", "a", "b")))
    placed = with_row_index(tree, ["weight", "edge"], "edge", "place")
    return placed.select((F.col("place") + 1).alias("place"), F.round("weight", 6).alias("weight"))


@query("m05_centre_clusters")
def m05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.centre_clusters(planted(spark, sf_dir), 10)


@query("m05_bisecting_clusters")
def m05_bisecting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.centre_clusters(planted(spark, sf_dir), 10, "bisecting")


def corpus_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with hashed-word vectors from the JVM."""
    rows = texts(spark, sf_dir)
    return rows.select("doc_id", "text").join(embed.hashed_tfidf(rows, 64), "doc_id")


def model(spark: SparkSession, sf_dir: str, **how) -> topicmodel.TopicModel:
    def cluster(reduced: DataFrame) -> DataFrame:
        return density.centre_clusters(reduced, 8)

    settings = {"cluster": cluster, "stop_words": stop_words(spark, sf_dir), **how}
    return topicmodel.TopicModel(**settings)


@query("m06_fit_topics")
def m06(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = durable(corpus_vectors(spark, sf_dir))
    return model(spark, sf_dir).fit(rows)["assignment"]


@query("m06_density_topics", PLANTED_SQL)
def m06_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model as it is run by default: ten axes, clusters by excess of mass, noise as topic -1."""
    rows = durable(planted(spark, sf_dir).join(docs(spark, sf_dir).select("doc_id", "text"), "doc_id", "left").fillna("", ["text"]))
    stages = topicmodel.TopicModel(
        reduce=topicmodel.reduce_with_pca(10),
        cluster=lambda reduced: density.density_clusters(reduced, min_cluster_size=10, min_samples=3),
        stop_words=stop_words(spark, sf_dir),
    )
    return stages.fit(rows)["assignment"].select("doc_id", "topic")


@query("k11_model_round_trip")
def k11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load, and assign with the loaded centroids."""
    rows = durable(corpus_vectors(spark, sf_dir))
    path = work_dir(spark, "model")
    topicmodel.save_model(model(spark, sf_dir).fit(rows), path)
    loaded = topicmodel.load_model(spark, path)
    names = topics.topic_names(loaded["topic_terms"])
    return topicmodel.assign(rows, loaded["centroids"]).join(names, "topic", "left")


@query(
    "k11_load_or_fit",
    """SELECT vec_id AS doc_id, 1 AS fits, true AS same FROM embeddings""",
)
def k11_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asked for twice, a model is fitted once; its assignments are the same before and after loading."""
    rows = durable(planted(spark, sf_dir).join(docs(spark, sf_dir).select("doc_id", "text"), "doc_id", "left").fillna("", ["text"]))
    path, fits = work_dir(spark, "model"), []

    def fit() -> dict[str, DataFrame]:
        fits.append(model(spark, sf_dir).fit(rows))
        return fits[-1]

    topicmodel.load_or_fit(spark, path, fit)
    loaded = topicmodel.load_or_fit(spark, path, fit)
    fresh = topicmodel.assign(rows, fits[0]["centroids"]).select("doc_id", F.col("topic").alias("fresh"))
    again = topicmodel.assign(rows, loaded["centroids"]).join(fresh, "doc_id")
    return again.select("doc_id", F.lit(len(fits)).alias("fits"), (F.col("topic") == F.col("fresh")).alias("same"))


@query("u03_exchanged_stages")
def u03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same model with another reducer, clusterer and vectorizer scope."""
    rows = durable(corpus_vectors(spark, sf_dir))
    other = model(
        spark, sf_dir,
        reduce=topicmodel.reduce_with_pca(5),
        cluster=lambda reduced: density.centre_clusters(reduced, 6, "bisecting"),
        df_scope="topic", min_df=2,
    )
    return other.fit(rows)["topic_terms"]


@query("m09_zero_shot_then_cluster")
def m09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label texts first, clusters for the documents no label fits."""
    both = table(spark, sf_dir, "benchmark").select(
        (-1 - F.col("item_id")).alias("doc_id"), "text"
    ).unionByName(docs(spark, sf_dir).select("doc_id", "text"))
    placed = durable(embed.hashed_tfidf(spread(both, "doc_id"), 64))
    labels = placed.filter("doc_id < 0").select((-1 - F.col("doc_id")).alias("label_id"), "embedding")
    rows = placed.filter("doc_id >= 0")
    return model(spark, sf_dir).fit_zero_shot(rows, labels, 0.7)


@query("m16_rerank_keywords")
def m16(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = durable(classed(spark, sf_dir).select("doc_id", "text", "topic"))
    ranked = model(spark, sf_dir, top_words=30).terms(rows, rows)["topic_terms"]
    words, centres = topicmodel.word_space(rows, rows.select("doc_id", "topic"))
    return topicmodel.rerank_by_similarity(ranked, words, centres, 10)


DISTRIBUTION_SQL = f"""
WITH {grams_sql(1)},
vocab AS (SELECT term, count(*) AS f FROM grams GROUP BY term HAVING count(DISTINCT doc_id) >= 6),
tfs AS (SELECT lang AS topic, term, count(*) AS tf FROM grams SEMI JOIN vocab USING (term) GROUP BY ALL),
totals AS (SELECT topic, sum(tf) AS total FROM tfs GROUP BY topic),
weights AS (SELECT topic, term, ln(1 + (SELECT avg(total) FROM totals) / f) AS idf,
                   sqrt(tf / total) * ln(1 + (SELECT avg(total) FROM totals) / f) AS score
            FROM tfs JOIN totals USING (topic) JOIN vocab USING (term)),
lens AS (SELECT topic, sqrt(sum(score * score)) AS len FROM weights GROUP BY topic),
toks AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM documents),
places AS (SELECT doc_id, len(t) AS n, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS pos FROM toks),
wins AS (SELECT doc_id, n, term, unnest(range(greatest(pos - 3, 0), least(pos, greatest(n - 4, 0)) + 1)) AS start FROM places),
norms AS (SELECT doc_id, start, any_value(n) AS n, sqrt(sum(i.idf * i.idf)) AS norm FROM wins
          JOIN (SELECT term, any_value(idf) AS idf FROM weights GROUP BY term) i USING (term) GROUP BY ALL),
dots AS (SELECT doc_id, start, topic, sum(score * idf / len) AS d FROM wins JOIN weights USING (term)
         JOIN lens USING (topic) GROUP BY ALL),
close AS (SELECT doc_id, start, topic, n, d / norm AS s FROM dots JOIN norms USING (doc_id, start) WHERE round(d / norm, 9) >= 0.1),
tok AS (SELECT doc_id, topic, s, unnest(range(start, least(start + 4, n))) AS pos FROM close)"""


def distribution(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Token windows of all documents against the word weights of the four languages."""
    rows = classed(spark, sf_dir).withColumn("topic", F.col("lang"))
    counts = durable(
        terms.group_counts(terms.term_arrays(rows, stop_words(spark, sf_dir), 1), "topic")
    )
    weights = durable(terms.class_weights(counts, durable(terms.vocabulary(counts))))
    return topicmodel.window_distribution(texts(spark, sf_dir), weights)


@query(
    "m13_document_distribution",
    f"""{DISTRIBUTION_SQL}
        SELECT doc_id, topic, round(score / sum(score) OVER (PARTITION BY doc_id), 6) AS probability
        FROM (SELECT doc_id, topic, sum(s) AS score FROM tok GROUP BY ALL)""",
)
def m13(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares, _ = distribution(spark, sf_dir)
    return shares.withColumn("probability", F.round("probability", 6))


@query(
    "m13_token_distribution",
    f"""{DISTRIBUTION_SQL}
        SELECT doc_id, topic, count(*) AS tokens, round(max(score), 6) AS highest
        FROM (SELECT doc_id, pos, topic, sum(s) AS score FROM tok GROUP BY ALL) GROUP BY ALL""",
)
def m13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, by_token = distribution(spark, sf_dir)
    return by_token.groupBy("doc_id", "topic").agg(
        F.count("*").alias("tokens"), F.round(F.max("score"), 6).alias("highest")
    )


# --- the embedding step --------------------------------------------------------------


@query(
    "m18_embed_documents",
    f"""WITH {hashed_sql('documents', 'doc_id', 64)}
        SELECT doc_id, n_chunks, CAST(dim AS BIGINT) AS dim, round(value, 6) AS value FROM pooled""",
)
def m18(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = embed.embed_docs(texts(spark, sf_dir), embed.make_embedder("hashed_words"))
    return (
        done.filter("status = 'ok'")
        .select("doc_id", "n_chunks", F.posexplode("embedding").alias("dim", "v"))
        .filter("v <> 0")
        .select("doc_id", "n_chunks", F.col("dim").cast("bigint").alias("dim"), F.round("v", 6).alias("value"))
    )


class LongWords(embed.HashedWords):
    """A second embedder for the same interface, with longer vectors and shorter chunks."""

    def __init__(self):
        super().__init__(dimensions=128, context_limit=256)

    def identifier(self) -> str:
        return "long_words"


@query(
    "u02_embedder_registry",
    """SELECT 'long_words' AS provider, 'ok' AS status, count(*) AS n FROM conversations""",
)
def u02(spark: SparkSession, sf_dir: str) -> DataFrame:
    embed.register_embedder("long_words", LongWords)
    rows = table(spark, sf_dir, "conversations").select(
        F.concat("conv_id", F.lit("-"), "turn").alias("doc_id"), "text"
    )
    done = embed.embed_docs(spread(rows, "doc_id"), embed.make_embedder("long_words"))
    return done.groupBy("provider", "status").agg(F.count("*").alias("n"))


@query(
    "u02_registry_vectors",
    f"""WITH {hashed_sql("(SELECT conv_id || '-' || turn AS doc_id, text FROM conversations)", 'doc_id', 128, 256)}
        SELECT doc_id, n_chunks, CAST(dim AS BIGINT) AS dim, round(value, 6) AS value FROM pooled""",
)
def u02_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second embedder makes: its own dimensions, from chunks of its own length."""
    embed.register_embedder("long_words", LongWords)
    rows = table(spark, sf_dir, "conversations").select(
        F.concat("conv_id", F.lit("-"), "turn").alias("doc_id"), "text"
    )
    done = embed.embed_docs(spread(rows, "doc_id"), embed.make_embedder("long_words"))
    return (
        done.filter("status = 'ok'")
        .select("doc_id", "n_chunks", F.posexplode("embedding").alias("dim", "v"))
        .filter("v <> 0")
        .select("doc_id", "n_chunks", F.col("dim").cast("bigint").alias("dim"), F.round("v", 6).alias("value"))
    )
