import numpy as np
import pytest
from pyspark.sql import functions as F

from lexivane.operators import density, neighbours, reduce, topicmodel
from lexivane.operators.topics import centroids


def frame(spark, rows):
    data = [(int(i), [float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame(data, "doc_id bigint, embedding array<double>").repartition(5)


def brute(rows, k, metric):
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows], float)
    if metric == "cosine":
        m = m / np.linalg.norm(m, axis=1, keepdims=True)
        d = 1 - m @ m.T
    else:
        d = np.linalg.norm(m[:, None] - m[None], axis=2)
    d = np.round(d, 6)
    out = set()
    for a in range(len(ids)):
        order = sorted((d[a, b], ids[b]) for b in range(len(ids)) if b != a)[:k]
        out |= {(int(ids[a]), int(j)) for _, j in order}
    return out


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("budget", [32 << 20, 0])
def test_knn_is_exact_with_a_third_of_copies(spark, metric, budget):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=6) + 3 * (i % 4 == 0)) for i in range(160)]
    copy = rng.normal(size=6)
    rows += [(1000 + i, copy) for i in range(80)]
    df = frame(spark, rows)
    found = neighbours.knn(df, df, 4, metric, exclude_self=True, broadcast_bytes=budget, chunk_rows=16)
    assert {(r.id, r.neighbour) for r in found.collect()} == brute(rows, 4, metric)


def test_knn_by_cells_writes_no_row_per_visit(spark, monkeypatch):
    """Without structure every query needs every cell; still only vectors and the best travel."""
    monkeypatch.setattr(neighbours, "visits", None)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=12)) for i in range(700)]
    df = frame(spark, rows)
    found = neighbours.knn(df, df, 6, exclude_self=True, broadcast_bytes=0, chunk_rows=16)
    assert {(r.id, r.neighbour) for r in found.collect()} == brute(rows, 6, "cosine")


def test_knn_with_fewer_rows_than_k(spark):
    df = frame(spark, [(1, [1, 0]), (2, [0, 1]), (3, [0, 0])])
    for budget in (32 << 20, 0):
        found = neighbours.knn(df, df, 5, exclude_self=True, broadcast_bytes=budget).collect()
        assert {(r.id, r.neighbour) for r in found} == {(1, 2), (2, 1)}


def planted():
    rng = np.random.default_rng(3)
    rows, at = [], 0
    for group, size in enumerate((25, 25, 25, 19, 20)):
        for _ in range(size):
            v = rng.normal(scale=0.05, size=8)
            v[group] += 5
            rows.append((at, v))
            at += 1
    return rows + [(at + i, 20.0 * rng.normal(size=8)) for i in range(5)]


@pytest.mark.parametrize("chunk", [8, 1024])
def test_density_clusters_find_planted_groups(spark, chunk):
    got = density.density_clusters(
        frame(spark, planted()), 20, min_samples=5, radius=1.0, chunk_rows=chunk
    )
    topic = {r.doc_id: r.topic for r in got.collect()}
    assert [topic[i] for i in (0, 25, 50, 75, 94, 114)] == [0, 1, 2, -1, 3, -1]
    assert sum(t == -1 for t in topic.values()) == 24
    for start, size in ((0, 25), (25, 25), (50, 25), (94, 20)):
        assert len({topic[i] for i in range(start, start + size)}) == 1


def test_density_counts_copies(spark):
    rows = [(i, [1.0, 2.0]) for i in range(30)] + [(100 + i, [9.0 + 50 * i, 0.0]) for i in range(5)]
    got = density.density_clusters(frame(spark, rows), 20, min_samples=5, radius=0.5)
    assert {r.topic for r in got.filter("doc_id < 100").collect()} == {0}
    assert {r.topic for r in got.filter("doc_id >= 100").collect()} == {-1}


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    more = spark.createDataFrame([(100, 101)], "src bigint, dst bigint")
    got = {r.node: r.component for r in density.connected_components(edges.unionByName(more)).collect()}
    assert {got[i] for i in range(61)} == {0} and got[101] == 100


def test_topic_order(spark):
    rows = [(5, "x"), (1, "y"), (2, "z"), (3, "z"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, cluster string")
    got = {r.doc_id: r.topic for r in density.order_topics(df).collect()}
    assert got == {2: 0, 3: 0, 1: 1, 5: 2, 4: -1}


def test_graph_weights_are_in_range(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, [(i, rng.normal(size=4)) for i in range(40)])
    edges = neighbours.knn(df, df, 5, exclude_self=True)
    graph = neighbours.neighbour_graph(edges, 5).collect()
    assert all(0 < r.weight <= 1 + 1e-9 and r.src < r.dst for r in graph)
    best = {}
    for r in graph:
        for i in (r.src, r.dst):
            best[i] = max(best.get(i, 0), r.weight)
    assert all(w == pytest.approx(1) for w in best.values())


def test_probabilities_add_up_in_blocks_too(spark, monkeypatch):
    rng = np.random.default_rng(5)
    df = frame(spark, [(i, rng.normal(size=4)) for i in range(30)])
    centres = centroids(df.withColumn("topic", F.col("doc_id") % 6)).cache()
    whole = topicmodel.topic_probabilities(df, centres)
    monkeypatch.setattr(topicmodel, "BLOCK_ROWS", 2)
    blocks = topicmodel.topic_probabilities(df, centres, broadcast_bytes=0)
    flat = lambda p: {
        (r.doc_id, r.topic): round(r.probability, 9)
        for r in p.select("doc_id", F.inline("probabilities")).collect()
    }
    assert flat(whole) == flat(blocks) and len(flat(whole)) == 180
    total = whole.select(F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p["probability"]).alias("s"))
    assert all(r.s == pytest.approx(1) for r in total.collect())


def test_zero_shot_threshold(spark):
    docs = frame(spark, [(1, [1, 0.1]), (2, [-1, -1])])
    labels = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "label_id bigint, embedding array<double>")
    got = {r.doc_id: r.topic for r in topicmodel.zero_shot(docs, labels).collect()}
    assert got == {1: 0, 2: -1}


def test_projection_keeps_the_main_axis(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [10 * t, t, 0.01 * rng.normal()]) for i, t in enumerate(rng.normal(size=50))]
    got = reduce.with_coordinates(frame(spark, rows), 2).collect()
    x = [r.proj_x for r in got]
    t = [r.embedding[0] for r in got]
    assert abs(np.corrcoef(x, t)[0, 1]) > 0.999


def test_window_distribution_rows_add_to_one(spark):
    docs = spark.createDataFrame([(1, "war war law oath war"), (2, "law"), (3, "nothing known here")], "doc_id bigint, text string")
    weights = spark.createDataFrame(
        [(0, "war", 1.0, 1.0), (1, "law", 1.0, 1.0), (1, "oath", 0.5, 1.0)],
        "topic bigint, term string, score double, idf double",
    )
    shares, by_token = topicmodel.window_distribution(docs, weights)
    rows = shares.groupBy("doc_id").agg(F.sum("probability").alias("s")).collect()
    assert {r.doc_id for r in rows} == {1, 2} and all(r.s == pytest.approx(1) for r in rows)
    assert by_token.filter("doc_id = 2").count() == 1


def test_window_distribution_joins_no_tokens(spark):
    rng = np.random.default_rng(7)
    words = [f"word{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 40)))) for i in range(60)]
    docs += [(7, "word1 word2 word3 word4 word5"), (8, "word9"), (None, "word1 word2"), (70, None), (71, "")]
    weights = [(t, w, float(rng.random()) + 0.01, float(i + 1)) for t in range(20) for i, w in enumerate(words[:25]) if rng.random() < 0.4]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    weights = spark.createDataFrame(weights, "topic bigint, term string, score double, idf double")
    rows = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(sorted(df.columns)).collect())
    sent = topicmodel.window_distribution(docs, weights)
    joined = topicmodel.window_distribution(docs, weights, broadcast_bytes=0)
    assert [rows(x) for x in sent] == [rows(x) for x in joined] and rows(sent[0])
    single = docs.filter("doc_id NOT IN (7, 8)")
    for frame in topicmodel.window_distribution(single, weights):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Generate" not in plan


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_bad_vectors_change_nothing(spark, metric):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    nan, inf = float("nan"), float("inf")
    bad = [(1000 + i, [nan] + v[1:]) for i, v in good[:60]]
    bad += [(2000, None), (2001, []), (2002, [1.0, 2.0]), (2003, [inf] * 6), (2004, [None] + good[0][1][1:])]
    schema = "doc_id long, embedding array<double>"
    base = spark.createDataFrame(good + bad, schema)
    want = neighbours.knn(spark.createDataFrame(good, schema), spark.createDataFrame(good, schema), 4, metric)
    rows = lambda df: sorted((r.id, r.rank, r.neighbour) for r in df.collect())
    sent = neighbours.knn(base, base, 4, metric)
    cells = neighbours.knn(base, base, 4, metric, broadcast_bytes=0, chunk_rows=32)
    assert rows(sent) == rows(cells) == rows(want)
    reasons = {r.doc_id: r.reason for r in neighbours.rejected(base, metric=metric).collect()}
    assert set(reasons) == {i for i, _ in bad}
    assert (reasons[1000], reasons[2002], reasons[2003], reasons[2004]) == ("not a number", "dimension", "infinite", "null element")
