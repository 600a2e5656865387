import json
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexivane.operators import coverage, delivery, embed, requestlog, terms, topics
from lexivane.sources import corpus, sinks, vectors, wordlists

ATTEMPTS = "provider string, doc_id int, attempt int, status string, http_status int, error string, ts timestamp"


def test_csv_with_quotes_commas_and_breaks(spark, tmp_path):
    rows = [("u1", "a, \"b\"\nc", ""), ("u2", "  padded ", "x")]
    df = spark.createDataFrame(rows, "url string, content string, passage string")
    sinks.write_csv(df, str(tmp_path / "c"))
    back = corpus.read_csv(spark, str(tmp_path / "c"), "url string, content string, passage string")
    got = {r.url: (r.content, r.passage or "") for r in back.collect()}
    assert got == {"u1": ('a, "b"\nc', ""), "u2": ("  padded ", "x")}


def test_missing_column_raises(spark):
    with pytest.raises(ValueError, match="content"):
        corpus.require_columns(spark.createDataFrame([("u",)], "url string"))


def test_docs_resolver(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        corpus.read_docs(spark, str(tmp_path))
    df = spark.createDataFrame([("u", "c", [1.0])], "url string, content string, embeddings_a array<double>")
    sinks.write_docs_csv(df, str(tmp_path / "all_docs.csv"))
    assert corpus.read_docs(spark, str(tmp_path), schema="url string, content string").count() == 1
    sinks.write_docs_parquet(df, str(tmp_path / "all_docs.parquet"))
    assert corpus.read_docs(spark, str(tmp_path)).columns == ["url", "content"]


def test_row_index_is_a_total_order(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(7)
    got = {r.k: r.row_idx for r in corpus.with_row_index(df, ["-k"], "k").collect()}
    assert got == {k: 999 - k for k in range(1000)}


def test_absent_manifest_is_empty(spark, tmp_path):
    assert vectors.read_manifest(spark, str(tmp_path / "none.json")).count() == 0


def test_seed_lines(spark, tmp_path):
    (tmp_path / "s.txt").write_text("bellum, belli \nactio\n")
    rows = wordlists.read_seed_words(spark, str(tmp_path / "s.txt"))
    assert sorted((r.pos, r.word) for r in rows.collect()) == [(0, "actio"), (0, "bellum"), (1, " belli")]
    assert {r.term for r in wordlists.seed_terms(rows).collect()} == {"bellum", "belli", "actio"}


def test_failure_classes(spark):
    docs = spark.createDataFrame([(i,) for i in range(5)], "doc_id int")
    failed = spark.createDataFrame(
        [("a", 0), ("b", 0), ("c", 0), ("a", 1), ("b", 2), ("c", 2)], "provider string, doc_id int"
    )
    got = {r.doc_id: r.failure_class for r in coverage.failure_classes(docs, failed, 3).collect()}
    assert got == {0: "critical", 1: "partial", 2: "partial", 3: "full", 4: "full"}
    alone = coverage.failure_classes(docs, failed.filter("provider = 'a'"), 1)
    assert {r.failure_class for r in alone.collect()} == {"critical", "full"}


def test_three_429s_are_a_failure(spark):
    rows = [("a", 1, i, "failed", 429, "HTTP 429", None) for i in range(3)]
    rows += [("a", 2, 0, "failed", 429, "HTTP 429", None), ("a", 2, 1, "ok", 200, None, None)]
    got = coverage.provider_statistics(spark.createDataFrame(rows, ATTEMPTS)).first()
    assert (got.total, got.success, got.failed, got.success_rate) == (2, 1, 1, 50.0)
    assert (got.rate_limit_hits, got.processing_time) == (4, 0.0)


def test_skip_truth_table(spark):
    names = spark.createDataFrame([(x,) for x in "abcd"], "provider string")
    manifest = spark.createDataFrame([("a", 2), ("b", 0), ("c", 5)], "provider string, num_embeddings bigint")
    store = spark.createDataFrame([("a", 1, [1.0]), ("b", 1, [1.0])], "provider string, doc_id int, embedding array<double>")
    got = {r.provider: r.decision for r in coverage.skip_decision(names, manifest, store).collect()}
    assert got == {"a": "skip", "b": "redo", "c": "redo", "d": "process"}


def test_metadata_keeps_nulls_and_drops_long_arrays(spark):
    df = spark.createDataFrame(
        [("u", "text", None, [1] * 51, [1, 2])],
        "url string, content string, `author-id` string, long array<int>, short array<int>",
    )
    got = json.loads(df.select(delivery.metadata_json(df).alias("m")).first().m)
    assert got == {"url": "u", "author-id": None, "short": [1, 2]}


def test_payload_skips_unknown_and_empty(spark):
    docs = spark.createDataFrame([("a/b", "x", 1500)], "url string, content string, year int")
    store = spark.createDataFrame(
        [("p", "a/b", [1.0, 2.0]), ("p", "zz", [1.0]), ("q", "a/b", [])],
        "provider string, doc_id string, embedding array<float>",
    )
    routes = spark.createDataFrame(
        [("p", "pr", "o", "i"), ("q", "pr", "o", "i")],
        "provider string, project_handle string, instance_owner string, instance_handle string",
    )
    lines = delivery.payload_json(delivery.payloads(docs, store, routes, "me")).collect()
    item = json.loads(lines[0].value)["embeddings"][0]
    assert len(lines) == 1 and item["text_id"] == "a%2Fb" and item["vector_dim"] == 2
    assert item["metadata"] == {"url": "a/b", "year": 1500} and item["vector"] == [1.0, 2.0]


def test_snapshot_diff(spark):
    schema = "project_handle string, number_of_embeddings int"
    before = spark.createDataFrame([("grown", 1), ("same", 2), ("gone", 3)], schema)
    after = spark.createDataFrame([("grown", 5), ("same", 2), ("new", 1)], schema)
    got = {r.project_handle: (r.change, r.delta) for r in delivery.snapshot_diff(before, after, "project_handle").collect()}
    assert got == {"grown": ("changed", 4), "same": ("same", 0), "gone": ("removed", None), "new": ("new", None)}


def request_log(spark, codes, provider="p"):
    rows = [(i, provider, c, 1700000000 + i) for i, c in enumerate(codes)]
    df = spark.createDataFrame(rows, "event_id int, provider string, http_status int, s bigint")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s")


def expected_runs(codes):
    run = 0
    for c in codes:
        if c == 429:
            run += 1
        elif c < 400:
            run = 0
        yield run


@pytest.mark.parametrize("rows", [3, 100])
def test_runs_over_slices(spark, rows):
    codes = ([429] * 12 + [500, 200, 200] + [429, 200] * 5 + [200] * 3 + [429, 500, 429, 200]) * 2
    got = requestlog.throttle_runs(request_log(spark, codes), rows=rows).collect()
    got = {r.event_id: r.consecutive_429 for r in got}
    assert [got[i] for i in range(len(codes))] == list(expected_runs(codes))


def test_trailing_window_is_open_at_its_start(spark):
    counted = requestlog.trailing_counts(request_log(spark, [200] * 130), {"minute": 60})
    got = {r.event_id: r.minute for r in counted.collect()}
    assert got == {i: min(i + 1, 60) for i in range(130)}


def test_joins_of_every_row_are_not_broadcast(spark):
    log = request_log(spark, [200] * 10)
    plan = requestlog.trailing_counts(log, {"minute": 60})._jdf.queryExecution().toString()
    assert "SortMergeJoin [event_id" in plan and "SortMergeJoin [cast(__id" in plan
    plan = corpus.with_row_index(log, ["event_id"], "event_id")._jdf.queryExecution().toString()
    assert "SortMergeJoin [event_id" in plan


def test_gap_over_slices(spark):
    log = request_log(spark, [200] * 10)
    got = {r.event_id: r.gap_s for r in requestlog.previous_gap(log, rows=3).collect()}
    assert got == {0: None, **{i: 1.0 for i in range(1, 10)}}


def test_class_weights_by_hand(spark):
    rows = [(0, 0, ["war", "war", "law"]), (1, 1, ["law", "oath"]), (2, 1, ["law"])]
    arrays = spark.createDataFrame(rows, "doc_id int, topic int, terms array<string>")
    counts = terms.group_counts(arrays, "topic")
    vocab = terms.vocabulary(counts, min_df=1)
    assert {(r.term, r.f, r.df) for r in vocab.collect()} == {("law", 3, 3), ("war", 2, 1), ("oath", 1, 1)}
    assert {r.term for r in terms.vocabulary(counts, min_df=2, df_scope="topic").collect()} == {"law"}
    seeds = spark.createDataFrame([("oath",)], "term string")
    got = {(r.topic, r.term): r.score for r in terms.class_weights(counts, vocab, seeds).collect()}
    assert got[0, "war"] == pytest.approx(math.sqrt(2 / 3) * math.log(1 + 3 / 2))
    assert got[1, "law"] == pytest.approx(math.sqrt(2 / 3) * math.log(1 + 3 / 3))
    assert got[1, "oath"] == pytest.approx(10 * math.sqrt(1 / 3) * math.log(1 + 3 / 1))


def test_tuning_averages_with_previous_and_global(spark):
    schema = "topic int, period int, term string, score double"
    local = spark.createDataFrame([(0, 1, "a", 2.0), (0, 2, "b", 4.0), (0, 4, "a", 1.0), (1, 3, "c", 1.0)], schema)
    whole = spark.createDataFrame([(0, "a", 3.0), (0, "b", 1.0), (1, "c", 1.0)], "topic int, term string, score double")
    present = local.select("topic", "period").distinct()
    rows = topics.tuned_weights(local, whole, present, "period", 5).collect()
    got = {(r.topic, r.period, r.term): r.score for r in rows}
    assert got[0, 1, "a"] == pytest.approx((1 + 0.75) / 2)
    assert got[0, 2, "b"] == pytest.approx((0.5 + 0.25) / 2)  # b now, a before
    assert got[0, 2, "a"] == pytest.approx((0.5 + 0.75) / 2)
    assert got[0, 4, "a"] == pytest.approx((1 + 0.75) / 2)  # topic absent in the period before


class Picky(embed.HashedWords):
    def embed(self, texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("no")
        return super().embed(texts)


def test_embedding_step_records_failures(spark):
    docs = spark.createDataFrame([(1, "one two two"), (2, ""), (3, "x"), (4, None)], "doc_id int, text string")
    got = {r.doc_id: r for r in embed.embed_docs(docs, embed.HashedWords(16)).collect()}
    assert got[1].status == "ok" and sum(x * x for x in got[1].embedding) == pytest.approx(1)
    assert all(got[i].status == "failed" and got[i].error in ("empty", "no vector") for i in (2, 3, 4))
    bad = embed.embed_docs(spark.createDataFrame([(5, "a bad one")], "doc_id int, text string"), Picky())
    assert bad.first().error == "RuntimeError: no"
    with pytest.raises(ValueError):
        embed.make_embedder("unknown")


def test_work_list_counts_empty_as_missing(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id int")
    store = spark.createDataFrame([(1, [1.0]), (2, [])], "doc_id int, embedding array<double>")
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(coverage.work_list(docs, store)) == [2, 3]
    assert ids(coverage.work_list(docs, store, empty_is_done=True)) == [3]
    assert not coverage.is_complete(docs, store)


def test_vocabulary_cuts_ties_by_term(spark):
    from lexivane.operators import terms

    rows = [("t", w, n, 9) for w, n in (("e", 9), ("d", 5), ("c", 5), ("b", 5), ("a", 5), ("z", 1))]
    counts = spark.createDataFrame(rows, "topic string, term string, tf long, docs long")
    for most, want in ((3, {"e", "a", "b"}), (1, {"e"}), (5, set("eabcd")), (6, set("eabcdz")), (100, set("eabcdz"))):
        assert {r.term for r in terms.vocabulary(counts, max_features=most).collect()} == want
