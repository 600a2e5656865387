import re

import math
from urllib.parse import quote

import pytest
from pyspark.sql import Row, functions as F

from lexivane.functions import rates, text, vector


def one(spark, column, **values):
    return spark.createDataFrame([Row(**values)]).select(column.alias("x")).first()["x"]


def test_tokens_are_unicode_words_of_two_or_more(spark):
    assert one(spark, text.tokens("t"), t="Él a qué_1, x yz") == ["él", "qué_1", "yz"]
    assert one(spark, text.token_count("t"), t="") == 0


def test_batched_last_group_may_be_short(spark):
    assert one(spark, text.batched("a", 2), a=[1, 2, 3]) == [[1, 2], [3]]
    assert one(spark, text.batched("a", 3), a=[1, 2, 3]) == [[1, 2, 3]]
    with pytest.raises(ValueError):
        text.batched("a", 0)


def test_token_chunks_reserve_special_tokens(spark):
    words = " ".join(f"w{i}" for i in range(10))
    chunks = one(spark, text.token_chunks("t", 6, 2), t=words)
    assert [len(c.split()) for c in chunks] == [4, 4, 2]
    assert one(spark, text.token_chunks("t", 6), t="") == []


def test_char_chunks_cover_the_whole_text(spark):
    long = "é" * 21
    assert "".join(one(spark, text.char_chunks("t", 2), t=long)) == long
    assert [len(c) for c in one(spark, text.char_chunks("t", 2), t=long)] == [8, 8, 5]
    assert one(spark, text.char_chunks("t", 2), t="12345678") == ["12345678"]
    # by tokens: short in tokens is left whole although long in characters
    assert len(one(spark, text.char_chunks("t", 2, "tokens"), t=long)) == 1
    assert len(one(spark, text.char_chunks("t", 2, "tokens"), t="aa bb cc dd")) == 2


def test_provider_ids(spark):
    rows = [
        ("openai", "m", "openai", None), ("cohere", "m", "cohere", "search"),
        ("google", "m", "google", None), ("google", "m", "google", "retrieval"),
    ]
    df = spark.createDataFrame(rows, "provider string, model string, api string, kind string")
    got = df.select(text.provider_id(*[F.col(c) for c in df.columns]).alias("x")).collect()
    assert [r.x for r in got] == ["openai_m", "cohere_m_search", "google_m_default", "google_m_retrieval"]
    assert one(spark, text.provider_display(F.col("i")), i="open-ai_text_3") == ("Open Ai", "text_3")
    assert one(spark, text.provider_display(F.col("i")), i="plain") == ("Plain", "unknown")


def test_percent_encode_like_quote(spark):
    raw = "https://x.y/ä ö?a=1&b=~c*d+e%f#g(h)'i!"
    assert one(spark, text.percent_encode("u"), u=raw) == quote(raw, safe="")


def test_ngrams_after_stop_words(spark):
    df = spark.createDataFrame([(1, ["the", "red", "fox", "ran"])], "doc_id int, t array<string>")
    stop = spark.createDataFrame([("the",)], "word string")
    kept = text.drop_stop_words(df, "t", stop, "doc_id")
    grams = text.add_ngrams(kept, "t", "g").first()["g"]
    assert grams == ["red", "fox", "ran", "red fox", "fox ran", "red fox ran"]


def test_long_stop_list_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(text, "MAX_STOP_WORDS", 1)
    rows = [(1, ["b", "a", "c", "a"]), (2, ["a", "x"])]
    df = spark.createDataFrame(rows, "doc_id int, t array<string>")
    stop = spark.createDataFrame([("a",), ("x",)], "word string")
    got = {r.doc_id: r.t for r in text.drop_stop_words(df, "t", stop, "doc_id").collect()}
    assert got == {1: ["b", "c"], 2: []}


def test_vector_problems(spark):
    bad = [
        (0, None, "missing"), (1, [], "empty"), (2, [1.0, None], "null element"),
        (3, [1.0, float("nan")], "not a number"), (4, [1.0], "dimension"), (5, [0.0, 0.0], "zero"),
        (6, [1.0, 0.0], None),
    ]
    df = spark.createDataFrame(bad, "i int, v array<double>, want string")
    for row in df.select("i", "want", vector.vector_problem("v", 2).alias("got")).collect():
        assert row.got == row.want


def test_pooling_weights_by_characters(spark):
    rows = [(1, [1.0, 0.0], 3), (1, [0.0, 1.0], 1), (2, [3.0, 4.0], 9), (3, [1.0, 0.0], 2), (3, [-1.0, 0.0], 2)]
    df = spark.createDataFrame(rows, "doc_id int, vector array<double>, weight int")
    got = {r.doc_id: r for r in vector.pool_chunks(df).collect()}
    n = math.hypot(0.75, 0.25)
    assert got[1].embedding == pytest.approx([0.75 / n, 0.25 / n])
    assert got[2].embedding == [3.0, 4.0]
    assert got[3].embedding is None and got[3].error == "zero norm"
    single = {r.doc_id: r for r in vector.pool_chunks(df, normalise_single=True).collect()}
    assert single[2].embedding == pytest.approx([0.6, 0.8])


def test_allowed_hours(spark):
    hours = spark.range(24).select(F.col("id").alias("h"))
    allowed = lambda a, b: [r.h for r in hours.filter(rates.allowed_hour(F.col("h"), a, b)).collect()]
    assert allowed(19, 7) == [*range(7), *range(19, 24)]
    assert allowed(7, 19) == [*range(7, 19)]
    assert allowed(None, None) == [*range(24)]


def test_retry_wait(spark):
    rows = [("12", 1), ("Tue, 02 Jan 2024 00:00:30 GMT", 1), (None, 3), ("soon", 9)]
    df = spark.createDataFrame(rows, "h string, n int").withColumn("ts", F.lit("2024-01-02").cast("timestamp"))
    got = [r.x for r in df.select(rates.retry_wait(F.col("h"), F.col("ts"), F.col("n")).alias("x")).collect()]
    assert got == [12.0, 30.0, 8.0, 60.0]


def test_rates_with_nothing_sent(spark):
    zero = F.lit(0)
    assert one(spark, rates.success_rate(zero, zero), a=1) == 0.0
    assert one(spark, rates.report_rate(zero, zero, zero), a=1) == 100.0
    assert one(spark, rates.success_rate(F.lit(2), F.lit(3)), a=1) == 66.67


def test_token_chunks_add_up_to_the_text(spark):
    t = "\u00bf... El rey D. Juan, y a sus hijos: \u00abOath\u00bb o no. a b c\n"
    for limit in (1, 2, 3, 100):
        chunks = one(spark, text.token_chunks("t", limit), t=t)
        assert "".join(chunks) == t
        assert all(len(re.findall(r"\w{2,}", c)) <= limit for c in chunks)
    assert one(spark, text.token_chunks("t", 4), t="a b c") == ["a b c"]
    assert one(spark, text.token_chunks("t", 4), t="") == []


def test_stop_words_do_not_depend_on_the_size_of_the_list(spark, monkeypatch):
    rows = [(1, ["a", "b", "a"], "x"), (1, None, "y"), (2, [], "x"), (2, ["b", None, "c"], "z"), (None, ["c"], "x")]
    df = spark.createDataFrame(rows, "k int, words array<string>, other string")
    stop = spark.createDataFrame([("a",), ("q",)], "word string")
    short = text.drop_stop_words(df, "words", stop, "k")
    monkeypatch.setattr(text, "MAX_STOP_WORDS", 1)
    long = text.drop_stop_words(df, "words", stop, "k")
    key = lambda r: str(tuple(r))
    clean = [tuple(r[:1]) + ([w for w in r[1] if w] if r[1] is not None else None,) + tuple(r[2:]) for r in short.collect()]
    assert sorted(clean, key=str) == sorted([tuple(r) for r in long.collect()], key=str)
    assert sorted(long.collect(), key=key)[0].asDict().keys() == {"k", "words", "other"}
