"""Frequent n-grams through a sketch against counts of everything."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lexivane.operators import termcounts, terms
from lexivane.plans import QUERIES


def corpus(spark, rng, n=160):
    words = [f"w{i}" for i in range(60)] + ["é", "x y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i % 5 if i % 11 else None, f"c{i % 3}", rng.choices(words, weights, k=rng.choice([0, 1, 2, 30]))) for i in range(n)]
    rows += [(1, "c1", None), (2, "c0", ["w1"] * 500), rows[3]]
    return rows, spark.createDataFrame(rows, "topic int, lang string, terms array<string>").repartition(3)


def plain(rows, high):
    tf, docs = Counter(), Counter()
    for topic, lang, words in rows:
        words = words or []
        grams = [" ".join(words[i : i + n]) for n in range(1, high + 1) for i in range(len(words) - n + 1)]
        tf.update((topic, lang, g) for g in grams)
        docs.update((topic, lang, g) for g in set(grams))
    return {k: (tf[k], docs[k]) for k in tf}


@pytest.mark.parametrize("min_df", [1, 6])
@pytest.mark.parametrize("bits", [4, 16])
@pytest.mark.parametrize("high", [1, 3])
def test_frequent_counts(spark, min_df, bits, high):
    rows, df = corpus(spark, random.Random(1))
    want = plain(rows, high)
    got = {(r.topic, r.lang, r.term): (r.tf, r.docs) for r in termcounts.frequent_counts(
        df, "topic", "lang", high=high, min_df=min_df, bits=bits).collect()}
    df_of = Counter()
    for (_, _, g), (_, d) in want.items():
        df_of[g] += d
    # whatever is frequent is there, and what is there is exact
    assert {k for k in want if df_of[k[2]] >= min_df} <= set(got)
    assert all(want[k] == v for k, v in got.items())
    if bits == 16 and min_df > 1 and high > 1:
        assert len(got) < len(want) / 2
    if min_df == 1:
        assert got == want


def test_same_vocabulary(spark):
    rows, df = corpus(spark, random.Random(2))
    every = terms.add_ngrams(df.na.fill(-1, ["topic"]), "terms", "terms", 1, 3)
    for scope in ("doc", "topic"):
        want = terms.vocabulary(terms.group_counts(every, "topic"), 4, 50, scope).collect()
        got = terms.vocabulary(termcounts.frequent_counts(df.na.fill(-1, ["topic"]), "topic", min_df=4), 4, 50, scope)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want} and want


def test_no_rows_and_no_groups(spark):
    rows, df = corpus(spark, random.Random(3))
    assert termcounts.frequent_counts(df.limit(0), "topic").count() == 0
    total = Counter(w for _, _, words in rows for w in words or [])
    got = {r.term: r.tf for r in termcounts.frequent_counts(df, high=1, min_df=1).collect()}
    assert got == dict(total)


def test_hashes_follow_the_text():
    a = termcounts.Grams(pa.array([["p", "q", "r"], None, [], ["p", "q"]]), 3)
    b = termcounts.Grams(pa.array([["z"], ["p", "q", "r"]]), 3)
    name = lambda g: {g.text(np.array([i]))[0].as_py(): int(g.hash[i]) for i in range(len(g.hash))}
    assert {"p", "p q", "q r", "p q r"} <= set(name(a)) and "r p" not in name(a)
    assert all(name(a)[k] == v for k, v in name(b).items() if k in name(a))
    assert a.row[a.start].tolist().count(3) == 3


@pytest.mark.parametrize("scope", ["doc", "topic"])
@pytest.mark.parametrize("most", [1, 7, 40, 300, 5000])
def test_ranked_vocabulary(spark, scope, most):
    rows, df = corpus(spark, random.Random(4), 60)
    df = df.na.fill(-1, ["topic"])
    rows = [(-1 if t is None else t, g, w) for t, g, w in rows]
    want = terms.vocabulary(
        terms.group_counts(terms.add_ngrams(df, "terms", "terms", 1, 3), "topic"), 3, most, scope
    ).collect()
    counts, vocab = termcounts.ranked_counts(
        df, "topic", "lang", most=most, min_df=3, bits=9,
        vocabulary=lambda c: terms.vocabulary(c, 3, most, scope),
    )
    assert {tuple(r) for r in vocab.collect()} == {tuple(r) for r in want} and want
    chosen = {r.term for r in want}
    got = {(r.topic, r.lang, r.term): (r.tf, r.docs) for r in counts.collect()}
    whole = plain(rows, 3)
    assert all(whole[k] == v for k, v in got.items())
    assert {k for k in whole if k[2] in chosen} <= set(got)


def test_bound_is_lowered_for_terms_that_are_not_let_in(spark):
    # ten words are frequent in one row each; those of the vocabulary are rarer
    rows = [(0, [f"often{i}"] * 50) for i in range(10)] + [(i % 2, ["a", "b", "c"][: 1 + i % 3]) for i in range(9)]
    df = spark.createDataFrame(rows, "topic int, terms array<string>")
    counts, vocab = terms.ranked_vocabulary(df, "topic", high=1, min_df=3, max_features=2)
    assert {(r.term, r.f, r.df) for r in vocab.collect()} == {("a", 9, 9), ("b", 6, 6)}


def test_rare_terms_stay_in_their_tasks(spark):
    # 400 words in 7 rows each, 20 in 30, 8 in 90: a vocabulary of 8 needs no counts of the 400
    times = {f"w{i}": 7 for i in range(400)} | {f"mid{i}": 30 for i in range(20)} | {f"top{i}": 90 for i in range(8)}
    rows = [(i % 3, [w for w, n in times.items() if n > i]) for i in range(90)]
    df = spark.createDataFrame(rows, "topic int, terms array<string>")
    counts, vocab = terms.ranked_vocabulary(df, "topic", high=1, min_df=6, max_features=8)
    assert {r.f for r in vocab.collect()} == {90} and vocab.count() == 8
    assert counts.select("term").distinct().count() < 100


@pytest.mark.parametrize("run", [1, 50, termcounts.RUN])
@pytest.mark.parametrize("high", [1, 3])
def test_every_count(spark, run, high):
    rows, df = corpus(spark, random.Random(3))
    rows += [(None, None, ["x", "y", "x y", "", "é"]), (None, None, ["x y"]), (2, "c0", [])]
    df = spark.createDataFrame(rows, df.schema).repartition(3)
    for groups in (["topic", "lang"], ["lang"], []):
        want = Counter()
        for (topic, lang, g), (n, _) in plain(rows, high).items():
            want[(*[{"topic": topic, "lang": lang}[c] for c in groups], g)] += n
        got = termcounts.every_count(df, *groups, slices=7, high=high, run=run)
        assert got.columns == [*groups, "term", "tf"]
        got = [tuple(r) for r in got.collect()]
        assert len(got) == len(want) and {r[:-1]: r[-1] for r in got} == want
    assert termcounts.every_count(df.filter("topic > 9"), "lang", slices=7).collect() == []


def test_every_ngram_searches_texts_once_and_has_no_row_for_each(spark, tmp_path):
    """f15: texts were searched for tokens several times, and every occurrence was a row."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[i % 7 :]), "en", "src1", 9) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    plan = QUERIES["f15_ngrams"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "Generate" not in plan
