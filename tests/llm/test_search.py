"""Spelling variants, the filter audit and exact top-k against plain versions of themselves."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexivane.llm import ORACLE, QUERIES, audit, topk, variants
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_variants", "op12_filter_audit", "op13_topk"])
def test_against_sql(spark, name):
    assert compare(spark, connect(SF), SF, QUERIES[name], ORACLE[name]) is None


# --- spelling variants -----------------------------------------------------------------


def one_apart(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def plain_vocabulary(rows, least=7):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(variants.UPPER, variants.LOWER))
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                seen[run] += 1
    return seen


def plain_variants(rows):
    n = {w: c for w, c in plain_vocabulary(rows).items() if c >= 2}
    # two words one apart share a text with one place left out
    by_rest = defaultdict(set)
    for w in n:
        by_rest[w].add(w)
        for i in range(len(w)):
            by_rest[w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in by_rest.values():
        for a in group:
            near[a].update(b for b in group if one_apart(a, b))
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return out


def found_variants(docs, **how):
    got = [tuple(r) for r in variants.spelling_variants(docs, **how).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_variants_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found_variants(docs) == plain_variants(rows)


def variant_rows():
    rng = random.Random(5)
    letters = "abcdeé"
    words = ["".join(rng.choices("ab", k=rng.randint(7, 9))) for _ in range(60)]
    words += ["aaaaaaa", "aaaaaaaa", "aaaaaaab", "baaaaaaa", "éaaaaaa", "ÀÉÎéàüö", "prefixes" + "x" * 300]
    for w in list(words):
        for _ in range(4):
            i = rng.randrange(len(w))
            words.append(w[:i] + rng.choice(["", rng.choice(letters), w[i] + rng.choice(letters)]) + w[i + 1 :])
    rows = []
    for k in range(400):
        rows.append((k, " ".join(rng.choices(words, k=60)) + " Chained chained,CHAINED"))
    rows += [(1000 + k, "chainedd chainedd " * 30) for k in range(40)]
    rows += [(2000, None), (2001, ""), (None, "nullish nullish nullishh nullishh"), (3, rows[3][1])]
    return rows


@pytest.mark.parametrize("shard_words", [20, 100_000])
def test_variants_of_few_letters(spark, shard_words):
    """Halves that hundreds of words share, in one shard and cut into blocks."""
    rows = variant_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn(
        "n", F.lit(0))
    want = plain_variants(rows)
    assert {r[5] for r in want} < {r[0] for r in want} and any(r[2] > 5 for r in want)
    assert found_variants(docs, shard_words=shard_words) == want


def test_variants_of_nothing(spark):
    for rows in ([], [(1, None), (2, ""), (None, "short words")]):
        assert found_variants(spark.createDataFrame(rows, "doc_id long, text string")) == set()


def test_index_finds_all_one_apart():
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(2, 12))) for _ in range(700)})
    asked = words[::3] + ["".join(rng.choices("abcd", k=rng.randint(2, 12))) for _ in range(200)]
    index = variants.Index(*variants.points(pa.array(words)))
    codes, lens = variants.points(pa.array(asked))
    exact = lens - lens // 2
    q, w = index.near(codes, lens, exact)
    got = {(int(a), words[b]) for a, b in zip(q, w)}
    want = {(i, x) for i, a in enumerate(asked) for x in words if one_apart(a, x) and x.endswith(a[len(a) // 2 :])}
    assert got == want


# --- filter audit ----------------------------------------------------------------------


def plain_audit(rows, labels):
    first = {}
    for key, text, _ in rows:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))
    bits = []
    for key, text, part in rows:
        t = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        fails = set()
        fails |= {"A"} if len(words) < 50 else set()
        fails |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        fails |= {"E"} if key is not None and key > first[t] else set()
        marks = [(q, x) for k, q, x in labels if k == key and key is not None]
        bits.append((part or "", fails, any(q == 1 for q, _ in marks), any(x == 1 for _, x in marks)))
    out = {}
    for part in {b[0] for b in bits}:
        mine = [b for b in bits if b[0] == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                hit = [b for b in left if f in b[1]]
                failing = [b for b in mine if f in b[1]]
                left = [b for b in left if f not in b[1]]
                shapley[f] += len(hit)
                out[part, order, step] = (
                    len(left), len(hit), len(failing) - len(hit), sum(b[1] == {f} for b in mine),
                    sum(b[2] for b in hit), sum(b[3] for b in hit),
                )
        for key in [k for k in out if k[0] == part]:
            out[key] += (shapley[key[1][key[2] - 1]],)
    return out


def test_audit_against_plain(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(90)] + ["É", "A$", "x\x1cy", "BIG", "WORD"]
    rows = []
    for k in range(160):
        n = rng.choice([0, 10, 49, 50, 51, 80])
        rows.append((k, rng.choice(["\t", " ", "\n \x0b"]).join(rng.choices(vocabulary[: rng.choice([20, 95])], k=n)),
                     rng.choice(["a", "b", None, ""])))
    rows += [(200 + k, rows[k % 7][1], "c") for k in range(60)] + [(300, None, "a"), (None, None, "a"), (None, "x", "d")]
    rows += [rows[5], (5, "another text", "a")]
    rows += [(400, "long " * 60_000 + "tail", "b"), (401, " ".join(f"v{i}" for i in range(300)) * 3, "b")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 300, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "doc_id long, text string, source string, mask string, step int"
    ).repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in audit.audit(docs, marks).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
        "toxic_lost", "shapley").collect()}
    assert got == plain_audit(rows, labels)
    assert audit.audit(docs.limit(0), marks).count() == 0


def test_matrix_is_one_matrix(spark):
    """Equal words have one column in all shards, different words never share one."""
    docs = spark.createDataFrame([(i, f"alpha beta{i % 3} alpha", "s") for i in range(12)],
                                 "doc_id long, text string, source string").repartition(4)
    cells = []
    for r in audit.document_term_matrix(docs).collect():
        bounds, columns, times = (np.frombuffer(r[c], np.int64) for c in ("bounds", "columns", "times"))
        for i, key in enumerate(r["doc_ids"]):
            cells += [(key, int(c), int(t)) for c, t in zip(columns[bounds[i]:bounds[i + 1]], times[bounds[i]:bounds[i + 1]])]
    columns = {c for _, c, _ in cells}
    assert len(cells) == 24 and len(columns) == 4
    (alpha,) = {c for _, c, t in cells if t == 2}
    by_key = {k: c for k, c, _ in cells if c != alpha}
    assert all((by_key[a] == by_key[b]) == (a % 3 == b % 3) for a in by_key for b in by_key)


# --- exact top-k -----------------------------------------------------------------------


def plain_top(rows, k=20, every=20):
    whole = lambda v: [math.floor(64 * float(x)) for x in v]
    ok = [(i, whole(v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    limit = 2**63
    out = set()
    for q, a in ok:
        if q % every == 0:
            scores = sorted((-max(-limit, min(limit - 1, sum(x * y for x, y in zip(a, b)))), i) for i, b in ok if i != q)
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def check_top(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, score int, segment int")
    got = [tuple(r) for r in topk.top_k(df.repartition(3)).select("query_id", "rank", "vec_id", "score").collect()]
    assert len(got) == len(set(got)) and set(got) == plain_top(rows)


def test_top_k_with_copies_ties_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(9, 12))
    rows = [(i, (centres[i % 9] + 0.1 * rng.normal(size=12)).tolist()) for i in range(1500)]
    rows += [(2000 + i, [1.0] * 12) for i in range(700)]
    rows += [(4000 + i, [float(x) for x in rng.integers(-1, 2, 12)]) for i in range(200)]
    rows += [(5000, None), (5001, []), (5020, []), (5040, [0.0] * 12), (5060, [math.nan] * 12), (5080, [math.inf] * 12),
             (5100, [None] * 12), (None, [1.0] * 12), (5120, [1.0] * 15), (5121, [-3.0, 2.0])]
    check_top(spark, rows)


def test_top_k_over_many_segments(spark, monkeypatch):
    monkeypatch.setattr(topk, "BATCH", 7)
    monkeypatch.setattr(topk, "LOT", 2)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(900)]
    check_top(spark, rows)


def test_top_k_beyond_floating_point(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=4) * 10.0**e).tolist()) for e in (0, 8, 15) for i in range(e * 100, e * 100 + 70)]
    check_top(spark, rows)


def test_top_k_of_little(spark):
    check_top(spark, [])
    check_top(spark, [(20, [1.0])])
    check_top(spark, [(20, [1.0]), (40, [2.0]), (41, [-1.0])])


def test_top_k_writes_each_query_once(spark, monkeypatch):
    kept, write = [], topk.durable
    monkeypatch.setattr(topk, "durable", lambda df: kept.append(write(df)) or kept[-1])
    rng = np.random.default_rng(8)
    check_top(spark, [(i, rng.normal(size=8).tolist()) for i in range(900)])
    sent = [f.agg(F.sum(F.length("q"))).first()[0] for f in kept if "q" in f.columns]
    assert sum(sent) <= 45 * 8 * 8  # not once for each segment that it visits


def test_top_k_of_empty_vectors(spark):
    check_top(spark, [(20, []), (21, []), (40, [])])
