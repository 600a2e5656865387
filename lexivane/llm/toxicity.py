"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the hashed character n-grams that occur in it. Training counts, over a
sample of labelled rows, in how many toxic and clean texts each n-gram occurs. N-grams whose
split between the classes could be chance or is weak are dropped; the rest carry the log ratio of their
smoothed rates as value, and a logistic regression is fitted on these values. Scoring looks
the n-grams of a whole text up in one weight table of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import durable
from .common import query, remainder, table, thrifty

SIZES = (3, 4, 5)
BITS = 20
SAMPLE_ROWS = 8192
EVIDENCE = (6.0, 10.0, 14.0, 20.0)  # a model each; few labels do not tell which is best
LEAST_RATIO = 1.0
RIDGE = 1.0
ROUNDS = 100
THRESHOLD = 0.7


def ngrams(text: str | None) -> np.ndarray:
    """Hashed n-grams of a text, with repeats, in lower case and between spaces."""
    plain = " " + " ".join((text or "").lower().split()) + " "
    a = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out = []
    h = a.copy()
    for n in range(2, max(SIZES) + 1):
        if len(a) < n:
            break
        h = h[: len(a) - n + 1] * np.uint64(1_000_003) + a[n - 1 :]
        if n in SIZES:
            out.append(((h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))
    return np.concatenate(out).astype(np.int32) if out else np.zeros(0, np.int32)


@dataclass
class Model:
    """Features in ascending order with their weights; a text scores sigmoid(bias + sum)."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self):
        weight = np.zeros(1 << BITS, np.float64)
        weight[self.features] = self.weights
        used = np.zeros(1 << BITS, bool)
        used[self.features] = True
        bias = self.bias

        def score(text: str | None) -> float:
            ids = ngrams(text)
            z = bias + weight[np.unique(ids[used[ids]])].sum()
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, y): at most ``rows`` labelled texts of each class, those of the smallest hashes."""
    known = (
        labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id").agg(F.max("toxic").alias("y"))
        .filter(remainder("doc_id", 3) != 1)
    )
    parts = [
        known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        for y in (0, 1)
    ]
    chosen = durable(parts[0].unionByName(parts[1]))
    return docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "y")


def _counts(batches):
    clean, toxic = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for batch in batches:
        for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
            (toxic if y else clean)[np.unique(ngrams(text))] += 1
    seen = np.flatnonzero(clean + toxic)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(clean[seen]), pa.array(toxic[seen])], ["f", "clean", "toxic"]
    )


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample of labelled rows.

    Without toxic rows every text scores as clean (bias only), without clean ones as toxic,
    without any labels 0.5. What reaches the driver is bounded by the number of hashed
    features and by the sample, never by the corpus.
    """
    texts = durable(sample(docs, labels, rows))
    size = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    none = Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((n1 + 0.5) / (n0 + 0.5))))
    if not n0 or not n1:
        return none
    counted = (
        texts.mapInArrow(thrifty(_counts), "f long, clean long, toxic long")
        .groupBy("f").agg(F.sum("clean").alias("a"), F.sum("toxic").alias("b"))
    )
    a, b = F.col("a") / n0, F.col("b") / n1
    both = (F.col("a") + F.col("b")) / (n0 + n1)

    def part(k, n, p):
        return F.when(F.col(k) > 0, F.col(k) * F.log(p / both)).otherwise(0.0) + F.when(
            F.col(k) < n, (n - F.col(k)) * F.log((1 - p) / (1 - both))
        ).otherwise(0.0)

    evidence = 2 * (part("a", n0, a) + part("b", n1, b))
    rate = F.log((F.col("b") + 0.5) / (n1 + 1.0)) - F.log((F.col("a") + 0.5) / (n0 + 1.0))
    kept = (
        counted.filter((F.col("a") + F.col("b")) < n0 + n1)
        .select("f", evidence.alias("g"), rate.alias("r"))
        .filter((F.col("g") >= min(EVIDENCE)) & (F.abs("r") >= LEAST_RATIO))
        .orderBy("f").toPandas()
    )
    if not len(kept):
        return none
    features, ratio = kept["f"].to_numpy(np.int64), kept["r"].to_numpy(np.float64)
    place = np.full(1 << BITS, -1, np.int32)
    place[features] = np.arange(len(features))

    def present(batches):
        for batch in batches:
            ids = [place[np.unique(ngrams(t))] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i[i >= 0].tobytes() for i in ids], pa.binary()), batch.column("y")],
                ["ids", "y"],
            )

    rows_in = texts.mapInArrow(thrifty(present), "ids binary, y int").collect()
    ids = [np.frombuffer(r["ids"], np.int32) for r in rows_in]
    y = np.array([r["y"] for r in rows_in], np.float64)
    row = np.repeat(np.arange(len(ids), dtype=np.int32), [len(i) for i in ids])
    col, evidence = np.concatenate(ids), kept["g"].to_numpy(np.float64)
    weights, bias = np.zeros(len(features)), 0.0
    for least in EVIDENCE:
        some = evidence >= least
        at, own = np.cumsum(some) - 1, some[col]
        w, b = _regress(row[own], at[col[own]], y, ratio[some])
        weights[some] += w / len(EVIDENCE)
        bias += b / len(EVIDENCE)
    return Model(features, weights, bias)


def _regress(row: np.ndarray, col: np.ndarray, y: np.ndarray, ratio: np.ndarray, l2: float = RIDGE,
             rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights (already times the ratios) and bias of a class-balanced logistic regression."""
    value = ratio[col]
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))
    w, bias = np.zeros(len(ratio)), 0.0
    m, v, step = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1), 0.05
    for t in range(1, rounds + 1):
        z = bias + np.bincount(row, value * w[col], len(y))
        error = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.append(np.bincount(col, value * error[row], len(w)) + l2 * w / len(w), error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w * ratio, float(bias)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) for every row; null and empty texts have the bias alone.

    Each row is scored by itself: repeated rows score alike, null keys stay, other columns
    are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most 2**BITS weights

    def run(batches):
        one = sent.value.scorer()
        for batch in batches:
            s = np.array([one(t) for t in batch.column(1).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                [key, "score", "predicted"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(thrifty(run), f"`{key}` {kind}, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, that the classifier does not call toxic."""
    one_of = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches):
        one = one_of.value.scorer()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            yield batch.filter(pa.array([one(t) < THRESHOLD for t in batch.column(at).to_pylist()]))

    return docs.mapInArrow(thrifty(run), docs.schema)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score", "predicted",
    )
