"""Packing into fixed sequences by cutting-stock column generation.

A document is cut into full sequences and one rest. Rests are rounded up to ``GRID`` tokens,
which leaves a histogram of at most ``SEQUENCE / GRID`` lengths whatever the corpus size. A
linear program over patterns (how many rests of each length share a sequence) is solved on it
by column generation: a knapsack dynamic program prices new patterns. Patterns are rounded
down; what remains, at most a few rests for each length, is packed best-fit. Every pattern
then takes the documents of its lengths by their rank.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import durable
from .common import give_back, query, slices, small_batches, table, words_of

SEQUENCE = 4096
GRID = 16
END_ID = 2
RANK_SALTS = 64
LOWER = "abcdefghijklmnopqrstuvwxyz"
ROUNDS = 4000


def solve(lengths: list[int], counts: list[int], capacity: int) -> list[tuple[float, tuple[int, ...]]]:
    """(use, pattern) of an optimal fractional cover; a pattern counts items of each length."""
    size = np.array(lengths)
    need = np.array(counts, float)
    basis = np.diag([capacity // n for n in lengths]).astype(float)  # columns are patterns
    for _ in range(ROUNDS):
        price = np.linalg.solve(basis.T, np.ones(len(size)))
        pattern = knapsack(size, price, capacity)
        if pattern @ price <= 1 + 1e-7:
            break
        use = np.maximum(np.linalg.solve(basis, need), 0)
        step = np.linalg.solve(basis, pattern.astype(float))
        ratio = np.full(len(size), np.inf)
        np.divide(use, step, out=ratio, where=step > 1e-9)
        basis[:, int(np.argmin(ratio))] = pattern
    use = np.maximum(np.linalg.solve(basis, need), 0)
    return [(float(u), tuple(basis[:, i].astype(int).tolist())) for i, u in enumerate(use) if u > 1e-9]


def knapsack(size: np.ndarray, price: np.ndarray, capacity: int) -> np.ndarray:
    """The pattern of the greatest price that fits: dynamic program over used capacity."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    useful = np.flatnonzero(price > 1e-12)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        fit = useful[size[useful] <= c]
        if len(fit):
            value = best[c - size[fit]] + price[fit]
            k = int(np.argmax(value))
            if value[k] > best[c] + 1e-12:
                best[c], last[c] = value[k], fit[k]
    pattern, c = np.zeros(len(size), np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= size[last[c]]
    return pattern


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: items}) that place exactly ``counts`` items of each length.

    Fractional uses are rounded down. The rest, fewer items than a pattern for each length
    holds, goes into open sequences, the longest first, each where least room stays.
    """
    lengths = sorted(n for n, c in counts.items() if c > 0)
    if not lengths:
        return []
    left = Counter({n: counts[n] for n in lengths})
    out: list[tuple[int, dict[int, int]]] = []
    for use, pattern in sorted(solve(lengths, [counts[n] for n in lengths], capacity), reverse=True):
        each = {n: p for n, p in zip(lengths, pattern) if p}
        times = min([int(use + 1e-6), *(left[n] // p for n, p in each.items())])
        if times > 0:
            out.append((times, each))
            for n, p in each.items():
                left[n] -= times * p
    opened: list[tuple[int, Counter]] = []
    for n in sorted(left, reverse=True):
        for _ in range(left[n]):
            fits = [i for i, (room, _) in enumerate(opened) if room >= n]
            if fits:
                i = min(fits, key=lambda i: opened[i][0])
            else:
                opened.append((capacity, Counter()))
                i = len(opened) - 1
            room, held = opened[i]
            held[n] += 1
            opened[i] = (room - n, held)
    return out + [(1, dict(held)) for _, held in opened]


KNOWN_WORDS = 1 << 18  # words whose ids a task keeps
MARKS = ",.;:!?#$%&*"
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"  # letters that stay what they are beside any other
PLAIN = re.compile(f"[{LETTERS}]+").fullmatch
JOINED = 256  # plain words in one text for the tokenizer
SLICE_BYTES = 2 << 20  # of text that a task encodes at once


def tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


class Encoder:
    """Ids of texts by a tokenizer whose tokens never span white space.

    Each distinct run of other characters is encoded once a task, which saves most of the work. Runs
    are made alike first where the tokenizer itself does so: in lower case, and without marks
    at their end. Runs of letters go to the tokenizer many at a time, where it ends each word by a
    token that shows it. All this is tried out on the tokenizer, and left alone if it does otherwise.
    Known runs are kept in two generations: what was not met again while one filled up is forgotten.
    """

    def __init__(self, path: str):
        self.model = tokenizer(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        normal, parts = self.model.normalizer, self.model.pre_tokenizer
        letters = LOWER.upper() + LOWER
        self.lowers = normal is not None and normal.normalize_str(letters) == LOWER * 2
        self.parts_marks = parts is not None and all(
            [p for p, _ in parts.pre_tokenize_str(letter + m + n)] == [letter, m + n]
            for letter in LOWER for m in MARKS for n in ("", *MARKS)
        )
        suffix = getattr(self.model.model, "end_of_word_suffix", None)
        plain = [chr(c) for c in range(256) if PLAIN(chr(c))]
        self.joins = bool(suffix) and parts is not None and all(
            len(parts.pre_tokenize_str(f"{c}{c} {c}")) == 2 for c in plain
        )
        self.ends = np.zeros(self.model.get_vocab_size(), bool)
        if self.joins:
            self.ends[[i for t, i in self.model.get_vocab().items() if t.endswith(suffix)]] = True

    def alike(self, texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts, "")
        if self.lowers:
            texts = pc.ascii_lower(texts)
        if self.parts_marks:
            ends = f"([a-z])([{MARKS}]+)([ \\t-\\r]|$)"
            texts = pc.replace_substring_regex(texts, ends, r"\1 \2\3")
        return texts

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[str]) -> None:
        """Put the ids of all ``words`` into ``known``."""
        if len(self.known) > KNOWN_WORDS // 2:
            self.known, self.older = {}, self.known
        known, older, plain, other = self.known, self.older, [], []
        for w in words:
            if w not in known:
                if w in older:
                    known[w] = older[w]
                else:
                    (plain if self.joins and PLAIN(w) else other).append(w)
        for i in range(0, len(plain), JOINED):
            some = plain[i : i + JOINED]
            flat = np.array(self.encode([" ".join(some)])[0], np.uint32)
            ends = np.flatnonzero(self.ends[flat]) + 1
            if len(ends) != len(some) or ends[-1] != len(flat):
                other += some
                continue
            blob = flat.tobytes()
            for w, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist()):
                known[w] = blob[4 * a : 4 * b]
        for w, ids in zip(other, self.encode(other)):
            known[w] = array("I", ids).tobytes()

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids per text, ids of all texts)."""
        lens, codes, words = words_of(self.alike(texts), lower=False)
        words = words.to_pylist()
        self.learn(words)
        coded = [self.known[w] for w in words]
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        every = np.frombuffer(b"".join(coded), np.uint32)
        begin = np.cumsum(size) - size
        each = size[codes]
        at = np.repeat(begin[codes] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
        ends = np.concatenate([[0], np.cumsum(each)])[np.cumsum(lens)] if len(lens) else np.zeros(0, np.int64)
        return np.diff(np.concatenate([[0], ends])), every[at]


def pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, with_ids: bool = False,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, row, start, length, ids_crc32, doc_tokens[, ids]): full sequences and the rests.

    ``row`` tells rows of equal keys apart: it hashes key and text.
    """

    def run(batches):
        give_back()  # the worker may have served an earlier stage
        encoder = Encoder(path)
        for batch in slices(batches, 2, SLICE_BYTES):
            keys, rows, texts = (batch.column(i) for i in range(3))
            at, start, length, crc, total, kept = [], [], [], [], [], []
            sizes, flat = encoder.ids(texts)
            for k, (n, end) in enumerate(zip(sizes.tolist(), np.cumsum(sizes).tolist())):
                ids = np.append(flat[end - n : end], np.uint32(END_ID)).astype("<u4")
                for s in range(0, len(ids), sequence):
                    piece = ids[s : s + sequence]
                    at.append(k)
                    start.append(s)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(ids))
                    if with_ids:
                        kept.append(piece.astype(np.int64))
            columns = [keys.take(pa.array(at, pa.int64())), rows.take(pa.array(at, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int64())))
            names = [key, "row", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])
            give_back()

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, row long, start long, length long, ids_crc32 long, doc_tokens long"
    source = docs.select(key, F.xxhash64(key, text).alias("row"), text)
    return source.mapInArrow(run, schema + (", ids array<long>" if with_ids else ""))


def _ranked(rows: DataFrame) -> DataFrame:
    """``rank`` from 0 within each ``unit``; a unit's rows are dealt over salts and numbered there."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row", "start"), F.lit(RANK_SALTS)).cast("int"))
    counts = salted.groupBy("unit", "salt").agg(F.count("*").alias("n"))
    before = counts.select(
        "unit", "salt",
        (F.sum("n").over(Window.partitionBy("unit").orderBy("salt")) - F.col("n")).alias("before"),
    )
    inside = Window.partitionBy("unit", "salt").orderBy("row", "start")
    return salted.withColumn("inside", F.row_number().over(inside)).join(before, ["unit", "salt"]).withColumn(
        "rank", F.col("before") + F.col("inside") - 1
    ).drop("salt", "before", "inside")


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE, grid: int = GRID,
         with_ids: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), a row per piece.

    Null and empty texts are one end token. Full sequences stand alone; every other sequence
    holds at most ``sequence`` tokens without gaps. Null keys stay, repeated rows are packed as
    often as they occur, other columns are ignored, an empty table gives no row.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        cut = durable(pieces(docs, path, sequence, with_ids, key, text).withColumn(
            "unit", F.ceil(F.col("length") / grid).cast("int")
        ))
    counts = {r["unit"]: r["n"] for r in cut.groupBy("unit").agg(F.count("*").alias("n")).collect()}
    slots, base, at = [], 0, Counter()
    for times, each in plan(counts, sequence // grid):  # at most two patterns a length
        for unit, items in each.items():
            slots.append((unit, at[unit], at[unit] + times * items, items, base))
            at[unit] += times * items
        base += times
    layout = spark.createDataFrame(
        slots, "s_unit int, first long, past long, items long, base long"
    )
    placed = _ranked(cut).join(
        F.broadcast(layout),  # (sequence / grid) lengths in at most as many patterns and more
        (F.col("unit") == F.col("s_unit")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past")),
    ).withColumn("sequence_id", F.col("base") + F.floor((F.col("rank") - F.col("first")) / F.col("items")))
    inside = Window.partitionBy("sequence_id").orderBy(F.col("unit").desc(), "rank")
    return placed.withColumn(
        "offset", F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    ).select(
        key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
        *(["ids"] if with_ids else []),
    )


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), word_bpe())
