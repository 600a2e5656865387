"""Spelling variants by search schemes over a bidirectional FM-index of the vocabulary.

A word that is one error away from another agrees with it in the first or in the second half. So a
search matches one half exactly and then extends across the other half, allowing one error there:
to the right after the first half, to the left after the second. Every word is asked both ways.

The index is sharded by the half that a search starts with, so a search visits one shard, not all
of them: a word is held under the halves that words of its length, one less and one more can ask
for, and asks under its own. The direction that extends to the right is kept over reversed words,
the other over the words as they are, which makes both the same backward search. Halves that too
many words share are cut into blocks, and those who ask for them visit all of their blocks.

A shard is the suffix order of its delimited words and, as the ranks of the Burrows-Wheeler
transform, the sorted pairs of symbol and row: the place of (c, row) in that list is the first row
of the next interval. All searches of a batch move on together, a symbol at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import durable
from .common import partitions, query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 7
SHARD_WORDS = 100_000
BATCH = 16_384
FEW = 32  # rows of an interval up to which its symbols are read off, not asked for


class Index:
    """Suffix order and rank of a delimited vocabulary of distinct words; searches go backward."""

    def __init__(self, codes: np.ndarray, lens: np.ndarray):
        ends = np.cumsum(lens + 1)
        self.n = int(ends[-1]) if len(ends) else 0
        inside = np.ones(self.n, bool)
        inside[ends - 1] = False
        self.alphabet = np.unique(codes)
        symbols = np.zeros(self.n, np.int64)
        symbols[inside] = np.searchsorted(self.alphabet, codes) + 1
        left = np.repeat(ends, lens + 1) - np.arange(self.n)  # symbols up to the delimiter, with it
        order = self._suffixes(symbols, left)
        before = symbols[order - 1]
        rows = np.argsort(before.astype(np.min_scalar_type(len(self.alphabet))), kind="stable")
        self.before = before
        self.ranks = before[rows] * self.n + rows
        self.word = np.repeat(np.arange(len(lens)), lens + 1)[order]
        self.words = len(lens)

    def _suffixes(self, symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Positions in the order of what follows them in their word; equal ones in word order."""
        bits, span = max(1, int(len(self.alphabet)).bit_length()), 1
        ahead = lambda key, d: np.where(left > d, np.concatenate([key[d:], np.zeros(min(d, len(key)), key.dtype)]), 0)
        key = symbols.copy()
        while 2 * span * bits <= 62:
            key = (key << (span * bits)) | ahead(key, span)
            span *= 2
        longest = int(left.max()) if len(left) else 0
        while True:
            order = np.argsort(key, kind="stable")
            if span >= longest:
                return order
            ranked = key[order]
            rank = np.empty(len(key), np.int64)
            rank[order] = np.cumsum(np.concatenate([[1], (ranked[1:] != ranked[:-1]).astype(np.int64)]))
            key = rank * (len(key) + 1) + ahead(rank, span)
            span *= 2

    def encode(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of code points; those that no word has come after all others."""
        if not len(self.alphabet):
            return np.ones(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at + 1, len(self.alphabet) + 1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals with one more symbol in front."""
        base = symbol * self.n
        return np.searchsorted(self.ranks, base + low), np.searchsorted(self.ranks, base + high)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """(interval, symbol, low, high) of every non-empty extension of distinct intervals, but by the delimiter."""
        size = high - low
        small = np.flatnonzero(size <= FEW)
        at = np.repeat(small, size[small])
        row = np.repeat(low[small] - (np.cumsum(size[small]) - size[small]), size[small]) + np.arange(len(at))
        width = len(self.alphabet) + 1
        pairs = np.unique(at * width + self.before[row])
        large = np.flatnonzero(size > FEW)
        all_of = (large[:, None] * width + np.arange(width)).ravel()
        pairs = np.concatenate([pairs, all_of])
        at, symbol = pairs // width, pairs % width
        keep = symbol > 0
        at, symbol = at[keep], symbol[keep]
        lows, highs = self.extend(symbol, low[at], high[at])
        found = highs > lows
        at, symbol, lows, highs = at[found], symbol[found], lows[found], highs[found]
        order = np.argsort(at, kind="stable")
        return at[order], symbol[order], lows[order], highs[order]

    def whole(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The word that an interval matches from end to end, or -1; words are distinct."""
        at = np.searchsorted(self.ranks[: self.words], low)
        row = self.ranks[: self.words][np.minimum(at, self.words - 1)]
        return np.where((at < self.words) & (row < high), self.word[row], -1)

    def near(self, codes: np.ndarray, lens: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for words one error away, the last ``exact`` symbols of the query in place."""
        symbols = self.encode(codes)
        last = np.cumsum(lens) - 1
        next_of = lambda q, done: np.where(done < lens[q], symbols[last[q] - np.minimum(done, lens[q] - 1)], 0)
        q = np.arange(len(lens))
        low, high = np.zeros(len(q), np.int64), np.full(len(q), self.words, np.int64)
        for t in range(int(exact.max()) if len(exact) else 0):
            more = t < exact[q]
            a, b = self.extend(next_of(q[more], np.full(more.sum(), t)), low[more], high[more])
            low[more], high[more] = a, b
            alive = high > low
            q, low, high = q[alive], low[alive], high[alive]
        done = exact[q].astype(np.int64)
        found_q, found_w = [], []
        pool = [np.zeros(0, np.int64)] * 4  # query, symbols done, low, high: one error made
        while len(q) or len(pool[0]):
            made = [pool]
            if len(q):
                symbol = next_of(q, done)
                # leave the symbol out; of a run of equal ones only the last
                out = (done < lens[q]) & ((done + 1 >= lens[q]) | (next_of(q, done + 1) != symbol))
                made.append([q[out], done[out] + 1, low[out], high[out]])
                # put another symbol in front or in its place
                both, which = np.unique(low * (self.n + 1) + high, return_inverse=True)
                of, c, lows, highs = self.branches(both // (self.n + 1), both % (self.n + 1))
                first = np.searchsorted(of, np.arange(len(both) + 1))
                times = (first[1:] - first[:-1])[which]
                state = np.repeat(np.arange(len(q)), times)
                child = np.repeat(first[which] - (np.cumsum(times) - times), times) + np.arange(len(state))
                other = c[child] != symbol[state]
                state, child = state[other], child[other]
                made.append([q[state], done[state], lows[child], highs[child]])
                change = done[state] < lens[q[state]]
                state, child = state[change], child[change]
                made.append([q[state], done[state] + 1, lows[child], highs[child]])
                on = done < lens[q]
                q, done, symbol = q[on], done[on], symbol[on]
                low, high = self.extend(symbol, low[on], high[on])
                done = done + 1
                alive = high > low
                q, done, low, high = q[alive], done[alive], low[alive], high[alive]
            pq, pdone, plow, phigh = (np.concatenate(x) for x in zip(*made))
            end = pdone >= lens[pq]
            word = self.whole(plow[end], phigh[end])
            found_q.append(pq[end][word >= 0])
            found_w.append(word[word >= 0])
            pq, pdone, plow, phigh = pq[~end], pdone[~end], plow[~end], phigh[~end]
            plow, phigh = self.extend(next_of(pq, pdone), plow, phigh)
            alive = phigh > plow
            pool = [pq[alive], pdone[alive] + 1, plow[alive], phigh[alive]]
        if not found_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(found_q) * max(self.words, 1) + np.concatenate(found_w))
        return pairs // max(self.words, 1), pairs % max(self.words, 1)


def points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in a row, and how many each has."""
    text = "".join(words.to_pylist())
    return np.frombuffer(text.encode("utf-32-le"), np.uint32), pc.utf8_length(words).to_numpy().astype(np.int64)


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Tables of whole keys, ``size`` rows and the rest of a key; equal keys lie together."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < size:
            continue
        keys = batch.column("lot").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))  # sorted: where the last key begins
        if cut == 0 and (len(held) == 1 or held[-2].column("lot")[-1].as_py() == keys[0]):
            continue
        yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
        held, rows = [batch.slice(cut)], batch.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def _search(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n) of a sorted stream of (lot, side, word, n, exact, holds, asks)."""
    for shard in _shards(batches, size):
        for side in (0, 1):
            rows = shard.filter(pc.equal(shard["side"], side)).combine_chunks()
            held = rows.filter(rows["holds"])
            if not held.num_rows:
                continue
            coded = held["word"].combine_chunks().dictionary_encode()
            words = coded.dictionary
            counts = np.zeros(len(words), np.int64)
            counts[coded.indices.to_numpy()] = held["n"].to_numpy()
            turn = pc.utf8_reverse if side == 0 else (lambda w: w)
            index = Index(*points(turn(words)))
            asked = rows.filter(rows["asks"])
            asked = asked.take(np.argsort(pc.utf8_length(asked["word"]).to_numpy(), kind="stable"))
            for i in range(0, asked.num_rows, BATCH):
                part = asked.slice(i, BATCH).combine_chunks()
                own = part["word"].combine_chunks()
                codes, lens = points(turn(own))
                q, w = index.near(codes, lens, part["exact"].to_numpy().astype(np.int64))
                for j in range(0, len(q), 1 << 16):
                    a, b = q[j : j + (1 << 16)], w[j : j + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [own.take(pa.array(a)), words.take(pa.array(b)), pa.array(counts[b])],
                        names=["word", "near", "near_n"],
                    )


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, near, near_n) for distinct (word, n): all pairs one code point apart, both ways.

    Words of fewer than two code points are left out, as their halves may be empty.
    """
    long = words.filter(F.length("word") >= 2)
    halves = lambda part: F.array_distinct(F.array(*[
        F.expr(part).cast("int") for part in (part.replace("L", f"(length(word) + {d})") for d in (0, -1, 1))
    ]))
    left = long.withColumn("size", F.explode(halves("L div 2"))).select(
        "word", "n", F.lit(0).alias("side"), "size", F.expr("substring(word, 1, size)").alias("half"),
        (F.col("size") == F.expr("length(word) div 2")).alias("asks"),
    )
    right = long.withColumn("size", F.explode(halves("L - L div 2"))).select(
        "word", "n", F.lit(1).alias("side"), "size", F.expr("right(word, size)").alias("half"),
        (F.col("size") == F.expr("length(word) - length(word) div 2")).alias("asks"),
    )
    rows = left.unionByName(right).withColumn("key", F.xxhash64("side", "half")).select(
        "key", "side", "word", "n", F.col("size").alias("exact"), "asks"
    )
    n = partitions(words.sparkSession)
    common = rows.groupBy("key").count().filter(F.col("count") > shard_words).select(
        F.col("key").alias("common"), F.ceil(F.col("count") / shard_words).cast("int").alias("blocks")
    )
    cut = rows.join(common, F.col("key") == F.col("common"), "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))
    )
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    dealt = (
        cut.withColumn("own", own)
        .withColumn("block", F.explode(F.when(
            F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))))
        .select(
            F.xxhash64("key", "block").alias("lot"), "side", "word", "n", "exact",
            (F.col("block") == F.col("own")).alias("holds"), "asks",
        )
    )
    return (
        dealt.repartition(n, "lot").sortWithinPartitions("lot")
        .mapInArrow(lambda b: _search(b, shard_words), "word string, near string, near_n long")
        # both halves may agree, and a word may lie in two blocks of one shard
        .repartition(n, "word").dropDuplicates(["word", "near"])
    )


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text",
               least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): lower-cased runs of Latin letters of at least ``least_length``, and how often.

    Where 31 divides the crc32 of ``<key>:<run>`` the run's letter number crc32 % length is left out. Runs of
    a null key stay as they are.
    """
    runs = F.regexp_extract_all(
        F.col(text), F.lit(f"([A-Za-z\\u00C0-\\u00FF]{{{least_length},}})"), F.lit(1)
    )
    run = F.translate("run", UPPER, LOWER)
    h = F.crc32(F.concat(F.col(key).cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (
        docs.select(key, F.explode(runs).alias("run"))
        .select(key, run.alias("run"))
        .withColumn("h", h)
        .select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
        .groupBy("word").agg(F.count("*").alias("n"))
        .filter(F.length("word") >= least_length)
    )


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text",
                      least_length: int = LEAST_LENGTH, least_count: int = 2, ratio: int = 10,
                      shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, n, n_near, form, form_n, root): words and what they are variants of.

    Words are near if one inserted, deleted or replaced code point tells them apart. The form of a word is
    its near word of largest n (of equal ones the smallest) if that n is ``ratio`` times its own; its root
    is the end of its chain of forms, itself without any. Counts grow along a chain, so it ends.

    Null and empty texts hold no words; rows with a null key count as they are; repeated rows count as often
    as they occur; other columns are ignored; an empty table gives no row.
    """
    words = durable(vocabulary(docs, key, text, least_length).filter(F.col("n") >= least_count))
    near = near_words(words, shard_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best")
    ).select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.col1")).alias("near_n"))
    is_form = F.col("near_n") >= ratio * F.col("n")
    every = durable(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"),
    ))
    roots = every.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the steps that a root is ahead
        further = roots.select(F.col("word").alias("at"), F.col("root").alias("end"))
        moved = durable(roots.join(further, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")
        ))
        roots = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return every.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


SQL = rf"""
WITH RECURSIVE r AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')), '{UPPER}', '{LOWER}') AS run FROM documents),
u AS (SELECT doc_id, run, count(*) AS c FROM r GROUP BY ALL),
b AS (SELECT run, c, hex(encode(doc_id || ':' || run)) AS x FROM u),
h AS (SELECT run, c, xor(4294967295, list_reduce(
    [4294967295] || [CAST('0x' || x[2 * i + 1 : 2 * i + 2] AS BIGINT) FOR i IN range(length(x) // 2)],
    lambda s, y: list_reduce([xor(s, y)] || range(8), lambda t, k: xor(t >> 1, 3988292384 * (t & 1))))) AS h FROM b),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM h),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
d AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT d.word, v.word AS near FROM d JOIN v ON rest = v.word UNION SELECT v.word, d.word FROM d JOIN v ON rest = v.word
  UNION SELECT x.word, y.word FROM d x JOIN d y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
g AS (SELECT p.word, near, n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY n DESC, near) AS r
  FROM p JOIN v ON near = v.word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN g.n >= 10 * v.n THEN near END AS form, CASE WHEN g.n >= 10 * v.n THEN g.n END AS form_n
  FROM v LEFT JOIN g ON v.word = g.word AND r = 1),
c AS (SELECT word, word AS root FROM f UNION ALL SELECT c.word, form FROM c JOIN f ON root = f.word WHERE form IS NOT NULL),
e AS (SELECT c.word, root FROM c JOIN f ON root = f.word WHERE form IS NULL)
SELECT f.word, n, n_near, form, form_n, root FROM f JOIN e ON f.word = e.word"""


@query("op11_variants", SQL)
def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
