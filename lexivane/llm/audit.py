"""Filter interaction audit over a sparse document-term matrix.

Texts are read once, in slices of about 16 MB. A slice becomes a shard: a matrix in compressed
sparse rows over the slice's own words. Words meet words of other shards in one shuffle, in which
a word travels once a shard however often it occurs, and get a number that is the same in all
shards. The shards are then renumbered: row sums are words, stored cells are distinct words.

The other filters need no matrix. Failures are five bits a document; everything the audit reports
follows from the number of documents of each part, bit pattern and label, so only those counts
are multiplied by the 120 orders.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import durable
from .common import partitions, query, slices, table, words_of

SLICE = 16 << 20
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
SYMBOLS = b"#$%&*|"

FLUSH = 1 << 20  # numbered words that a task holds before it deals them to their shards

ABOUT = (
    "shard long, doc_ids array<long>, parts array<string>, digests array<binary>, upper array<long>, "
    "points array<long>, symbols array<boolean>, bounds binary"
)
SHARDS = f"{ABOUT}, cells binary, times binary, words array<string>"
MATRIX = f"{ABOUT}, columns binary, times binary"
NUMBERS = "shard long, locals binary, columns binary"


def _names(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed."""
    return pa.compress(values.astype(np.uint32).tobytes(), codec="zstd", asbytes=True)


def _opened(data: pa.Buffer, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, codec="zstd"), np.uint32)


def _counts(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of a few flags are set between consecutive offsets."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), offsets))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins and ends."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each slice of (doc_id, part, text): its matrix with words numbered in the slice."""
    number = TaskContext.get().partitionId() << 32
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True
    lists = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.bool_())
    for batch in slices(batches, 2, SLICE):
        texts = pc.fill_null(batch.column(2), "")
        lens, codes, words = words_of(texts, lower=False)
        n, width = len(lens), max(len(words), 1)
        cells, times = np.unique(np.repeat(np.arange(n) * width, lens) + codes, return_counts=True)
        bounds = np.searchsorted(cells, np.arange(n + 1) * width)
        raw, offsets = _bytes(texts)
        digests = [xxhash.xxh3_128_digest(raw[a:b].data) for a, b in zip(offsets[:-1], offsets[1:])]
        upper = _counts((raw >= 65) & (raw <= 90), offsets)
        points = np.diff(offsets) - _counts((raw & 0xC0) == 0x80, offsets)
        symbols = _counts(is_symbol[raw], offsets) > 0
        items = [batch.column(0), batch.column(1), digests, upper, points, symbols]
        binaries = [bounds.astype(np.int64).tobytes(), _squeezed(np.diff(cells % width, prepend=0)), _squeezed(times)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), *[_one(v, pa.list_(t)) for v, t in zip(items, lists)],
             *[pa.array([v], pa.binary()) for v in binaries], _one(words, pa.list_(pa.string()))],
            names=_names(SHARDS),
        )
        number += 1


def _one(value, kind: pa.DataType) -> pa.Array:
    """An array of one row; a list column takes its items as they are, without Python objects."""
    if not pa.types.is_list(kind):
        return pa.array([value], kind)
    items = value if isinstance(value, pa.Array) else pa.array(value, kind.value_type)
    return pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items.cast(kind.value_type))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, locals, columns) from (word, shard, local) in the order of words: a number a word.

    All rows of a word lie in one partition, whose number is in the upper bits.
    """
    at, last = (TaskContext.get().partitionId() << 40) - 1, None
    held: list[tuple[np.ndarray, ...]] = []

    def flush() -> Iterator[pa.RecordBatch]:
        shard, local, column = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = np.argsort(shard, kind="stable")
        shard, local, column = shard[order], local[order].astype(np.int32), column[order]
        cuts = np.flatnonzero(np.diff(shard, prepend=shard[0] - 1, append=shard[-1] + 1))
        for i in range(0, len(cuts) - 1, 64):
            spans = list(zip(cuts[i : i + 64], cuts[i + 1 : i + 65]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard[[a for a, _ in spans]]),
                    pa.array([local[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([column[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                names=_names(NUMBERS),
            )

    for batch in batches:
        words = batch.column(0)
        if not len(words):
            continue
        new = np.ones(len(words), bool)
        new[1:] = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
        new[0] = words[0].as_py() != last
        columns = at + np.cumsum(new)
        at, last = int(columns[-1]), words[-1].as_py()
        held.append((batch.column(1).to_numpy(), batch.column(2).to_numpy(), columns))
        if sum(len(h[0]) for h in held) >= FLUSH:
            yield from flush()
    if held:
        yield from flush()


def _renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards with the numbers that hold everywhere, from a stream in which its numbers precede a shard."""
    locals_, columns = [], []
    for batch in batches:
        for i in range(batch.num_rows):
            at = {name: batch.column(name).slice(i, 1) for name in batch.schema.names}
            raw = lambda c: at[c][0].as_buffer()  # noqa: E731,B023
            if not at["cells"][0].is_valid:
                locals_.append(np.frombuffer(raw("locals"), np.int32))
                columns.append(np.frombuffer(raw("columns"), np.int64))
                continue
            numbers = np.zeros(sum(map(len, locals_)), np.int64)
            for own, everywhere in zip(locals_, columns):
                numbers[own] = everywhere
            locals_, columns = [], []
            size = int(np.frombuffer(raw("bounds"), np.int64)[-1])
            cells = np.cumsum(_opened(raw("cells"), size), dtype=np.uint32)
            at["columns"] = pa.array([numbers[cells].tobytes()], pa.binary())
            at["times"] = pa.array([_opened(raw("times"), size).astype(np.int64).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([at[c] for c in _names(MATRIX)], names=_names(MATRIX))


def _numbered(docs: DataFrame, part: str, key: str, text: str) -> DataFrame:
    """The stream that ``_renumber`` reads: for each shard its numbers, then the shard itself."""
    texts = docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).alias("text"),
    )
    shards = durable(texts.mapInArrow(_shards, SHARDS))
    n = partitions(docs.sparkSession)
    seen = shards.select("shard", F.posexplode("words").alias("local", "word")).select("word", "shard", "local")
    numbers = seen.repartition(n, "word").sortWithinPartitions("word").mapInArrow(_number, NUMBERS)
    both = shards.drop("words").unionByName(numbers, allowMissingColumns=True)
    return both.repartition(n, "shard").sortWithinPartitions("shard", F.col("cells").isNotNull())


def document_term_matrix(docs: DataFrame, part: str = "source", key: str = "doc_id",
                         text: str = "text") -> DataFrame:
    """Shards of the matrix of documents and words, in compressed sparse rows.

    ``bounds``, ``columns`` and ``times`` are arrays of 64-bit integers: row i of a shard has the
    cells ``bounds[i]`` to ``bounds[i + 1]``; a column has the same number in all shards. Numbers
    are unique but have gaps. Row i belongs to ``doc_ids[i]``; ``upper``, ``points``, ``symbols``
    and ``digests`` (128 bits) describe its text. Null and empty texts are rows without cells,
    repeated rows are rows of their own, an empty table has no shard.
    """
    return _numbered(docs, part, key, text).mapInArrow(_renumber, MATRIX)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, part, digest, mask) of every document, from shards of the matrix."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            flat = lambda c: row.column(c).flatten()  # noqa: B023,E731
            bounds = np.frombuffer(row.column("bounds")[0].as_buffer(), np.int64)
            times = np.frombuffer(row.column("times")[0].as_buffer(), np.int64)
            n_words = np.diff(np.concatenate([[0], np.cumsum(times)])[bounds])
            distinct = np.diff(bounds)
            upper, points = flat("upper").to_numpy(), flat("points").to_numpy()
            mask = (
                (n_words < 50) + 2 * (100 * distinct < 65 * n_words) + 4 * (100 * upper > 5 * points)
                + 8 * flat("symbols").to_numpy(zero_copy_only=False).astype(np.int64)
            )
            yield pa.RecordBatch.from_arrays(
                [flat("doc_ids"), flat("parts"), flat("digests"), pa.array(mask.astype(np.int32))],
                names=["key", "part", "digest", "mask"],
            )


def failures(docs: DataFrame, labels: DataFrame, part: str = "source", key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """(part, mask, good, toxic, n): documents by the filters they fail, bit 0 for A to 4 for E.

    A document fails E if a smaller key has the same text, told by 128 bits of its hash. All
    documents count as such copies first; those with the least key of their text are then moved
    back, found by text and key together, so a text with any number of copies is no hot key.
    """
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    stream = _numbered(docs, part, key, text)  # the matrix is made and read in one pass
    rows = durable(
        stream.mapInArrow(lambda b: _rows(_renumber(b)), "key long, part string, digest binary, mask int")
        .join(marks, "key", "left")
        .fillna(False, ["good", "toxic"])
    )
    least = rows.groupBy("digest").agg(F.min("key").alias("key")).filter("key IS NOT NULL")
    first = rows.join(least, ["digest", "key"], "left_semi").unionByName(rows.filter("key IS NULL"))
    what = ["part", "mask", "good", "toxic"]
    every = rows.groupBy(*what).agg(F.count("*").alias("n"))
    firsts = first.groupBy(*what).agg(F.count("*").alias("n"))
    copied = F.col("mask").bitwiseOR(16).alias("mask")
    return (
        every.select("part", copied, "good", "toxic", "n")
        .unionByName(firsts.select("part", copied, "good", "toxic", (-F.col("n")).alias("n")))
        .unionByName(firsts)
        .groupBy(*what).agg(F.sum("n").alias("n")).filter("n > 0")
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "source", key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """What every order of the five filters does to every part of the documents.

    Filters fail a document A: under 50 words; B: distinct words below 65 % of words; C: capitals
    A-Z above 5 % of code points; D: any of ``#$%&*|``; E: the text of a smaller key. A row for
    each part, order (120) and step (5), zeros included: documents kept after the step, removed by
    it, redundant (fail it, but are gone), failing it alone, lost with quality 1, lost with
    toxic 1, and removed by its filter summed over all orders.

    Null texts are empty, a null part is the empty one, a null key has no smaller key and no label,
    repeated rows each count and are no copies of each other, a repeated label counts if any row
    has it, other columns are ignored; an empty table gives no row.
    """
    counts = failures(docs, labels, part, key, text)
    steps = [
        {"filter_order": order, "step": i + 1, "own": 1 << FILTERS.index(f),
         "before": sum(1 << FILTERS.index(g) for g in order[:i])}
        for order in ORDERS for i, f in enumerate(order)
    ]
    kind = "array<struct<filter_order:string,step:int,own:int,before:int>>"  # one constant for the optimizer
    every = counts.select("*", F.inline(F.from_json(F.lit(json.dumps(steps)), kind)))
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) > 0, F.col("mask").bitwiseAND(F.col("before")) > 0
    total = lambda when, n=F.col("n"): F.sum(F.when(when, n).otherwise(0)).cast("long")
    return every.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(fails & ~gone & F.col("good")).alias("good_lost"),
        total(fails & ~gone & F.col("toxic")).alias("toxic_lost"),
        # of the orders of its failures, an equal share begins with this one
        total(fails, F.expr(f"n * ({len(ORDERS)} div bit_count(mask))")).alias("shapley"),
    )


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS bad
  FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
  CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END ||
  CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END ||
  CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END ||
  CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END ||
  CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN l USING (doc_id)),
h AS (SELECT part, fails, good, bad, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS own, filter_order[1 : step - 1] AS before
  FROM o, (SELECT unnest(range(1, 6)) AS step)),
m AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, own, fails, good, bad, n,
  contains(fails, own) AS hit, length(translate(fails, before, '')) < length(fails) AS gone FROM h, s),
r AS (SELECT part, filter_order, step, any_value(own) AS own,
  CAST(sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN fails = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN hit AND NOT gone AND good THEN n ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN hit AND NOT gone AND bad THEN n ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM m GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""


@query("op12_filter_audit", SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
