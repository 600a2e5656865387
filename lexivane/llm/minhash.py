"""MinHash near-duplicates with both ends of every permutation.

A text's word shingles are hashed; under each permutation the smallest and the largest value
are kept, so ``PERMUTATIONS`` evaluations give twice as many signature values. Bands of
``BAND_ROWS`` values name buckets. Texts with equal sets are one node from the start. Inside
buckets links are confirmed on full sets, in blocks of bounded size, and only a spanning
forest of the links of a block is written:

1. Every bucket of the first bands: all members against each other where they fit one block,
   else against the bucket's first member. The links give first components.
2. Every bucket of all bands that still holds several components: the members outside its
   largest component against all members, in a grid of blocks.

A link that is not found inside a component changes nothing, so no component is lost that
any shared band could show. Two texts of similarity 0.8 share none of 32 bands of four values
with a probability of 5e-8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.components import connected_components
from ..session import durable
from .common import (
    chain, drop_tables, groups_of, hash_words, mix, partitions, query, slices, table, thrifty, words_of,
)

PERMUTATIONS = 64
BAND_ROWS = 4
BANDS = 2 * PERMUTATIONS // BAND_ROWS
FIRST_BANDS = 8
BLOCK = 256
SALTS = 8
SLICE = 8192
SLICE_BYTES = 1 << 20  # of text that a task takes apart at once

_random = np.random.default_rng(7)
MULTIPLY = _random.integers(1, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text of fewer words than ``size`` has its whole sequence as one shingle; one without
    words, empty or null, has none.
    """
    lens, codes, words = words_of(texts)
    h = hash_words(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    n = len(h) - size + 1
    rolled = chain(*(h[i : n + i] for i in range(size))) if n > 0 else np.zeros(0, np.uint64)
    out, start = [], 0
    for length in lens.tolist():
        if length >= size:
            out.append(np.unique(rolled[start : start + length - size + 1]))
        elif length:
            # a length of its own as first link keeps short sequences apart from full shingles
            whole = chain(*(h[i : i + 1] for i in range(start, start + length)))
            out.append(mix(whole + np.uint64(length)))
        else:
            out.append(np.zeros(0, np.uint64))
        start += length
    return out


def bands_of(shingles: np.ndarray) -> np.ndarray:
    """Bucket keys of one set, one per band."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for i in range(0, len(shingles), 4096):
        v = shingles[i : i + 4096, None] * MULTIPLY + ADD
        v ^= v >> np.uint64(32)
        v *= np.uint64(0xD6E8FEB86659FD93)
        low = np.minimum(low, v.min(0))
        high = np.maximum(high, v.max(0))
    values = np.concatenate([low, high]).reshape(BANDS, BAND_ROWS)
    return chain(np.arange(BANDS, dtype=np.uint64), *values.T)


def signatures(docs: DataFrame, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, node, bands): the node is a 128-bit hash of the set, null if empty."""

    def run(batches):
        for batch in slices(batches, 1, SLICE_BYTES):
            sets = shingle_sets(batch.column(1), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([bands_of(s).view(np.int64) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                [key, "n_shingles", "node", "bands"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        thrifty(run), f"`{key}` {kind}, n_shingles long, node binary, bands array<long>"
    )


def _sets(docs: DataFrame, size: int, key: str, text: str) -> DataFrame:
    def run(batches):
        for batch in slices(batches, 1, SLICE_BYTES):
            sets = shingle_sets(batch.column(1), size)
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())],
                ["node", "shingles"],
            )

    return docs.select(key, text).mapInArrow(thrifty(run), "node binary, shingles binary")


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a few sets."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1
    column, owner = column[often], owner[often]
    out = np.zeros((n, n), np.float64)
    if len(column):
        column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
        cuts = np.searchsorted(column, np.arange(0, column[-1] + SLICE + 1, SLICE))
        for i, j in zip(cuts[:-1], cuts[1:]):
            if j > i:
                part = np.zeros((n, SLICE), np.float32)
                part[owner[i:j], column[i:j] % SLICE] = 1
                out += part @ part.T
    return out.astype(np.int64)


def _forest(names: list[bytes], sets: list[np.ndarray], left: np.ndarray, comp: list, percent: int):
    """Edges of a spanning forest of the links between ``left`` members and all others."""
    shared, size = _shared(sets), np.array([len(s) for s in sets])
    union = size[:, None] + size[None, :] - shared
    linked = 100 * shared >= percent * union
    top = {c: c for c in comp}

    def root(c):
        while top[c] != c:
            top[c] = top[top[c]]
            c = top[c]
        return c

    for i in np.flatnonzero(left).tolist():
        for j in np.flatnonzero(linked[i]).tolist():
            if j != i and (a := root(comp[i])) != (b := root(comp[j])):
                top[a] = b
                yield names[i], names[j]


def _blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(src, dst) links from rows (bucket, block, node, comp, first), compared block by block."""

    def run(batches):
        for group in groups_of(batches, ["bucket", "block"]):
            seen: dict[bytes, list] = {}
            for node, comp, first, blob in zip(*(group.column(c).to_pylist() for c in ("node", "comp", "first", "shingles"))):
                seen.setdefault(node, [comp, False, blob])[1] |= first
            if len(seen) < 2:
                continue
            names = list(seen)
            edges = list(_forest(
                names, [np.frombuffer(seen[n][2], np.uint64) for n in names],
                np.array([seen[n][1] for n in names]), [seen[n][0] for n in names], percent,
            ))
            if edges:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([e[k] for e in edges], pa.binary()) for k in (0, 1)], ["src", "dst"]
                )

    spark = members.sparkSession
    laid = members.join(sets, "node").repartition(partitions(spark), "bucket", "block")
    return laid.sortWithinPartitions("bucket", "block").mapInArrow(thrifty(run), "src binary, dst binary")


def _met(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of buckets with what ``groups`` knows of them; hot buckets are dealt over salts."""
    each = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(
        each, ["bucket", "_salt"]
    ).drop("_salt")


def _one_of_each(groups: DataFrame) -> DataFrame:
    """One bucket of those with the same members."""
    return groups.groupBy("n", "same").agg(
        F.min_by(F.struct(*[c for c in groups.columns if c not in ("n", "same")]), "bucket").alias("g")
    ).select("n", "g.*")


def _first_links(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    groups = durable(_one_of_each(
        rows.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("node").alias("lead"), F.bit_xor(F.xxhash64("node")).alias("same"))
        .filter("n > 1")
    ).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")))
    small = F.col("blocks") == 1
    inside = _met(rows, groups).select(
        "bucket",
        F.pmod(F.xxhash64("node", F.lit(1)), "blocks").cast("int").alias("block"),
        "node",
        F.col("node").alias("comp"),
        small.alias("first"),
    )
    leads = groups.filter(~small).select(
        "bucket",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.col("lead").alias("node"),
        F.col("lead").alias("comp"),
        F.lit(True).alias("first"),
    )
    return _blocks(inside.unionByName(leads), sets, percent)


def _later_links(rows: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    known = durable(
        rows.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("comp"))
    )
    parts = known.groupBy("bucket", "comp").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("node")).alias("x")
    )
    groups = durable(_one_of_each(
        parts.groupBy("bucket").agg(
            F.count("*").alias("parts"), F.sum("c").alias("n"), F.bit_xor("x").alias("same"),
            F.max(F.struct("c", "comp")).alias("most"),
        ).filter("parts > 1")
    ).select(
        "bucket",
        F.col("most.comp").alias("main"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("across"),
        F.ceil((F.col("n") - F.col("most.c")) / BLOCK).cast("int").alias("down"),
    ))
    met = _met(known, groups)
    a = F.pmod(F.xxhash64("node", F.lit(1)), "across").cast("int")
    d = F.pmod(F.xxhash64("node", F.lit(2)), "down").cast("int")
    every = met.select(
        "bucket", F.explode(F.transform(F.sequence(F.lit(0), F.col("down") - 1), lambda k: k * F.col("across") + a)).alias("block"),
        "node", "comp", F.lit(False).alias("first"),
    )
    outside = met.filter("comp != main").select(
        "bucket", F.explode(F.transform(F.sequence(F.lit(0), F.col("across") - 1), lambda k: d * F.col("across") + k)).alias("block"),
        "node", "comp", F.lit(True).alias("first"),
    )
    return _blocks(every.unionByName(outside), sets, percent)


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``.

    Texts link if the sizes of their shared and joint shingle sets are in a ratio of at least
    ``percent`` in 100. ``component_id`` is the smallest key reachable by links. Texts without
    words link with nothing; rows with a null key link with nothing, have a null component and
    are kept; rows that repeat a key repeat its result (with different texts, each has its
    own component). Other columns are ignored.
    """
    signed = durable(signatures(docs, shingle, key, text))
    nodes = durable(
        signed.filter(F.col("node").isNotNull() & F.col(key).isNotNull())
        .groupBy("node").agg(F.min(key).alias("rep"), F.first("bands").alias("bands"))
    )
    buckets = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    multi = durable(
        buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    )
    rows = durable(_met(buckets, multi).select("bucket", "band", "node"))
    asked = nodes.join(rows.select("node").distinct(), "node", "left_semi").select(F.col("rep").alias(key))
    sets = durable(_sets(docs.select(key, text).join(asked.distinct(), key, "left_semi"), shingle, key, text))
    first = durable(_first_links(rows.filter(F.col("band") < FIRST_BANDS).select("bucket", "node"), sets, percent))
    labels = connected_components(first)
    later = durable(_later_links(rows.select("bucket", "node"), labels, sets, percent))
    if not later.isEmpty():
        labels = connected_components(first.unionByName(later))
    grouped = nodes.join(labels, "node", "left").select(
        "node", "rep", F.coalesce("component", "node").alias("component")
    )
    least = durable(grouped.groupBy(F.col("component").alias("node")).agg(F.min("rep").alias("target")))
    named = durable(_named(grouped, least))
    drop_tables(docs.sparkSession, sets, rows, multi)
    # rows of one set may be many: deal them over salts
    each = named.select(
        "node", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    )
    out = signed.drop("bands").withColumn(
        "_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")
    ).join(each, ["node", "_salt"], "left")
    component = F.when(F.col(key).isNotNull(), F.coalesce("component_id", key))
    return out.select(
        key, "n_shingles", component.alias("component_id"),
        F.coalesce(F.col(key) == component, F.lit(True)).alias("kept"),
    )


def _named(grouped: DataFrame, least: DataFrame) -> DataFrame:
    """Every node with the smallest key of its component."""
    each = least.select(
        F.col("node").alias("component"), F.col("target").alias("component_id"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
    )
    return grouped.withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(
        each, ["component", "_salt"]
    ).select("node", "component_id")


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, unchanged, but for one row for each group of near-duplicates.

    The row with the smallest id stays, in all its repetitions. Rows without an id or without
    words are all kept.
    """
    kept = near_duplicates(docs, shingle, percent).filter("kept AND doc_id IS NOT NULL")
    some = docs.filter("doc_id IS NOT NULL").join(kept.select("doc_id").distinct(), "doc_id", "left_semi")
    return some.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(t) >= 4 THEN [array_to_string(t[i : i + 3], ' ') FOR i IN range(1, len(t) - 2)]
  WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END) AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM e a JOIN e b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
  WHERE 100 * met >= 80 * (na.n_shingles + nb.n_shingles - met)),
r AS (SELECT doc_id AS d, doc_id AS reach FROM w UNION SELECT d, b FROM r JOIN l ON reach = a)
SELECT doc_id, n_shingles, min(reach) AS component_id, doc_id = min(reach) AS kept
FROM n JOIN r ON d = doc_id GROUP BY doc_id, n_shingles"""


@query("op9_minhash", SQL)
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)
