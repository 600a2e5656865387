"""Exact top-k search by integer inner product, block at a time.

Every component is a term of either sign. Vectors are sorted by their strongest term and cut into
segments, and segments into blocks of neighbouring ranges. A block keeps the largest and smallest
weight of each term; summed over the terms of a query these bound every score of the block. A
query takes blocks in the order of their bounds, scores them through the block's forward index
(its rows, in the narrowest integer type) and stops when no bound reaches its k-th score.

Each query starts in its own segment, which gives it a first k-th score. The same bounds, kept for
whole segments, then tell which other segments it has to visit at all. Queries travel in packed
batches, some batches are a lot, and a group of segments passes by each lot that needs one of them:
a task holds the queries of one lot with what they found, and one segment. A query is sent once for
each group of segments, a segment once for each lot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import durable
from .common import groups_of, partitions, query, small_batches, table, thrifty

BLOCK = 64
SEGMENT_ROWS = 8192
SEGMENT_BYTES = 8 << 20
BATCH = 1024
LOT = 16  # batches of queries that segments pass by in one task
LOT_BYTES = 16 << 20  # of their weights in 64 bits
ROW_BYTES = 1 << 19  # of the weights of a packed row, at least one query
GROUP = 16  # segments that pass by in one task
TILE = 512  # queries scored at once
RUN = 64  # blocks scored at once, at most
EXACT, EXACT_SINGLE = 1 << 53, 1 << 24

INDEX = (
    "segment long, n long, width long, ids binary, weights binary, weight_type string, "
    "high binary, low binary, most array<long>, least array<long>"
)
FOUND = "query_id long, vec_id long, score long"


def weights(vectors: pa.Array, scale: float = 64.0) -> np.ndarray:
    """floor(scale * x) as integers, a row for each vector, short ones filled up with zeros.

    Values beyond 64 bits are the largest or smallest 64-bit integer.
    """
    lens = np.diff(np.asarray(vectors.offsets))
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.floor(flat * scale)
    whole = np.clip(scaled, -(2.0**62), 2.0**62).astype(np.int64)
    whole[scaled >= 2.0**62] = np.iinfo(np.int64).max
    whole[scaled < -(2.0**62)] = np.iinfo(np.int64).min + 1
    out = np.zeros((len(lens), int(lens.max()) if len(lens) else 0), np.int64)
    out[np.arange(out.shape[1]) < lens[:, None]] = whole
    return out


def _magnitude(m: np.ndarray) -> int:
    return max(int(m.max()), -int(m.min())) if m.size else 0


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times the transpose of b, exact whole numbers: in floating point, else in as wide integers as it takes."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = _magnitude(a) * _magnitude(b) * max(width, 1)
    if most < EXACT:
        kind = np.float32 if most < EXACT_SINGLE else np.float64
        return a.astype(kind) @ b.astype(kind).T
    if most < 1 << 62:
        a, b = a.astype(np.int64), b.astype(np.int64)
        return a @ b.T
    limits = np.iinfo(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, limits.min, limits.max).astype(np.int64)


def bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The most that any row between ``low`` and ``high`` can score, per query and row of these."""
    width = min(q.shape[1], high.shape[1])
    q, high, low = q[:, :width], high[:, :width], low[:, :width]
    both = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1)
    return product(both, np.concatenate([high, low], axis=1)).astype(np.int64)


def _narrow(m: np.ndarray) -> np.ndarray:
    low, high = (int(m.min()), int(m.max())) if m.size else (0, 0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return m.astype(kind)
    return m


def _segments(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """Segments of (vec_id, vector) in the order in which rows come, their blocks and extremes."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, SEGMENT_ROWS)
            width = int(np.diff(np.asarray(part.column(1).offsets)).max())
            part = part.slice(0, max(BLOCK, SEGMENT_BYTES // (8 * max(width, 1))))
            at += part.num_rows
            ids = part.column(0).to_numpy()
            m = weights(part.column(1), scale)
            strong = np.argsort(-np.abs(m), axis=1, kind="stable")[:, :2]
            lead = [s * 2 + (np.take_along_axis(m, strong[:, [j]], 1)[:, 0] < 0)
                    for j, s in enumerate(strong.T)]
            order = np.lexsort([ids, *reversed(lead)])
            ids, m = ids[order], m[order]
            starts = np.arange(0, len(ids), BLOCK)
            high, low = np.maximum.reduceat(m, starts), np.minimum.reduceat(m, starts)
            small = _narrow(m)
            row = [
                number, len(ids), m.shape[1], ids.tobytes(), small.tobytes(), small.dtype.str,
                high.tobytes(), low.tobytes(), high.max(0).tolist(), low.min(0).tolist(),
            ]
            kinds = [pa.int64()] * 3 + [pa.binary()] * 2 + [pa.string()] + [pa.binary()] * 2 + [
                pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, kinds)],
                names=[c.split(" ")[0] for c in INDEX.split(", ")],
            )
            number += 1


class Segment:
    """One row of the index, ready for searching."""

    def __init__(self, row: dict):
        n, width, blocks = row["n"], row["width"], -(-row["n"] // BLOCK)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.rows = np.frombuffer(row["weights"], row["weight_type"]).reshape(n, width)
        self.high = np.frombuffer(row["high"], np.int64).reshape(blocks, width)
        self.low = np.frombuffer(row["low"], np.int64).reshape(blocks, width)
        self.most, self.least = self.high.max(0, keepdims=True), self.low.min(0, keepdims=True)
        self.first = np.minimum.reduceat(self.ids, np.arange(0, n, BLOCK))


NONE, LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Search:
    """Queries with the k best of each one among the segments that it saw.

    Only what ranks before ``score`` with id ``vec`` counts: the k-th found elsewhere.
    """

    def __init__(self, q: np.ndarray, own: np.ndarray, k: int, score: np.ndarray, vec: np.ndarray):
        self.q, self.own, self.k = q, own, k
        self.kth, self.kth_id = score.copy(), vec.copy()
        self.n = np.zeros(len(q), np.int64)
        self.ids, self.scores = np.zeros((len(q), k), np.int64), np.zeros((len(q), k), np.int64)

    def see(self, seg: Segment, who: np.ndarray) -> None:
        """Compare a segment with the queries ``who``, by blocks in the order of their bounds."""
        for i in range(0, len(who), TILE):
            at = who[i : i + TILE]
            at = at[bounds(self.q[at], seg.most, seg.least)[:, 0] >= self.kth[at]]
            if not len(at):
                continue
            bound = bounds(self.q[at], seg.high, seg.low)
            order = np.argsort(~bound.max(0), kind="stable")  # descending, without overflow
            done, step = 0, 4
            while done < len(order):
                blocks = order[done : done + step]
                done, step = done + step, min(2 * step, RUN)
                b, kth = bound[:, blocks], self.kth[at][:, None]
                need = (b > kth) | ((b == kth) & (seg.first[blocks] < self.kth_id[at][:, None]))
                if need.any():
                    rows = (blocks[need.any(0)][:, None] * BLOCK + np.arange(BLOCK)).ravel()
                    self._score(at[need.any(1)], seg, rows[rows < len(seg.ids)])

    def _score(self, at: np.ndarray, seg: Segment, rows: np.ndarray) -> None:
        score = product(self.q[at], seg.rows[rows])
        # rounding keeps the order, and all scores are exact: nothing is missed by a rounded k-th
        row, col = np.nonzero(score >= self.kth[at].astype(score.dtype)[:, None])
        score, ids = score[row, col].astype(np.int64), seg.ids[rows[col]]
        kth = self.kth[at][row]
        better = ((score > kth) | ((score == kth) & (ids < self.kth_id[at][row]))) & (ids != self.own[at][row])
        some, row = np.unique(row[better], return_inverse=True)
        who = at[some]
        held = np.arange(self.k) < self.n[who][:, None]
        row = np.concatenate([np.nonzero(held)[0], row])
        score = np.concatenate([self.scores[who][held], score[better]])
        ids = np.concatenate([self.ids[who][held], ids[better]])
        order = np.lexsort([ids, ~score, row])
        rank = np.arange(len(row)) - np.searchsorted(row[order], np.arange(len(who)))[row[order]]
        order, rank = order[rank < self.k], rank[rank < self.k]
        self.ids[who[row[order]], rank], self.scores[who[row[order]], rank] = ids[order], score[order]
        self.n[who] = np.bincount(row[order], minlength=len(who))
        full = who[self.n[who] == self.k]
        self.kth[full], self.kth_id[full] = self.scores[full, -1], self.ids[full, -1]

    def held(self) -> np.ndarray:
        return np.arange(self.k) < self.n[:, None]


def _at_home(batches: Iterator[pa.RecordBatch], every: int, k: int) -> Iterator[pa.RecordBatch]:
    """Each query of a segment with its k best there: (query_id, weights, ids, scores, segment)."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            seg = Segment(row)
            mine = np.flatnonzero(seg.ids % every == 0)
            for i in range(0, len(mine), BATCH):
                rows = mine[i : i + BATCH]
                own, q = seg.ids[rows], seg.rows[rows].astype(np.int64)
                search = Search(q, own, k, np.full(len(rows), NONE), np.full(len(rows), LAST))
                search.see(seg, np.arange(len(rows)))
                cuts, held = pa.array(np.concatenate([[0], np.cumsum(search.n)]).astype(np.int32)), search.held()
                lists = lambda v: pa.ListArray.from_arrays(cuts, pa.array(v[held]))  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own), pa.array(list(q), pa.list_(pa.int64())), lists(search.ids),
                        lists(search.scores), pa.array(np.full(len(rows), row["segment"])),
                    ],
                    names=["query_id", "weights", "ids", "scores", "home"],
                )


HOME = "query_id long, weights array<long>, ids array<long>, scores array<long>, home long"
PACKED = "batch long, lot long, asked long, q_width long, q_type string, own binary, q binary, home binary, score binary, vec binary"
ASKED = "lot long, segment long"


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of lists, short ones filled up with zeros."""
    lens = np.diff(np.asarray(lists.offsets))
    out = np.zeros((len(lens), int(lens.max()) if len(lens) else 0), np.int64)
    out[np.arange(out.shape[1]) < lens[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _packed(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows of many queries each, of one batch: their ids, weights, own segments and k-th scores."""
    for held in groups_of(batches, ["batch"]):
        get = lambda c: held[c].combine_chunks()  # noqa: E731,B023
        q, full = _matrix(get("weights")), np.diff(np.asarray(get("ids").offsets)) >= k
        own, home, batch, lot = (get(c).to_numpy() for c in ("query_id", "home", "batch", "lot"))
        score, vec = np.full(len(q), NONE), np.full(len(q), LAST)
        # the k-th of lists that are k long
        score[full], vec[full] = (_matrix(get(c).filter(pa.array(full)))[:, k - 1] if full.any() else [] for c in ("scores", "ids"))
        step = max(1, min(BATCH, ROW_BYTES // (8 * max(q.shape[1], 1))))
        for i in range(0, len(q), step):
            small, part = _narrow(q[i : i + step]), slice(i, i + step)
            row = [batch[0], lot[0], len(small), q.shape[1], small.dtype.str, *(
                v.tobytes() for v in (own[part], small, home[part], score[part], vec[part])
            )]
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, kinds)], names=[c.split(" ")[0] for c in PACKED.split(", ")]
            )


def _queries(row: dict) -> tuple[np.ndarray, ...]:
    """(weights, ids, own segments, k-th scores, their ids) of a packed row."""
    q = np.frombuffer(row["q"], row["q_type"]).reshape(row["asked"], row["q_width"]).astype(np.int64)
    return q, *(np.frombuffer(row[c], np.int64) for c in ("own", "home", "score", "vec"))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments that a packed row of queries must visit, among those that it meets."""
    for batch in batches:
        for i in range(batch.num_rows):
            part = batch.slice(i, 1)
            row, segments = part.drop_columns(["segments"]).to_pylist()[0], part.column("segments").flatten()
            q, _, home, score, _ = _queries(row)
            ids = segments.field("segment").to_numpy()
            reach = bounds(q, _matrix(segments.field("most")), _matrix(segments.field("least")))
            go = ids[((reach >= score[:, None]) & (home[:, None] != ids)).any(0)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(go), row["lot"])), pa.array(go)], names=["lot", "segment"])


def _visit(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Scores of a stream in which the queries of a task are followed by the segments that pass by."""

    def found(now: Search) -> pa.RecordBatch:
        held = now.held()
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(now.own, now.n)), pa.array(now.ids[held]), pa.array(now.scores[held])],
            names=["query_id", "vec_id", "score"],
        )

    task, waiting, now, home = None, [], None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["task"] != task:
                if now is not None:
                    yield found(now)
                task, waiting, now = row["task"], [], None
            if row["own"] is not None:
                waiting.append(_queries(row))
                continue
            if now is None:
                width = max(x[0].shape[1] for x in waiting)
                q = np.concatenate([np.pad(x[0], ((0, 0), (0, width - x[0].shape[1]))) for x in waiting])
                own, home, score, vec = (np.concatenate(c) for c in list(zip(*waiting))[1:])
                now, waiting = Search(q, own, k, score, vec), []
            now.see(Segment(row), np.flatnonzero(home != row["segment"]))
    if now is not None:
        yield found(now)


def index(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """Segments of the usable rows: ids, forward index, extremes of each block and of the whole.

    Rows are ranged by the position and sign of their largest component, then by id, so that one
    component that a third of all rows share is still cut evenly. Rows whose id or vector is null,
    or that hold a null, NaN or infinity, are left out. An empty vector is all zeros.
    """
    v = F.col(vector)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(key).isNotNull() & v.isNotNull() & whole).select(
        F.col(key).cast("long").alias("id"), v.cast("array<double>").alias("v")
    )
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    lead = F.coalesce(F.array_position(F.transform("v", lambda x: F.abs(x)), largest), F.lit(0))
    sign = F.when(lead > 0, F.signum(F.get("v", (lead - 1).cast("int")))).otherwise(0.0)
    n = partitions(vectors.sparkSession)
    ranged = rows.withColumn("lead", lead.cast("double") * 2 + sign / 2).repartitionByRange(n, "lead", "id")
    return durable(ranged.sortWithinPartitions("lead", "id").select("id", "v").mapInArrow(
        lambda b: _segments(b, scale), INDEX
    ))


def _away(segments: DataFrame, start: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): what can be among the k best of a query outside its own segment."""
    n = partitions(segments.sparkSession)
    many, width = segments.agg(F.count("*"), F.coalesce(F.max("width"), F.lit(0))).first()
    batches = max(1, -(-start.count() // BATCH))
    per_lot = max(1, min(LOT, LOT_BYTES // (8 * max(width, 1) * BATCH)))
    lots = -(-batches // per_lot)
    groups = max(1, -(-many // GROUP), min(many, -(-n // lots)))
    batch = F.pmod(F.xxhash64("query_id"), F.lit(batches))
    with small_batches(segments.sparkSession):
        packed = durable(
            start.withColumn("batch", batch).withColumn("lot", F.floor(F.col("batch") / per_lot))
            .repartition(n, "batch").sortWithinPartitions("batch").mapInArrow(lambda b: _packed(b, k), PACKED)
        )
        # each batch meets the extremes of all segments, a thousand or so at a time
        chunks = max(1, -(-many // 1024))
        known = segments.select(
            F.pmod(F.xxhash64("segment"), F.lit(chunks)).cast("int").alias("chunk"), "segment", "most", "least"
        ).groupBy("chunk").agg(F.collect_list(F.struct("segment", "most", "least")).alias("segments"))
        meeting = packed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).join(known, "chunk")
        asked = durable(meeting.repartition(n, "batch", "chunk").drop("chunk").mapInArrow(_asked, ASKED))
        group = F.pmod(F.xxhash64("segment"), F.lit(groups))
        places = asked.distinct().withColumn("task", (F.col("lot") * groups + group).cast("int"))
        passing = segments.drop("most", "least").join(places.drop("lot"), "segment")
        waiting = packed.drop("batch").join(places.select("lot", "task").distinct(), "lot").drop("lot")
        stream = passing.unionByName(waiting, allowMissingColumns=True).repartitionById(lots * groups, "task")
        return durable(
            stream.sortWithinPartitions("task", F.col("own").isNull(), "segment")
            .mapInArrow(thrifty(lambda b: _visit(b, k)), FOUND)
        )


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, key: str = "vec_id",
          vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query, exact.

    Queries are the rows whose id ``every`` divides, candidates all rows of another id. Components
    count as floor(scale * x); missing ones of a shorter vector count as zero; scores beyond 64
    bits are the largest or smallest 64-bit integer. Equal scores are ordered by id. Unusable rows
    (see ``index``) take no part. A repeated id is a candidate in each of its rows, and a query in
    the one with the least components. Other columns are ignored, an empty table gives no row, a
    query without other rows has none.
    """
    segments = index(vectors, key, vector, scale)
    one = Window.partitionBy("query_id").orderBy("weights", "home")
    start = durable(
        segments.mapInArrow(lambda b: _at_home(b, every, k), HOME)
        .withColumn("copy", F.row_number().over(one)).filter("copy = 1").drop("copy")
    )
    away = _away(segments, start, k)
    home = start.select("query_id", F.inline(F.arrays_zip(F.col("ids").alias("vec_id"), F.col("scores").alias("score"))))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return home.unionByName(away).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""


@query("op13_topk", SQL)
def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))
