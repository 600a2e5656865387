"""Exact nearest neighbours and radius graphs over vectors.

A base that fits a checked budget is sent to every task. Beyond that, vectors go to the
cell of their nearest pivot; the triangle inequality says which cells can still hold a
neighbour, and only those are visited. Queries of cells that lie near each other form blocks of
bounded size, and the cells that a block still needs pass by it in a stream, so no task sees
an unbounded group and nothing is written for each query and cell. Equal vectors are
computed once and expanded at the end from their smallest ids, which is exact. Tasks keep
k results per query, never all pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.vector import vector_problem
from ..session import durable

BROADCAST_BYTES = 32 << 20
CHUNK_ROWS = 1024
BLOCK_CHUNKS = 16  # chunks of queries that a task holds
TIE_DIGITS = 9
SLACK = 1e-9


@dataclass(frozen=True)
class Metric:
    """``distance`` is what callers see; ``chord`` obeys the triangle inequality."""

    name: str = "cosine"

    def prepare(self, vectors) -> np.ndarray:
        m = np.array(list(vectors), dtype=np.float64)
        if self.name == "cosine":
            m /= np.linalg.norm(m, axis=1, keepdims=True)
        return m

    def distances(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.name == "cosine":
            d = 1.0 - a @ b.T
        else:
            square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
            d = np.sqrt(np.maximum(square, 0.0))
        return np.round(d, TIE_DIGITS)

    def chord(self, d):
        """Upper bound of the chord for a rounded distance."""
        if self.name == "cosine":
            return np.sqrt(np.maximum(2.0 * (d + SLACK), 0.0))
        return d + SLACK

    def slack(self, vectors: np.ndarray) -> np.ndarray:
        """Most a chord can be off through rounding, per row."""
        if self.name == "cosine":
            return np.full(len(vectors), np.sqrt(4 * SLACK))
        return 1e-6 * (1.0 + np.linalg.norm(vectors, axis=1))


def metric_of(name: str) -> Metric:
    if name not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric {name!r}")
    return Metric(name)


def problem(vector: str, metric: Metric, dimension: int) -> Column:
    """Why a vector cannot be compared, or null; a zero vector has no direction, but a place."""
    vec = F.col(vector)
    infinite = F.exists(vec, lambda x: F.abs(x) == float("inf"))
    found = F.coalesce(vector_problem(vector, dimension), F.when(infinite, "infinite"))
    return found if metric.name == "cosine" else F.when(found != "zero", found)


def usual_dimension(df: DataFrame, vector: str) -> int:
    """The dimension that most vectors have, the smaller one of equals; 0 without vectors."""
    sizes = df.select(F.size(vector).alias("d")).filter("d > 0").groupBy("d").agg(F.count("*").alias("n"))
    found = sizes.agg(F.max_by("d", F.struct("n", -F.col("d")))).first()[0]
    return found or 0


def clean(df: DataFrame, key: str, vector: str, metric: Metric, dimension: int | None = None) -> DataFrame:
    """Rows with a usable vector of the given or else the usual dimension, as (id, vec)."""
    dimension = dimension or usual_dimension(df, vector)
    return df.filter(problem(vector, metric, dimension).isNull()).select(
        F.col(key).alias("id"), F.col(vector).alias("vec")
    )


def rejected(
    df: DataFrame, key: str = "doc_id", vector: str = "embedding", metric: str = "cosine",
    dimension: int | None = None,
) -> DataFrame:
    """(key, reason) of the rows that a search leaves out."""
    dimension = dimension or usual_dimension(df, vector)
    return df.select(key, problem(vector, metric_of(metric), dimension).alias("reason")).filter(
        "reason IS NOT NULL"
    )


def fits(df: DataFrame, budget: int) -> bool:
    """Whether the (id, vec) rows are within a byte budget, read off at most budget / 8 rows."""
    head = df.select(F.size("vec").alias("d")).limit(1).first()
    if head is None:
        return True
    most = budget // (8 * (head["d"] + 2))
    return most > 0 and df.limit(int(most) + 1).count() <= most


def distinct_vectors(df: DataFrame, keep: int | None) -> DataFrame:
    """One row per distinct vector: ``uid`` its smallest id, ``ids`` its ``keep`` smallest ids."""
    same = Window.partitionBy("h", "vec").orderBy("id")
    ranked = df.withColumn("h", F.xxhash64("vec")).withColumn("r", F.row_number().over(same))
    # the rank limit is applied before the shuffle, so a mass of copies does not travel
    firsts = ranked.filter(F.col("r") <= (keep or 1))
    return firsts.groupBy("h", "vec").agg(
        F.min("id").alias("uid"), F.array_sort(F.collect_list("id")).alias("ids")
    ).select("uid", "vec", "ids")


def members(df: DataFrame, units: DataFrame) -> DataFrame:
    """(id, uid) for every row, through its vector."""
    left = df.withColumn("h", F.xxhash64("vec"))
    right = units.select("uid", "vec", F.xxhash64("vec").alias("h"))
    return left.join(right, ["h", "vec"]).select("id", "uid")


def _top(d: np.ndarray, k: int) -> np.ndarray:
    """Column positions of the k smallest per row; equal values keep column order."""
    if d.shape[1] <= max(4 * k, 256):
        return np.argsort(d, axis=1, kind="stable")[:, :k]
    limit = np.partition(d, k - 1, axis=1)[:, k - 1]
    out = np.empty((len(d), k), dtype=np.int64)
    for i, row in enumerate(d):
        near = np.flatnonzero(row <= limit[i])
        out[i] = near[np.argsort(row[near], kind="stable")[:k]]
    return out


def _best(query_ids, q, base_ids, b, k, metric) -> pd.DataFrame:
    """k best per query; base rows must come in id order."""
    out = []
    step = max(1, (4 << 20) // max(1, len(base_ids)))
    for i in range(0, len(q), step):
        d = metric.distances(q[i : i + step], b)
        top = _top(d, k)
        n = top.shape[1]
        out.append(
            pd.DataFrame(
                {
                    "qid": np.repeat(query_ids[i : i + step], n),
                    "bid": base_ids[top].ravel(),
                    "distance": np.take_along_axis(d, top, axis=1).ravel(),
                }
            )
        )
    return pd.concat(out) if out else pd.DataFrame(columns=["qid", "bid", "distance"])


def _keep_best(rows: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("qid").orderBy("distance", "bid")
    return rows.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).drop("r")


def _id_type(df: DataFrame) -> str:
    return df.schema["id"].dataType.simpleString()


# --- the base fits a broadcast -------------------------------------------------------


def _broadcast_search(
    queries: DataFrame, base: DataFrame, k: int, metric: Metric, exclude_self: bool
) -> DataFrame:
    spark = queries.sparkSession
    rows = sorted(base.collect())
    if not rows:
        return spark.createDataFrame([], _result_schema(queries, base))
    ids = np.array([r["id"] for r in rows])
    shared = spark.sparkContext.broadcast((ids, metric.prepare([r["vec"] for r in rows])))
    want = k + 1 if exclude_self else k

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base_ids, b = shared.value
        for pdf in batches:
            if len(pdf):
                found = _best(
                    pdf["id"].to_numpy(), metric.prepare(pdf["vec"]), base_ids, b, want, metric
                )
                if exclude_self:
                    found = found[found["qid"] != found["bid"]]
                    found = found[found.groupby("qid").cumcount() < k]
                yield found

    return queries.mapInPandas(search, _result_schema(queries, base))


def _result_schema(queries: DataFrame, base: DataFrame) -> str:
    return f"qid {_id_type(queries)}, bid {_id_type(base)}, distance double"


# --- pivots, cells and visits --------------------------------------------------------


@dataclass
class Cells:
    """Base vectors by cell and chunk, with what the visiting rule needs of every cell."""

    base: DataFrame  # uid, vec, cell, chunk
    pivots: np.ndarray
    near: np.ndarray  # smallest chord from the pivot within the cell
    far: np.ndarray  # largest chord from the pivot within the cell
    chunks: np.ndarray  # chunks of the cell


def _assign(units: DataFrame, pivots: np.ndarray, metric: Metric, k: int) -> DataFrame:
    """Add the nearest pivot, the chord to it, and a first bound from the k-th nearest pivot."""
    shared = units.sparkSession.sparkContext.broadcast(pivots)
    uid = units.schema["uid"].dataType.simpleString()
    vec = units.schema["vec"].dataType.simpleString()

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = shared.value
        for pdf in batches:
            if len(pdf):
                c = metric.chord(metric.distances(metric.prepare(pdf["vec"]), p))
                bound = np.sort(c, axis=1)[:, k - 1] if c.shape[1] >= k else np.inf
                yield pdf.assign(cell=c.argmin(1), chord=c.min(1), bound=bound)

    return units.mapInPandas(
        assign, f"uid {uid}, vec {vec}, cell bigint, chord double, bound double"
    )


def build_cells(units: DataFrame, metric: Metric, k: int, chunk_rows: int) -> Cells:
    """Pivots drawn by hash, and every distinct base vector in the cell of its nearest pivot."""
    n = units.count()
    dim = units.select(F.size("vec")).first()[0]
    limit = max(1, min(BROADCAST_BYTES // (8 * dim), int(np.ceil(np.sqrt(n)))))
    drawn = units.select("uid", "vec").orderBy(F.xxhash64("uid"), "uid").limit(limit).collect()
    pivots = metric.prepare([r["vec"] for r in drawn])
    assigned = durable(_assign(units.select("uid", "vec"), pivots, metric, k))
    stats = assigned.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("chord").alias("near"), F.max("chord").alias("far")
    ).collect()
    near, far = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf)
    chunks = np.zeros(len(pivots), dtype=np.int64)
    for r in stats:
        near[r["cell"]], far[r["cell"]] = r["near"], r["far"]
        chunks[r["cell"]] = -(-r["n"] // chunk_rows)
    base = with_chunk(assigned, chunks)
    return Cells(base, pivots, near, far, chunks)


def with_chunk(assigned: DataFrame, chunks: np.ndarray) -> DataFrame:
    """A chunk of its cell for every row, by the hash of its id."""
    table = assigned.sparkSession.createDataFrame(
        [(i, int(max(c, 1))) for i, c in enumerate(chunks)], "cell bigint, n_chunks bigint"
    )
    return assigned.join(table, "cell").withColumn(
        "chunk", F.pmod(F.xxhash64("uid"), "n_chunks")
    ).drop("n_chunks")


def visits(queries: DataFrame, cells: Cells, metric: Metric, skip_own: bool) -> DataFrame:
    """(uid, cell, chunk) that every query (uid, vec, bound, cell, chunk) has to visit.

    A cell is out when even its nearest possible member lies beyond the bound.
    """
    shared = queries.sparkSession.sparkContext.broadcast(
        (cells.pivots, cells.near, cells.far, cells.chunks)
    )
    step = int(max(1, min(1024, 2_000_000 // max(1, cells.chunks.sum()))))
    uid_type = queries.schema["uid"].dataType.simpleString()

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, near, far, chunks = shared.value
        for batch in batches:
            for i in range(0, len(batch), step):
                pdf = batch.iloc[i : i + step]
                q = metric.prepare(pdf["vec"])
                c = metric.chord(metric.distances(q, pivots))
                low = np.maximum(c - far, near - c) - metric.slack(q)[:, None]
                # written so that a bound that cannot be compared rules nothing out
                row, cell = np.nonzero(~(low > pdf["bound"].to_numpy()[:, None]))
                count = chunks[cell]
                start = np.repeat(np.cumsum(count) - count, count)
                row, cell = np.repeat(row, count), np.repeat(cell, count)
                chunk = np.arange(len(row)) - start
                out = pd.DataFrame(
                    {"uid": pdf["uid"].to_numpy()[row], "cell": cell, "chunk": chunk}
                )
                if skip_own:
                    own_cell, own_chunk = pdf["cell"].to_numpy(), pdf["chunk"].to_numpy()
                    out = out[(cell != own_cell[row]) | (chunk != own_chunk[row])]
                yield out

    return queries.select("uid", "vec", "bound", "cell", "chunk").mapInPandas(
        visit, f"uid {uid_type}, cell bigint, chunk bigint"
    )


def meet(
    queries: DataFrame, visiting: DataFrame, cells: Cells, fn, schema: str, chunk_rows: int,
    carry: tuple[str, ...] = ("uid", "vec"),
) -> DataFrame:
    """Run ``fn(queries, base)`` for every visited chunk, at most ~chunk_rows rows a side.

    ``queries`` is (uid, vec), ``visiting`` (uid, cell, chunk); ``carry`` names the columns that
    both sides bring. Where many queries visit a chunk they are split by hash and the chunk is
    copied to each part.
    """
    parts = visiting.groupBy("cell", "chunk").agg(
        F.ceil(F.count("*") / chunk_rows).cast("bigint").alias("parts")
    )
    left = (
        visiting.join(parts, ["cell", "chunk"])
        .withColumn("part", F.pmod(F.xxhash64("uid"), "parts"))
        .join(queries.select(*carry), "uid")
        .select(*carry, "cell", "chunk", "part")
    )
    # renamed for the cogroup: both sides may come from the same table
    held = cells.base.join(parts, ["cell", "chunk"])
    right = held.select(
        *[F.col(c).alias(c) for c in (*carry, "cell", "chunk")],
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
    )
    keys = ["cell", "chunk", "part"]

    def pair(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return fn(a, b)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(pair, schema)


def _nearby(pivots: np.ndarray, metric: Metric) -> np.ndarray:
    """Positions of the pivots along a path that always goes on to the nearest pivot left."""
    left, at, path = np.ones(len(pivots), bool), 0, np.zeros(len(pivots), np.int64)
    for place in range(len(pivots)):
        path[at], left[at] = place, False
        if left.any():
            at = int(np.where(left, metric.distances(pivots[at : at + 1], pivots)[0], np.inf).argmin())
    return path


def _in_blocks(
    queries: DataFrame, cells: Cells, metric: Metric, rows: int, tasks: int = 1, least: int = 1
) -> tuple[DataFrame, int]:
    """``queries`` with a ``block`` of about so many of them, and the number of blocks.

    Blocks follow the path through the pivots, so their queries lie near each other. Where these
    are fewer than ``tasks``, blocks are smaller, down to ``least`` queries.
    """
    count = np.zeros(len(cells.pivots), np.int64)
    for r in queries.groupBy("cell").agg(F.count("*").alias("n")).collect():
        count[r["cell"]] = r["n"]
    rows = min(rows, max(least, -(-int(count.sum()) // tasks)))
    order = np.argsort(_nearby(cells.pivots, metric))
    start = np.zeros(len(count), np.int64)
    start[order] = np.cumsum(count[order]) - count[order]
    table = queries.sparkSession.createDataFrame(
        [(i, int(s), int(max(c, 1))) for i, (s, c) in enumerate(zip(start, count))], "cell long, start long, many long"
    )
    place = F.col("start") + F.pmod(F.xxhash64("uid"), "many")
    placed = queries.join(table, "cell").withColumn("block", F.floor(place / rows).cast("int"))
    return placed.drop("start", "many"), int(-(-count.sum() // rows))


def _needed(c: np.ndarray, near, far, slack, bound) -> np.ndarray:
    """Which cells may hold something within the bound of a query, by its chords to the pivots.

    Written so that a bound that cannot be compared rules nothing out.
    """
    return ~(np.maximum(c - far, near - c) - slack[:, None] > bound[:, None])


def _block_cells(queries: DataFrame, cells: Cells, metric: Metric) -> DataFrame:
    """(block, cell): the cells that some query of a block needs."""
    shared = queries.sparkSession.sparkContext.broadcast((cells.pivots, cells.near, cells.far))

    def needs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, near, far = shared.value
        step = max(1, 2_000_000 // len(pivots))
        for batch in batches:
            found = set()
            for i in range(0, len(batch), step):
                pdf = batch.iloc[i : i + step]
                q = metric.prepare(pdf["vec"])
                need = _needed(metric.chord(metric.distances(q, pivots)), near, far, metric.slack(q), pdf["bound"].to_numpy())
                blocks = pdf["block"].to_numpy()
                for b in np.unique(blocks).tolist():
                    found |= {(b, c) for c in np.flatnonzero(need[blocks == b].any(0)).tolist()}
            yield pd.DataFrame(sorted(found), columns=["block", "cell"])

    return queries.select("vec", "bound", "block").mapInPandas(needs, "block int, cell long").distinct()


def _matrix(column: pa.Array, metric: Metric) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return metric.prepare(flat.reshape(len(column), -1))


class _Held:
    """A block of queries and the best that has passed by each of them."""

    def __init__(self, rows: pa.Table, want: int, metric: Metric, shared, step: int):
        self.want, self.metric, self.shared = want, metric, shared
        get = lambda c: rows[c].combine_chunks().to_numpy(zero_copy_only=False)
        order = np.argsort(get("cell"), kind="stable")
        x, ids = _matrix(rows["vec"].combine_chunks(), metric)[order], get("uid")[order]
        cell, chunk = get("cell")[order], get("chunk")[order]
        bound, limit = get("bound")[order], get("distance")[order]
        none = (np.zeros(0, np.int64), np.zeros(0), ids[:0])
        self.steps = [
            [ids[s], x[s], cell[s], chunk[s], bound[s], limit[s].copy(), none]
            for s in (slice(i, i + step) for i in range(0, len(x), step))
        ]

    def see(self, ids: np.ndarray, b: np.ndarray, cell: np.ndarray, chunk: np.ndarray) -> None:
        """Compare base rows with all queries but those of their own chunk."""
        pivots, near, far = self.shared
        some, at = np.unique(cell, return_inverse=True)
        square = (b * b).sum(1)
        for step in self.steps:
            _, x, own_cell, own_chunk, bound, limit, _ = step
            c = self.metric.chord(self.metric.distances(x, pivots[some]))
            need = _needed(c, near[some], far[some], self.metric.slack(x), bound).any(0)[at]
            near_by = np.flatnonzero(need)
            if not len(near_by):
                continue
            y = b[near_by]
            s = x @ y.T
            if self.metric.name == "cosine":
                least = 1 - limit - 2 * SLACK
            else:
                own, size = (x * x).sum(1), square[near_by]
                s -= size[None, :] / 2  # larger is nearer
                least = (own - (limit + 2 * SLACK) ** 2) / 2 - 1e-12 * (own + size.max())
            least = np.where(np.isfinite(least), least, -np.inf)
            close = s >= least[:, None]
            same = np.isin(own_cell, cell)  # only these can meet their own chunk
            if same.any():
                close[same] &= (own_cell[same][:, None] != cell[near_by]) | (own_chunk[same][:, None] != chunk[near_by])
            row, col = np.divmod(np.flatnonzero(close), len(near_by))
            if self.metric.name == "cosine":
                d = 1.0 - s[row, col]
            else:
                d = np.sqrt(np.maximum(own[row] - 2.0 * s[row, col], 0.0))
            self._merge(step, row, np.round(d, TIE_DIGITS), ids[near_by[col]])

    def _merge(self, step: list, row: np.ndarray, d: np.ndarray, other: np.ndarray) -> None:
        if not len(row):
            return
        row, d, other = (np.concatenate(pair) for pair in zip(step[6], (row, d, other)))
        order = np.lexsort([np.unique(other, return_inverse=True)[1], d, row])
        row, d, other = row[order], d[order], other[order]
        first = np.searchsorted(row, np.arange(len(step[0])))
        rank = np.arange(len(row)) - first[row]
        last = rank == self.want - 1
        step[5][row[last]] = np.fmin(step[5][row[last]], d[last])
        kept = rank < self.want
        step[6] = (row[kept], d[kept], other[kept])

    def found(self) -> Iterator[pa.RecordBatch]:
        for ids, *_, (row, d, other) in self.steps:
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(other), pa.array(d, pa.float64())], ["qid", "bid", "distance"]
                )


def _sweep(queries: DataFrame, cells: Cells, want: int, metric: Metric, schema: str, chunk_rows: int) -> DataFrame:
    """The ``want`` best of every query outside its own chunk, as far as they can be among its best.

    ``queries`` is (uid, vec, cell, chunk, bound, d), where d is the distance that its own chunk leaves to
    beat, or null. Each block of queries is one task; vectors of the cells it needs are sent to it
    once, and pass by in batches.
    """
    dimension = max(1, cells.pivots.shape[1])
    rows = max(1, min(BLOCK_CHUNKS * chunk_rows, BROADCAST_BYTES // (8 * dimension)))
    blocks, n = _in_blocks(queries, cells, metric, rows)
    blocks = durable(blocks)
    shared = queries.sparkSession.sparkContext.broadcast((cells.pivots, cells.near, cells.far))
    tile = max(1, min(4096, 4 * chunk_rows))
    columns = ["block", "side", "uid", "vec", "cell", "chunk", "bound", "distance"]
    held = blocks.withColumn("side", F.lit(0)).withColumn("distance", F.coalesce("d", F.lit(float("inf"))))
    kind = queries.schema["vec"].dataType
    passing = cells.base.withColumn("vec", F.col("vec").cast(kind)).drop("bound").join(
        durable(_block_cells(blocks, cells, metric)), "cell"
    ).withColumn("side", F.lit(1)).withColumn("bound", F.lit(0.0)).withColumn("distance", F.lit(0.0))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, waiting, now = None, [], None
        for batch in batches:
            key = 2 * batch.column("block").to_numpy().astype(np.int64) + batch.column("side").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i == j:
                    continue
                part = batch.slice(i, j - i)
                if key[i] // 2 != block:
                    if now is not None:
                        yield from now.found()
                    block, waiting, now = key[i] // 2, [], None
                if key[i] % 2 == 0:
                    waiting.append(part)
                    continue
                if now is None:
                    now = _Held(pa.Table.from_batches(waiting), want, metric, shared.value, chunk_rows)
                    waiting = []
                for t in range(0, part.num_rows, tile):
                    some = part.slice(t, tile)
                    get = lambda c: some.column(c).to_numpy(zero_copy_only=False)  # noqa: B023, E731
                    now.see(get("uid"), _matrix(some.column("vec"), metric), get("cell"), get("chunk"))
        if now is not None:
            yield from now.found()

    both = held.select(*columns).unionByName(passing.select(*columns))
    dealt = both.repartitionById(max(1, n), "block").sortWithinPartitions("block", "side", "cell")
    return dealt.mapInArrow(search, schema)


def _pivot_search(
    queries: DataFrame, base: DataFrame, k: int, metric: Metric, exclude_self: bool,
    chunk_rows: int,
) -> DataFrame:
    want = k + 1 if exclude_self else k
    units = durable(distinct_vectors(base, want))
    if units.isEmpty():
        return queries.sparkSession.createDataFrame([], _result_schema(queries, base))
    cells = build_cells(units, metric, want, chunk_rows)
    asking = distinct_vectors(queries, 1)
    asked = durable(
        with_chunk(_assign(asking.select("uid", "vec"), cells.pivots, metric, want), cells.chunks)
    )
    schema = _result_schema(queries, base)

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame(columns=["qid", "bid", "distance"])
        b = b.sort_values("uid")
        return _best(
            a["uid"].to_numpy(), metric.prepare(a["vec"]), b["uid"].to_numpy(),
            metric.prepare(b["vec"]), want, metric,
        )

    own = durable(meet(asked, asked.select("uid", "cell", "chunk"), cells, best, schema, chunk_rows))
    worst = own.groupBy("qid").agg(F.count("*").alias("n"), F.max("distance").alias("d"))
    tight = metric_bound(F.col("d"), metric)
    bounded = asked.join(worst, asked["uid"] == worst["qid"], "left").withColumn(
        "bound", F.when(F.col("n") >= want, F.least("bound", tight)).otherwise(F.col("bound"))
    )
    bounded = bounded.withColumn("d", F.when(F.col("n") >= want, F.col("d"))).drop("qid", "n")
    others = _sweep(bounded, cells, want, metric, schema, chunk_rows)
    found = _keep_best(own.unionByName(others), want)

    each = expand_copies(found, units, members(queries, asking), want)
    return each.filter(F.col("qid") != F.col("bid")) if exclude_self else each


def expand_copies(found: DataFrame, units: DataFrame, member: DataFrame, want: int) -> DataFrame:
    """(qid, bid, distance) between rows from hits between distinct vectors, the ``want`` best of each."""
    copies = units.select(F.col("uid").alias("bid"), "ids")
    spread = found.join(copies, "bid").select("qid", F.explode("ids").alias("bid"), "distance")
    spread = _keep_best(spread, want).withColumnRenamed("qid", "uid")
    return spread.join(member, "uid").select(F.col("id").alias("qid"), "bid", "distance")


def metric_bound(d, metric: Metric):
    """Metric.chord as a column expression."""
    return F.sqrt(2 * (d + SLACK)) if metric.name == "cosine" else d + SLACK


def knn(
    queries: DataFrame, base: DataFrame, k: int, metric: str = "cosine",
    query_key: str = "doc_id", base_key: str = "doc_id", vector: str = "embedding",
    base_vector: str | None = None, exclude_self: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES, chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The k nearest base rows of every query: (id, neighbour, distance, rank).

    Vectors that are null, empty, of another dimension than most of the base, or hold a null,
    NaN or infinity take no part; ``rejected`` lists them with the reason. Equal distances (to
    nine digits) are ordered by neighbour id. ``exclude_self`` leaves
    out the row with the query's own id, for a table searched against itself.
    """
    m = metric_of(metric)
    dimension = usual_dimension(base, base_vector or vector)
    q = clean(queries, query_key, vector, m, dimension)
    b = clean(base, base_key, base_vector or vector, m, dimension)
    if fits(b, broadcast_bytes):
        found = _broadcast_search(q, b, k, m, exclude_self)
    else:
        found = _pivot_search(q, b, k, m, exclude_self, chunk_rows)
    order = Window.partitionBy("qid").orderBy("distance", "bid")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(
        F.col("qid").alias("id"), F.col("bid").alias("neighbour"), "distance",
        F.col("rank").cast("bigint").alias("rank"),
    )


def _forest(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> pd.DataFrame:
    """Edges from every touched row to the smallest id of its component in one block pair."""
    ids = np.concatenate([left, right])
    n = len(left)
    seen_left, seen_right = np.zeros(n, bool), np.zeros(len(right), bool)
    src, dst = [], []
    for start in range(n):
        if seen_left[start] or not mask[start].any():
            continue
        frontier, group = np.array([start]), [np.array([start])]
        seen_left[start] = True
        while len(frontier):
            reach = mask[frontier].any(axis=0) & ~seen_right
            seen_right |= reach
            group.append(np.nonzero(reach)[0] + n)
            back = mask[:, reach].any(axis=1) & ~seen_left if reach.any() else np.zeros(n, bool)
            seen_left |= back
            frontier = np.nonzero(back)[0]
            group.append(frontier)
        found = ids[np.concatenate(group)]
        src.append(found)
        dst.append(np.full(len(found), found.min()))
    if not src:
        return pd.DataFrame({"src": ids[:0], "dst": ids[:0]})
    edges = pd.DataFrame({"src": np.concatenate(src), "dst": np.concatenate(dst)})
    return edges[edges["src"] != edges["dst"]].drop_duplicates()


def radius_forest(
    units: DataFrame, radius: float, metric: Metric, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Edges (src, dst) with the same components as the graph of all pairs within ``radius``.

    ``units`` is (uid, vec) with distinct vectors. Every block pair reports a spanning
    forest, at most one edge per row it holds, instead of its pairs.
    """
    cells = build_cells(units, metric, 1, chunk_rows)
    reach = cells.base.withColumn("bound", F.lit(float(metric.chord(radius))))
    visiting = durable(visits(reach, cells, metric, skip_own=False))
    uid = units.schema["uid"].dataType.simpleString()

    def link(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame(columns=["src", "dst"])
        d = metric.distances(metric.prepare(a["vec"]), metric.prepare(b["vec"]))
        return _forest(d <= radius, a["uid"].to_numpy(), b["uid"].to_numpy())

    return meet(
        cells.base, visiting, cells, link, f"src {uid}, dst {uid}", chunk_rows
    ).distinct()


def neighbour_graph(edges: DataFrame, k: int) -> DataFrame:
    """Weighted undirected neighbour graph (src, dst, weight) from a knn result.

    Distances are scaled per point: the nearest neighbour gets weight one, and a width is
    found by bisection so that the weights of a point add up to log2(k). The two
    directions a, b of an edge combine to a + b - ab.
    """
    rho = F.min(F.when(F.col("distance") > 0, F.col("distance")))
    points = edges.groupBy("id").agg(
        F.coalesce(rho, F.lit(0.0)).alias("rho"),
        F.array_sort(F.collect_list("distance")).alias("ds"),
    )
    target = float(np.log2(k))

    @F.pandas_udf("double")
    def width(ds: pd.Series, rho: pd.Series) -> pd.Series:
        """All points of a batch at once: short lists are filled up with infinity, whose weight is 0."""
        if not len(ds):
            return pd.Series([], dtype=float)
        over = np.full((len(ds), max(len(d) for d in ds)), np.inf)
        for i, d in enumerate(ds):
            over[i, : len(d)] = np.maximum(np.asarray(d, np.float64) - rho.iloc[i], 0.0)
        known = np.isfinite(over)
        mean = np.where(known, over, 0).sum(1) / np.maximum(known.sum(1), 1)
        weight = lambda w: np.exp(-over / w[:, None]).sum(1)
        # a weight sum grows with the width: double until it is passed, then halve the interval
        high = np.maximum(mean, 1e-12)
        for _ in range(60):
            short = (weight(high) < target) & (known.sum(1) > target)
            if not short.any():
                break
            high = np.where(short, 2 * high, high)
        low = np.zeros(len(ds))
        for _ in range(60):
            middle = np.maximum((low + high) / 2, 1e-300)
            under = weight(middle) < target
            low, high = np.where(under, middle, low), np.where(under, high, middle)
        return pd.Series(np.maximum(high, np.maximum(1e-3 * mean, 1e-12)))

    scale = points.select("id", "rho", width("ds", "rho").alias("sigma"))
    weight = F.exp(-F.greatest(F.col("distance") - F.col("rho"), F.lit(0.0)) / F.col("sigma"))
    one_way = edges.join(scale, "id").select(
        F.col("id").alias("src"), F.col("neighbour").alias("dst"), weight.alias("w")
    )
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    return (
        one_way.groupBy(low.alias("src"), high.alias("dst"))
        .agg(F.sum("w").alias("s"), F.when(F.count("*") == 2, F.product("w")).otherwise(0.0).alias("p"))
        .select("src", "dst", (F.col("s") - F.col("p")).alias("weight"))
    )
