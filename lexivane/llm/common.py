"""Registry of the queries of this subpackage, and helpers that its operators share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str | Column, n: int) -> Column:
    """crc32 of a key written as text, modulo ``n``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % n


def words_of(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(words per text, code of each word, the distinct words).

    A-Z are lower-cased unless told not to; words are runs of anything but ASCII white space.
    Null is empty.
    """
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = lists.flatten()
    full = pc.not_equal(flat, "")
    mask = np.asarray(full.to_numpy(zero_copy_only=False), dtype=bool)
    offsets = np.asarray(lists.offsets)
    ends = np.concatenate([[0], np.cumsum(mask)])
    base = offsets[0] if len(offsets) else 0
    lens = np.diff(ends[offsets - base]) if len(texts) else np.zeros(0, np.int64)
    coded = flat.filter(full).dictionary_encode()
    return lens.astype(np.int64), coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def hash_words(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def chain(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit value for aligned sequences of 64-bit values."""
    h = np.full(len(parts[0]), 0x9E3779B97F4A7C15, np.uint64)
    for p in parts:
        h = mix(h * np.uint64(0x2545F4914F6CDD1D) + p)
    return h


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from batches in which equal keys lie together."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:]):
            key = tuple(batch.column(k)[i].as_py() for k in keys)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows with about ``size`` bytes of text, a row at least."""
    for batch in batches:
        lens = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(lens, dtype=np.int64) - lens) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:]):
            if j > i:
                yield batch.slice(i, j - i)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return freed memory to the system; Arrow's pool and the C heap would keep it for the worker's life."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def thrifty(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same task over batches, that returns freed memory where it begins and ends.

    A worker serves many stages and waits beside those that run in the JVM alone.
    """

    def task(batches: Iterator) -> Iterator:
        give_back()
        yield from run(batches)
        give_back()

    return task


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """What runs inside sends its tasks Arrow batches of about ``size`` bytes.

    By default a batch has 10 000 rows, which for long texts is held several times over by the JVM and the worker.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def drop_tables(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete intermediate tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for frame in frames:
        for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
