"""Counts of frequent n-grams without shuffling the rare ones.

Most n-grams are rare, and a vocabulary drops them. A first pass over the tokens fills a
count-min sketch: two rows of counters by hash, which never count too little. An n-gram whose
smaller counter is below the least document frequency cannot reach it, so in the second pass it
does not leave its task. What leaves is exact: the sketch only ever keeps too many. N-grams are
hashes of hashes of their tokens until they have passed, so the rare ones are never written out.

The sketch has a fixed size. On a corpus with far more distinct n-grams than counters it rules out
less, and the counts stay the same. Where only the most frequent n-grams are wanted, ``ranked_counts``
asks the sketch for more than the least document frequency: a bound that grows with the corpus as the
load of a counter does, so what leaves the tasks does not grow faster than the input.

Where every n-gram is wanted, nothing can be ruled out, and the cost is that of a row for each
occurrence. ``every_count`` has none: runs of tokens are counted as numbers within tasks, their
n-grams leave in compressed blocks by slices of a hash of the term, and each slice is merged on its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import durable

SKETCH_BITS = 22
TALLY_BITS = 23  # of the sketch with whole counts: noise must stay well below the bound
ROWS = 2
PIECE = 1 << 16
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
RUN = 1 << 19  # tokens counted at once where every n-gram is counted
SLICES = 32  # to each partition of the tokens


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _numbered(columns: Sequence[pa.Array], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each group, group of each row); no columns are one group, nulls are values."""
    group, first = np.zeros(rows, np.int64), np.zeros(1, np.int64)
    for column in columns:
        own = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        _, first, group = np.unique(group * (own.max() + 1) + own, return_index=True, return_inverse=True)
    return first, group


class Grams:
    """The n-grams of a batch of token lists: hash, position of the first token, n, and row."""

    def __init__(self, lists: pa.Array, high: int):
        lists = lists.cast(pa.large_list(pa.string()))
        flat = lists.flatten()  # leaves out what null lists may span
        lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.cumsum(lens)
        coded = flat.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        self.words = coded.dictionary
        own = np.fromiter(
            (zlib.crc32(w) | zlib.adler32(w) << 32 for w in self.words.cast(pa.binary()).to_pylist()),
            np.uint64, len(self.words),
        )
        token = _spread(own)[self.codes]
        self.row = np.repeat(np.arange(len(lens)), lens)
        left = np.repeat(self.ends, lens) - np.arange(len(token))  # tokens to the end of the list
        h, at, hashes, starts, sizes = token, np.arange(len(token)), [], [], []
        for n in range(1, high + 1):
            if n > 1:
                fits = left[at] >= n
                at = at[fits]
                h = _spread(h[fits] * np.uint64(SEEDS[0]) + token[at + n - 1] + np.uint64(n))
            hashes.append(h)
            starts.append(at)
            sizes.append(np.full(len(at), n, np.int8))
        self.hash, self.start, self.n = (np.concatenate(x) for x in (hashes, starts, sizes))

    def places(self, bits: int) -> list[np.ndarray]:
        """The counter of every n-gram in each row of the sketch."""
        return [((self.hash * np.uint64(s)) >> np.uint64(64 - bits)).astype(np.int64) for s in SEEDS]

    def text(self, chosen: np.ndarray) -> pa.Array:
        """The chosen n-grams, tokens joined by a blank, in the order of their n."""
        out = []
        for n in np.unique(self.n[chosen]).tolist():
            at = self.start[chosen][self.n[chosen] == n]
            parts = [self.words.take(pa.array(self.codes[at + i])) for i in range(n)]
            out.append(parts[0] if n == 1 else pc.binary_join_element_wise(*parts, " "))
        return pa.concat_arrays(out) if out else pa.array([], pa.string())


def _cut(batches: Iterator[pa.RecordBatch], tokens: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows with about so many tokens, a row at least."""
    for batch in batches:
        lens = pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(lens, dtype=np.int64) - lens) // tokens
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for i, j in zip(cuts[:-1], cuts[1:]):
            if j > i:
                yield batch.slice(i, j - i)


def _fill(batches: Iterator[pa.RecordBatch], high: int, bits: int, least: int) -> Iterator[pa.RecordBatch]:
    """The task's sketch in pieces, (piece, counters); counters stop at ``least``."""
    counts = np.zeros((ROWS, 1 << bits), np.uint8)
    for batch in _cut(batches):
        for row, places in zip(counts, Grams(batch.column(0), high).places(bits)):
            at, n = np.unique(places, return_counts=True)
            row[at] = np.minimum(row[at] + np.minimum(n, least), least)
    flat = counts.reshape(-1)
    for i in range(0, len(flat), PIECE):
        piece = flat[i : i + PIECE]
        if piece.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i // PIECE]), pa.array([pa.compress(piece.tobytes(), "lz4", asbytes=True)], pa.binary())],
                names=["piece", "counters"],
            )


def _enough(batches: Iterator[pa.RecordBatch], least: int, size: int) -> Iterator[pa.RecordBatch]:
    """(piece, bits): which counters of a piece reach ``least``, from a stream sorted by piece."""
    at, total = None, None

    def done() -> pa.RecordBatch:
        bits = np.packbits(total >= least).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([bits], pa.binary())], names=["piece", "bits"])

    for batch in batches:
        for piece, counters in zip(batch.column(0).to_pylist(), batch.column(1)):
            if piece != at:
                if at is not None:
                    yield done()
                at, total = piece, np.zeros(size, np.int64)
            total += np.frombuffer(pa.decompress(counters.as_buffer(), size, "lz4"), np.uint8)
    if at is not None:
        yield done()


def reaching(tokens: DataFrame, terms: str, high: int, least: int, bits: int = SKETCH_BITS) -> list[np.ndarray]:
    """For each row of the sketch, which counters reach ``least``; 2^bits flags a row on the driver."""
    size = min(PIECE, ROWS << bits)
    filled = tokens.select(terms).mapInArrow(lambda b: _fill(b, high, bits, least), "piece long, counters binary")
    pieces = filled.repartition("piece").sortWithinPartitions("piece").mapInArrow(
        lambda b: _enough(b, least, size), "piece long, bits binary"
    )
    flags = np.zeros(ROWS << bits, bool)
    for r in pieces.collect():
        flags[r["piece"] * size : (r["piece"] + 1) * size] = np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
    return list(flags.reshape(ROWS, -1))


def _tally(batches: Iterator[pa.RecordBatch], high: int, bits: int) -> Iterator[pa.RecordBatch]:
    """The task's sketch in pieces, (piece, counters), with whole counts."""
    counts = np.zeros((ROWS, 1 << bits), np.uint32)
    for batch in _cut(batches):
        for row, places in zip(counts, Grams(batch.column(0), high).places(bits)):
            np.add.at(row, places, np.uint32(1))
    flat = counts.reshape(-1)
    for i in range(0, len(flat), PIECE):
        piece = flat[i : i + PIECE]
        if piece.any():
            packed = pa.compress(piece.tobytes(), "lz4", asbytes=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i // PIECE]), pa.array([packed], pa.binary())], names=["piece", "counters"]
            )


def _total(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sums of the counters of a piece, 2^32 - 1 at most, from a stream sorted by piece."""
    at, total = None, None

    def done() -> pa.RecordBatch:
        whole = np.minimum(total, (1 << 32) - 1).astype(np.uint32)
        packed = pa.compress(whole.tobytes(), "lz4", asbytes=True)
        return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([packed], pa.binary())], names=["piece", "counters"])

    for batch in batches:
        for piece, counters in zip(batch.column(0).to_pylist(), batch.column(1)):
            if piece != at:
                if at is not None:
                    yield done()
                at, total = piece, np.zeros(size, np.int64)
            total += np.frombuffer(pa.decompress(counters.as_buffer(), 4 * size, "lz4"), np.uint32)
    if at is not None:
        yield done()


def tallied(tokens: DataFrame, terms: str, high: int, bits: int = TALLY_BITS) -> np.ndarray:
    """The counters, a row of the sketch each: at most 2 * 2^bits * 4 bytes on the driver."""
    size = min(PIECE, ROWS << bits)
    filled = tokens.select(terms).mapInArrow(lambda b: _tally(b, high, bits), "piece long, counters binary")
    pieces = filled.repartition("piece").sortWithinPartitions("piece").mapInArrow(
        lambda b: _total(b, size), "piece long, counters binary"
    )
    counters = np.zeros(ROWS << bits, np.uint32)
    for r in pieces.collect():
        counters[r["piece"] * size : (r["piece"] + 1) * size] = np.frombuffer(
            pa.decompress(r["counters"], 4 * size, "lz4"), np.uint32
        )
    return counters.reshape(ROWS, -1)


def ranked_counts(
    tokens: DataFrame, *groups: str, most: int, vocabulary: Callable[[DataFrame], DataFrame],
    terms: str = "terms", high: int = 3, min_df: int = 6, bits: int = TALLY_BITS,
) -> tuple[DataFrame, DataFrame]:
    """(counts, vocabulary) for the ``most`` most frequent n-grams, both written down.

    ``vocabulary`` takes counts to (term, f, df): the ``most`` terms of largest f among those it
    lets in, all of them if they are fewer. Counts hold every n-gram that occurs ``least`` times or
    more. If the vocabulary is full and its smallest f is not below ``least``, no n-gram left out
    belongs there. Else the search goes on with a smaller bound: that f, which ``most`` terms
    reach, or, if the vocabulary is not full, an eighth, down to ``min_df``.
    """
    counters = tallied(tokens, terms, high, bits)
    room = 2 * most  # some counters hold several terms, some terms are not let in
    least = min_df
    if room < counters.shape[1]:
        least = max(min_df, int(np.partition(counters[0], -room)[-room]))
    while True:
        flags = [np.packbits(row >= least) for row in counters]
        counts = durable(_counted(tokens, groups, terms, high, flags if least > 1 else [], bits))
        vocab = durable(vocabulary(counts))
        if least <= min_df:
            return counts, vocab
        found = vocab.agg(F.count("*").alias("n"), F.min("f").alias("f")).first()
        full = found["n"] >= most
        if full and found["f"] >= least:
            return counts, vocab
        least = max(min_df, found["f"] if full else least // 8)


def frequent_counts(
    tokens: DataFrame, *groups: str, terms: str = "terms", high: int = 3, min_df: int = 6,
    bits: int = SKETCH_BITS,
) -> DataFrame:
    """(groups, term, tf, docs) of 1- to ``high``-grams, as ``terms.group_counts`` gives them.

    ``tokens`` has an array of tokens a row. Every n-gram found in at least ``min_df`` rows is
    there with all its counts; of the others, which a vocabulary drops, most are missing. Null
    arrays hold nothing; null groups are groups of their own.
    """
    flags = [np.packbits(f) for f in reaching(tokens, terms, high, min_df, bits)] if min_df > 1 else []
    return _counted(tokens, groups, terms, high, flags, bits)


def _counted(
    tokens: DataFrame, groups: Sequence[str], terms: str, high: int, flags: list[np.ndarray], bits: int
) -> DataFrame:
    """(groups, term, tf, docs) of the n-grams whose counters are all flagged."""
    shared = tokens.sparkSession.sparkContext.broadcast(flags)  # 2 * 2^bits / 8 bytes
    kinds = [f"`{g}` {tokens.schema[g].dataType.simpleString()}" for g in groups]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [np.unpackbits(f).astype(bool) for f in shared.value]
        for batch in _cut(batches):
            grams = Grams(batch.column(0), high)
            keep = np.ones(len(grams.hash), bool)
            for flag, places in zip(known, grams.places(bits)):
                keep &= flag[places]
            chosen = np.flatnonzero(keep)
            if not len(chosen):
                continue
            term = grams.text(chosen).dictionary_encode()
            code, width = term.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(term.dictionary)
            first, group = _numbered(batch.columns[1:], batch.num_rows)
            row = grams.row[grams.start[chosen]]
            pair, times = np.unique(row * width + code, return_counts=True)
            cell, place = np.unique(group[pair // width] * width + pair % width, return_inverse=True)
            tf = np.bincount(place, times, len(cell)).astype(np.int64)
            docs = np.bincount(place, minlength=len(cell))
            at = pa.array(first[cell // width])
            yield pa.RecordBatch.from_arrays(
                [*[c.take(at) for c in batch.columns[1:]], term.dictionary.take(pa.array(cell % width)), pa.array(tf), pa.array(docs)],
                names=[*groups, "term", "tf", "docs"],
            )

    found = tokens.select(terms, *groups).mapInArrow(count, ", ".join([*kinds, "term string, tf long, docs long"]))
    return found.groupBy(*groups, "term").agg(F.sum("tf").alias("tf"), F.sum("docs").alias("docs"))


def _joinable(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, power) of each word; hash(a + b) = hash(a) * power(b) + hash(b), so equal texts have one hash."""
    words = words.cast(pa.large_binary())
    lens = pc.binary_length(words).to_numpy().astype(np.int64)
    ends, powers = np.cumsum(lens), np.full(lens.max(initial=0) + 1, SEEDS[0], np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    raw = np.frombuffer(words.buffers()[2] or b"", np.uint8, ends[-1])
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(raw * powers[np.repeat(ends, lens) - 1 - np.arange(len(raw))], out=sums[1:])
    return sums[ends] - sums[ends - lens], powers[lens]


def _counted_runs(batches: Iterator[pa.RecordBatch], high: int, slices: int, run: int) -> Iterator[pa.RecordBatch]:
    """(slice, block): the n-grams of a run, each once in its groups, by slices of their hash.

    An n-gram is the number of its first n - 1 tokens, among those found in its groups, and the code of
    its last token; texts are made of what was counted. A block is an Arrow stream (groups, term, tf).
    """
    packed = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in _cut(batches, run):
        lists = batch.column(0).cast(pa.large_list(pa.large_string()))
        flat = lists.flatten().dictionary_encode()
        if not len(flat):
            continue
        words, codes = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        left = np.repeat(np.cumsum(lens), lens) - np.arange(len(codes))  # tokens to the end of the list
        first, group = _numbered(batch.columns[1:], batch.num_rows)
        own, power = _joinable(words)
        bits = np.int64(len(words).bit_length())
        before, at = np.repeat(group, lens), np.arange(len(codes))
        groups, hashes, parts, counted = np.arange(len(first)), None, [], []
        for n in range(1, high + 1):
            fits = left[at] >= n
            at, before = at[fits], before[fits]
            keys = before << bits | codes[at + n - 1]
            if n < high:
                found, before, tf = np.unique(keys, return_inverse=True, return_counts=True)
            else:
                found, tf = np.unique(keys, return_counts=True)
            shorter, last = found >> bits, found & ((1 << bits) - 1)
            groups, parts = groups[shorter], [*(p[shorter] for p in parts), last]
            if n == 1:
                hashes = own[last]
            else:
                hashes = (hashes[shorter] * np.uint64(SEEDS[0]) + np.uint64(ord(" "))) * power[last] + own[last]
            term = words.take(pa.array(parts[0]))
            if n > 1:
                rest = [words.take(pa.array(p)) for p in parts[1:]]
                term = pc.binary_join_element_wise(term, *rest, pa.scalar(" ", pa.large_string()))
                del rest
            place = ((_spread(hashes) >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)).astype(np.int64)
            counted.append((term, place, groups, tf))
        term, place, group, tf = (pa.concat_arrays(x[0] for x in counted), *map(np.concatenate, list(zip(*counted))[1:]))
        del counted, keys, found, before, at, left, hashes, shorter, last, parts
        order = np.argsort(place.astype(np.min_scalar_type(slices)), kind="stable")
        columns = [*(c.take(pa.array(first[group[order]])) for c in batch.columns[1:]), term.take(pa.array(order)), pa.array(tf[order])]
        whole = pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[1:], "term", "tf"])
        ends = np.cumsum(np.bincount(place, minlength=slices)).tolist()
        held, blocks = [], []
        for i, (start, end) in enumerate(zip([0, *ends], ends)):
            if end > start:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, whole.schema, options=packed) as stream:
                    stream.write_batch(whole.slice(start, end - start))
                held.append(i)
                blocks.append(sink.getvalue().to_pybytes())
        made = pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(blocks, pa.binary())], names=["slice", "block"])
        del term, place, group, tf, order, columns, whole, blocks
        pa.default_memory_pool().release_unused()  # a worker keeps what it does not return
        yield made


def every_count(
    tokens: DataFrame, *groups: str, slices: int, terms: str = "terms", high: int = 3, run: int = RUN
) -> DataFrame:
    """(groups, term, tf) of all 1- to ``high``-grams, those that occur once included.

    ``tokens`` has an array of tokens a row. Null arrays hold nothing; null groups are groups of their
    own. Each of the ``slices`` is merged in memory, so their number is to grow with the corpus:
    ``SLICES`` to each partition of it. The frequency of a term does not count, as a run of tokens
    brings it once for each of its groups.
    """
    held = tokens.select(terms, *groups)
    kinds = [f"`{g}` {held.schema[g].dataType.simpleString()}" for g in groups]
    runs = held.mapInArrow(lambda b: _counted_runs(b, high, slices, run), "slice int, block binary")

    def merge(table: pa.Table) -> pa.Table:
        whole = pa.concat_tables([pa.ipc.open_stream(b.as_buffer()).read_all() for b in table["block"]])
        whole = whole.set_column(len(groups), "term", whole["term"].cast(pa.string()))  # group_by is slow on large strings
        whole = whole.group_by([*groups, "term"], use_threads=False).aggregate([("tf", "sum")])
        pa.default_memory_pool().release_unused()
        return whole.select([*groups, "term", "tf_sum"]).rename_columns([*groups, "term", "tf"])

    return runs.groupBy("slice").applyInArrow(merge, ", ".join([*kinds, "term string, tf long"]))
