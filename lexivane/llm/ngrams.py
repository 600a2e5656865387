"""Language-model scores from a sharded Elias-Fano trigram trie.

The corpus is read once into blocks of coded texts. What a block needs to know of the whole
corpus it asks in exchanges: it sends the distinct n-grams of its texts with their training
counts to shards, a shard adds up what all blocks sent, and answers each block in the order it
asked. Nothing else is shuffled, and no task or driver holds the model as a whole.

1. Words: counts over the training texts.
2. Pairs after words that are too frequent for one shard: counts, and numbers of followers.
3. Trigrams, by their middle word (by middle and first word, if the middle word is such a
   frequent one). A shard builds its trie of absolutely discounted, interpolated and then
   quantised probabilities, and looks up every trigram of every block.

Words are 64-bit hashes. Inside a context, words are told apart by 24 bits of theirs and first
words by 32, which blurs counts where two followers of one context collide.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import durable, work_dir
from .common import chain, groups_of, hash_words, partitions, query, remainder, table, words_of
from .eliasfano import EliasFano, Trie, logarithm, quantise

BLOCK_BYTES = 8_000_000
DISCOUNT = 0.75
ADDED = 0.1
END, BEGIN = 1, 2  # hashes of the marks around a text, below those of all words
W_BITS = 24


def _pack(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 3)


def _open(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Hashes fall into ranges of equal width, so what is sorted by hash is sorted by shard."""
    return (((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


class Block:
    """Coded texts: tokens are places in ``hashes``, which ascend; each text ends with the end mark.

    The first two hashes are those of the marks, so codes ascend with hashes.
    """

    def __init__(self, row: dict):
        self.id = row["block"]
        self.keys, self.held = row["keys"], np.array(row["held"], bool)
        self.lens = np.frombuffer(row["lens"], "<i8")
        self.codes = _open(row["codes"], "<i4")
        self.hashes = EliasFano.frombytes(row["hashes"]).values()
        self.doc = np.repeat(np.arange(len(self.lens)), self.lens)
        self.trained = ~self.held[self.doc]

    def before(self, codes: np.ndarray) -> np.ndarray:
        """The token before each one; the begin mark before the first of a text."""
        out = np.concatenate([[1], codes[:-1]])
        out[np.cumsum(self.lens) - self.lens] = 1
        return out


def read_blocks(docs: DataFrame, held: Column, key: str, text: str) -> DataFrame:
    """(block, keys, held, lens, codes, hashes, trained, begun), a row for each block of texts."""

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            size = np.diff(np.asarray(batch.column(2).cast(pa.large_binary()).fill_null(b"").buffers()[1]).view("<i8")[: batch.num_rows + 1])
            part = np.concatenate([[0], np.cumsum(size)[:-1]]) // BLOCK_BYTES
            for p in np.unique(part).tolist():
                rows = np.flatnonzero(part == p)
                one = batch.slice(int(rows[0]), len(rows))
                lens, codes, words = words_of(one.column(2))
                found = np.maximum(hash_words(words), np.uint64(BEGIN + 1))
                order = np.argsort(found)
                hashes = np.concatenate([np.array([END, BEGIN], np.uint64), found[order]])
                name = np.empty(len(order), "<i4")
                name[order] = np.arange(2, len(order) + 2)
                ends = np.cumsum(lens + 1) - 1
                whole = np.zeros(int(lens.sum()) + len(lens), "<i4")
                inner = np.ones(len(whole), bool)
                inner[ends] = False
                whole[inner] = name[codes]
                apart = np.array(one.column(1).to_pylist(), bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([task << 24 | made], pa.int64()),
                        pa.array([one.column(0).to_pylist()], pa.list_(one.column(0).type)),
                        pa.array([apart.tolist()], pa.list_(pa.bool_())),
                        pa.array([(lens + 1).astype("<i8").tobytes()], pa.binary()),
                        pa.array([_pack(whole)], pa.binary()),
                        pa.array([EliasFano.of(hashes).tobytes()], pa.binary()),
                        pa.array([int((lens + 1)[~apart].sum())], pa.int64()),
                        pa.array([int((~apart).sum())], pa.int64()),
                    ],
                    ["block", "keys", "held", "lens", "codes", "hashes", "trained", "begun"],
                )
                made += 1

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, held.alias("held"), text).mapInArrow(
        run, f"block long, keys array<{kind}>, held array<boolean>, lens binary, codes binary, hashes binary, "
        "trained long, begun long",
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _joined(blobs: list[dict], kind) -> np.ndarray:
    """Answers of all shards, in the order of the shards."""
    parts = [_open(b["blob"], kind) for b in sorted(blobs, key=lambda b: b["shard"])]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _with(blocks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Blocks with what the shards answered them, a column ``a0``, ``a1``, ... each."""
    for i, a in enumerate(answers):
        mine = a.filter("block IS NOT NULL").groupBy("block").agg(
            F.collect_list(F.struct("shard", "blob")).alias(f"a{i}")
        )
        blocks = blocks.join(mine, "block", "left")
    return blocks


def _sent(batches, ask: Callable, shards: int):
    """A row for each shard that a block has something to ask."""
    for row in _rows(batches):
        block = Block(row)
        shard, columns = ask(block, row)
        cuts = np.searchsorted(shard, np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            at = slice(cuts[s], cuts[s + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([block.id], pa.int64()), pa.array([columns(at)], pa.list_(pa.binary()))],
                ["shard", "block", "parts"],
            )


def _by_shard(sent: DataFrame) -> DataFrame:
    return sent.repartition(partitions(sent.sparkSession), "shard").sortWithinPartitions("shard")


def counted(blocks: DataFrame, pick: Callable, shards: int, hot_over: float) -> DataFrame:
    """Counts over all blocks of the keys that ``pick`` finds in a block.

    ``pick(block, row)`` gives distinct keys, their training counts and a small tag each. Rows
    with a block answer it; rows without tell (tag, keys counted, count) and keys whose count
    is over ``hot_over``.
    """

    def ask(block, row):
        _, keys, counts, tags = pick_in_order(block, row, pick)
        return shard_of(keys, shards), lambda at: [EliasFano.of(keys[at]).tobytes(), _pack(counts[at].astype("<u4")), _pack(tags[at].astype("<u2"))]

    def answer(batches):
        for g in groups_of(batches, ["shard"]):
            shard, owners = g.column("shard")[0].as_py(), g.column("block").to_pylist()
            parts = [(EliasFano.frombytes(p[0]).values(), _open(p[1], "<u4"), _open(p[2], "<u2")) for p in g.column("parts").to_pylist()]
            keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            total = np.bincount(place, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)
            tag = np.zeros(len(keys), np.int64)
            tag[place] = np.concatenate([p[2] for p in parts])
            cuts = np.cumsum([0, *(len(p[0]) for p in parts)])
            out = [(b, shard, _pack(total[place[i:j]].astype("<u4")), None, None, None, None)
                   for b, i, j in zip(owners, cuts[:-1], cuts[1:])]
            seen = total > 0
            for t in np.unique(tag[seen]).tolist():
                own = seen & (tag == t)
                out.append((None, shard, None, t, None, int(own.sum()), int(total[own].sum())))
            for k in np.flatnonzero(total > hot_over).tolist():
                out.append((None, shard, None, None, int(keys[k].view(np.int64)), None, int(total[k])))
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)],
                ["block", "shard", "blob", "tag", "hot", "n", "total"],
            )

    sent = blocks.mapInArrow(lambda b: _sent(b, ask, shards), "shard int, block long, parts array<binary>")
    return durable(_by_shard(sent).mapInArrow(
        answer, "block long, shard int, blob binary, tag long, hot long, n long, total long"
    ))


def pick_in_order(block: Block, row: dict, pick: Callable):
    """What ``pick`` finds, by key: the order in which it is asked and answered."""
    keys, counts, tags = pick(block, row)
    order = np.argsort(keys)
    return order, keys[order], counts[order], tags[order]


def _words(block: Block, row: dict):
    n = len(block.hashes)
    return block.hashes, np.bincount(block.codes[block.trained], minlength=n), np.zeros(n, np.int64)


def _back(order: np.ndarray, answers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(order), answers.dtype)
    out[order] = answers
    return out


class Model:
    """What all blocks share: totals, and the words too frequent for one shard."""

    def __init__(self, tokens: int, kinds: int, begun: int, shards: int, hot: dict[int, int]):
        self.tokens, self.kinds, self.begun, self.shards = tokens, kinds, begun, shards
        self.hot = np.array(sorted({BEGIN, *hot}), np.uint64)
        self.total = np.array([hot.get(int(h), begun) for h in self.hot], np.int64)
        self.follow = np.zeros(len(self.hot), np.int64)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADDED) / (self.tokens + ADDED * (self.kinds + 1))

    def rank(self, hashes: np.ndarray) -> np.ndarray:
        """The number of a frequent word; -1 for any other."""
        at = np.minimum(np.searchsorted(self.hot, hashes), len(self.hot) - 1)
        return np.where(self.hot[at] == hashes, at, -1)

    def pairs(self, block: Block, row: dict):
        """Distinct pairs after frequent words: keys, training counts, the word's number."""
        _, own, counts, rank = self.pair_codes(block)
        v, w = own // len(block.hashes), own % len(block.hashes)
        return chain(block.hashes[v], block.hashes[w]), counts, rank

    def pair_codes(self, block: Block):
        size = len(block.hashes)
        first = block.before(block.codes)
        rank = self.rank(block.hashes)[first]
        code = first.astype(np.int64) * size + block.codes
        own, place = np.unique(code[rank >= 0], return_inverse=True)
        counts = np.bincount(place, block.trained[rank >= 0], len(own)).astype(np.int64)
        return code, own, counts, self.rank(block.hashes[own // size])

    def trigrams(self, block: Block, row: dict):
        """Distinct trigrams as asked: codes, training counts, lower codes, and who is asked.

        They come by middle word, first word and word, in the order of the hashes. Those after
        frequent words are named after both words and follow in an order of their own.
        """
        size = len(block.hashes)
        known = _joined(row["a0"] or [], "<u4").astype(np.float64)
        base = self.base(known)
        v = block.before(block.codes)
        u = block.before(v)
        starts = np.cumsum(block.lens) - block.lens
        u[starts] = 1
        u[(starts + 1)[block.lens > 1]] = 1
        code = (v.astype(np.uint64) * np.uint64(size) + u.astype(np.uint64)) * np.uint64(size) + block.codes.astype(np.uint64)
        own, place = np.unique(code, return_inverse=True)
        counts = np.bincount(place, block.trained, len(own)).astype(np.int64)
        w = (own % np.uint64(size)).astype(np.int64)
        uv = own // np.uint64(size)
        u, v = (uv % np.uint64(size)).astype(np.int64), (uv // np.uint64(size)).astype(np.int64)
        lower = base[w]
        rank = self.rank(block.hashes)[v]
        hot = np.flatnonzero(rank >= 0)
        context = block.hashes[v]
        if len(hot):
            order, _, _, _ = pick_in_order(block, row, self.pairs)
            seen = _back(order, _joined(row["a1"] or [], "<u4")).astype(np.float64)
            _, pair, _, _ = self.pair_codes(block)
            c = seen[np.searchsorted(pair, v[hot] * size + w[hot])]
            total = np.maximum(self.total[rank[hot]], 1)
            share = DISCOUNT * self.follow[rank[hot]] / total
            mixed = np.maximum(c - DISCOUNT, 0) / total + share * lower[hot]
            lower[hot] = np.where(self.total[rank[hot]] > 0, mixed, lower[hot])
            # a part of a frequent word is named after both words
            context[hot] = chain(context[hot], block.hashes[u[hot]])
            hot = hot[np.argsort(context[hot], kind="stable")]
        order = np.concatenate([np.flatnonzero(rank < 0), hot])
        shard = shard_of(context[order], self.shards)
        shard[len(order) - len(hot) :] += self.shards
        return order, shard, context, u, w, counts, quantise(lower), place, base


def _asked(block: Block, row: dict, model: Model):
    order, shard, context, u, w, counts, lower, _, _ = model.trigrams(block, row)
    context, counts, lower = context[order], counts[order], lower[order]
    u, w = block.hashes[u[order]] >> np.uint64(32), block.hashes[w[order]] >> np.uint64(64 - W_BITS)

    def columns(at):
        v, un, wn = context[at], u[at], w[at]
        new_v = np.concatenate([[True], v[1:] != v[:-1]])
        new_u = new_v | np.concatenate([[True], un[1:] != un[:-1]])
        first_v, first_u = np.flatnonzero(new_v), np.flatnonzero(new_u)
        three = wn.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
        return [
            EliasFano.of(v[first_v]).tobytes(),
            _pack(np.diff(np.append(np.searchsorted(first_u, first_v), len(first_u))).astype("<u4")),
            un[first_u].astype("<u4").tobytes(),
            _pack(np.diff(np.append(first_u, len(v))).astype("<u4")),
            three.tobytes(), _pack(counts[at].astype("<u4")), _pack(lower[at]),
        ]

    return shard, columns


def _received(parts: list[bytes]):
    v = EliasFano.frombytes(parts[0]).values()
    nv, un, nu = _open(parts[1], "<u4"), np.frombuffer(parts[2], "<u4"), _open(parts[3], "<u4")
    three = np.frombuffer(parts[4], np.uint8).reshape(-1, 3)
    w = np.zeros((len(three), 4), np.uint8)
    w[:, :3] = three
    return (np.repeat(np.repeat(v, nv), nu), np.repeat(un, nu), w.reshape(-1).view("<u4"), _open(parts[5], "<u4"),
            _open(parts[6], np.uint8))


def build(v, u, w, c, lower, mixed: bool) -> Trie:
    """The trie of a shard from the trigrams sent to it.

    ``lower`` are the probabilities to fall back on: of the word alone, or, with ``mixed``, of
    the word after the middle word, where that is a frequent one of which this is but a part.
    """
    names, vi = np.unique(v, return_inverse=True)
    contexts, ci = np.unique(vi.astype(np.uint64) << np.uint64(32) | u.astype(np.uint64), return_inverse=True)
    pairs, pi = np.unique(vi.astype(np.uint64) << np.uint64(W_BITS) | w.astype(np.uint64), return_inverse=True)
    count_p = np.bincount(pi, c, len(pairs))
    pair_v = (pairs >> np.uint64(W_BITS)).astype(np.int64)
    count_v = np.bincount(pair_v, count_p, len(names))
    follow_v = np.bincount(pair_v[count_p > 0], minlength=len(names))
    low = np.zeros(len(pairs), np.uint8)
    low[pi] = lower
    p1 = 10.0 ** logarithm(low)
    total = np.maximum(count_v, 1)[pair_v]
    p2 = np.maximum(count_p - DISCOUNT, 0) / total + (DISCOUNT * follow_v / np.maximum(count_v, 1))[pair_v] * p1
    p2 = p1 if mixed else np.where(count_v[pair_v] > 0, p2, p1)

    first = np.searchsorted(pairs, np.arange(len(names) + 1).astype(np.uint64) << np.uint64(W_BITS))
    rank = pi - first[vi]
    del pi
    tri, ti = np.unique(ci.astype(np.uint64) << np.uint64(W_BITS) | rank.astype(np.uint64), return_inverse=True)
    count_t = np.bincount(ti, c, len(tri))
    tri_c = (tri >> np.uint64(W_BITS)).astype(np.int64)
    count_c = np.bincount(tri_c, count_t, len(contexts))
    follow_c = np.bincount(tri_c[count_t > 0], minlength=len(contexts))
    context_v = (contexts >> np.uint64(32)).astype(np.int64)
    pair = first[context_v[tri_c]] + (tri & np.uint64((1 << W_BITS) - 1)).astype(np.int64)
    back = DISCOUNT * follow_c / np.maximum(count_c, 1)
    p3 = np.maximum(count_t - DISCOUNT, 0) / np.maximum(count_c, 1)[tri_c] + back[tri_c] * p2[pair]
    p3 = np.where(count_c[tri_c] > 0, p3, p2[pair])
    # only what training texts hold becomes a node; anything else is scored by backing off
    keep = count_t > 0
    levels = {
        "v": names, "w": pairs, "u": contexts, "t": tri[keep],
        "w_from": first.astype(np.uint64),
        "u_from": np.searchsorted(contexts, np.arange(len(names) + 1).astype(np.uint64) << np.uint64(32)).astype(np.uint64),
        "t_from": np.searchsorted(tri[keep], np.arange(len(contexts) + 1).astype(np.uint64) << np.uint64(W_BITS)).astype(np.uint64),
    }
    codes = {"p2": quantise(p2), "p3": quantise(p3[keep]), "back": quantise(np.where(count_c > 0, back, 1.0))}
    return Trie(levels, codes)


def look_up(trie: Trie, v, u, w) -> np.ndarray:
    """Codes of trigram probabilities: the node itself, or the shorter context times its weight."""
    names, words, contexts, tri = (trie.level(n) for n in ("v", "w", "u", "t"))
    first = trie.level("w_from").astype(np.int64)
    vi = np.searchsorted(names, v).astype(np.int64)
    pair = trie.search(words, vi, W_BITS, w)
    context = trie.search(contexts, vi, 32, u)
    node = trie.search(tri, context, W_BITS, pair - first[vi])
    less = logarithm(trie.code("back")[context]) + logarithm(trie.code("p2")[pair])
    p3 = trie.code("p3")
    own = logarithm(p3[np.maximum(node, 0)]) if len(p3) else less
    return quantise(10.0 ** np.where(node >= 0, own, less))


def _answered(batches, shards: int):
    for g in groups_of(batches, ["shard"]):
        shard, owners = g.column("shard")[0].as_py(), g.column("block").to_pylist()
        parts = [_received(p) for p in g.column("parts").to_pylist()]
        cuts = np.cumsum([0, *(len(p[0]) for p in parts)])
        v, u, w, c, lower = (np.concatenate([p[i] for p in parts]) for i in range(5))
        del parts
        trie = build(v, u, w, c, lower, shard >= shards)
        try:
            codes = look_up(trie, v, u, w)
        finally:
            trie.drop()
        yield pa.RecordBatch.from_arrays(
            [pa.array(owners, pa.int64()), pa.array([shard] * len(owners), pa.int32()),
             pa.array([_pack(codes[i:j]) for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())],
            ["block", "shard", "blob"],
        )


def _bucketed(blocks: DataFrame) -> DataFrame:
    """Blocks written down by their number, so answers come to them and they are not shuffled."""
    spark = blocks.sparkSession
    name, path = f"blocks_{uuid.uuid4().hex}", work_dir(spark, "blocks")
    blocks.write.bucketBy(partitions(spark), "block").option("path", path).saveAsTable(name)
    return spark.table(name)


def _free(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished steps: they go once the driver forgets them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scores(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    The model learns from rows where ``held`` is false or null. A null or empty text is its end
    mark alone. Rows with null keys stay, repeated rows are scored alike (and count as often as
    they occur), other columns are ignored. Without any training text every word is new.
    """
    spark = docs.sparkSession
    blocks = _bucketed(read_blocks(docs, F.coalesce(held, F.lit(False)), key, text))
    size = blocks.agg(F.count("*").alias("b"), F.sum("trained").alias("t"), F.sum("begun").alias("d")).first()
    tokens, begun, shards = size["t"] or 0, size["d"] or 0, max(8, size["b"])
    known = counted(blocks, _words, shards, tokens / shards)
    kinds = known.filter("tag IS NOT NULL").agg(F.sum("n")).first()[0] or 0
    hot = {r["hot"] % 2**64: r["total"] for r in known.filter("hot IS NOT NULL").select("hot", "total").collect()}
    model = Model(tokens, kinds, begun, shards, hot)  # fewer frequent words than shards
    after = counted(blocks, model.pairs, shards, float("inf"))
    for r in after.filter("tag IS NOT NULL").groupBy("tag").agg(F.sum("n").alias("n")).collect():
        model.follow[r["tag"]] = r["n"]
    _free(spark)
    asked = _with(blocks, known, after).mapInArrow(
        lambda b: _sent(b, lambda block, row: _asked(block, row, model), 2 * shards), "shard int, block long, parts array<binary>"
    )
    third = durable(_by_shard(asked).mapInArrow(lambda b: _answered(b, shards), "block long, shard int, blob binary"))
    del asked
    _free(spark)

    def run(batches):
        for row in _rows(batches):
            block = Block(row)
            order, *_, place, base = model.trigrams(block, row)
            own = logarithm(_back(order, _joined(row["a2"] or [], np.uint8)))[place]
            count = len(block.lens)
            plain = np.log10(base)[block.codes]
            seen = base[block.codes] > model.base(0.0) * (1 + 1e-12)
            total = [np.bincount(block.doc, x, count) for x in (seen, plain, own)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.keys, batch_type), pa.array(block.held), pa.array(block.lens), pa.array(total[0].astype(np.int64)),
                    pa.array([model.tokens] * count, pa.int64()), pa.array(total[1]), pa.array(total[2]),
                ],
                [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    from pyspark.sql.pandas.types import to_arrow_type

    batch_type = to_arrow_type(docs.schema[key].dataType)
    kind = docs.schema[key].dataType.simpleString()
    return _with(blocks, known, after, third).mapInArrow(
        run, f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


@query("op2_lm_scores")
def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"), remainder("doc_id", 10) == 0)
