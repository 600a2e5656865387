"""Operators on documents against brute-force versions, on the smallest table and on odd rows."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lexivane.llm import common, contamination, minhash, packing, pii, toxicity
from lexivane.llm.common import ORACLE, QUERIES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"

ODD = [
    (1, None, "en", "x"),
    (2, "", "en", None),
    (3, "   \n\t ", None, "x"),
    (4, "One two three.", "en", "x"),
    (5, "One two three.", "en", "x"),
    (6, "one TWO three.", "en", "x"),
    (6, "one TWO three.", "en", "x"),
    (None, "no id at all, mail a@b.org", "en", "x"),
    (7, "word " * 30_000, "en", "x"),
    (8, " ".join(f"w{i}" for i in range(60)), "en", "x"),
    (9, " ".join(f"w{i}" for i in range(60)) + " tail", "en", "x"),
    (10, "1" * 20_000 + ".2.3.4", "en", "x"),
    (11, "Ünïcode Ärger ſ K x" * 3, "de", "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    # clashing names: text of other columns must not matter
    return spark.createDataFrame(
        [(*r, i, "k", 0, None) for i, r in enumerate(ODD)],
        "doc_id long, text string, lang string, source string, n_chars long, key string, row long, words array<string>",
    )


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- personal data -------------------------------------------------------------------


def base_spans(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, f"email:{m.start()}:{m.end()}"))
    for m in re.finditer(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) <= 3 and int("0" + p.lstrip("0")) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, f"ip:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19:
            s = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1]))
            if s % 10 == 0:
                out.append((m.start(), 2, f"card:{m.start()}:{m.end()}"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, f"phone:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_pii_base(spark):
    texts = {r.doc_id: r.text for r in small(spark).collect()}
    rows = QUERIES["op4_pii"](spark, SF).collect()
    assert len(rows) == len(texts) and sum(r.n_email for r in rows) > 0
    for r in rows:
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_pii_hard_cases():
    found = pii.automaton()
    for text in (
        "a@b@c.de x@y.z@q.com @x.y .@a.b a@b. a@b..c x@-.-", "1.2.3.4.5.6.7.8 1.2.3.256 01.002.3.4 ...1.2.3.4",
        "4111 1111 1111 1111 4111-1111-1111-1111-2 4111  1111", "+1 (234) 567-8901. ++12345678901 +1+234567890123 +49.",
        "+4111111111111111", "", "é@é.é a@é.b ٣.٣.٣.٣", "9" * 5000 + " 1.1.1." + "9" * 5000,
        "1.2.3." + "0" * 5000 + "1", "0" * 5000 + ".0.0.255 " + "0" * 5000 + ".0.0.256",
    ):
        got = [s for s in pii.find(text, found) if s[0] in pii.BASE]
        assert pii.written(got) == base_spans(text), text


def test_pii_added_kinds_and_redaction():
    found = pii.automaton()
    text = "IBAN: DE89 3704 0044 0532 0130 00, see ftp://bob:pw@host.org/x or https://ok.org, ssn 078-05-1120"
    kinds = [s[0] for s in pii.find(text, found)]
    assert kinds.count("account") == 2 and kinds.count("address") == 1
    clean = pii.redacted(text, pii.find(text, found))
    assert "bob" not in clean and "DE89" not in clean and "https://ok.org" in clean
    assert pii.find("iban DE89 3704 0044 0532 0130 01", found) == []


def test_pii_odd(odd, none):
    rows = pii.personal_data(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.doc_id for r in rows if r.spans} == {None}
    out = pii.redact(odd)
    assert out.columns == odd.columns and out.count() == len(ODD)
    assert pii.personal_data(none).count() == 0 and pii.redact(none).count() == 0


# --- near duplicates -----------------------------------------------------------------


def brute_components(rows, size, percent):
    sets = {}
    for doc_id, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    top = {d: d for d in sets}

    def root(d):
        while top[d] != d:
            d = top[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(spark, size):
    docs = small(spark)
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()], size, 80)
    rows = minhash.near_duplicates(docs, size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """Large groups of different texts, some linked only through others."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = np.random.default_rng(3)
    base = [f"t{i}" for i in range(100)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in rng.integers(0, 100, rng.integers(0, 4)):
            w[j] = f"x{rng.integers(1_000_000)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(f"u{i}_{j}" for j in range(20))) for i in range(20)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 4, 80)


def test_tasks_return_freed_memory(spark, monkeypatch):
    """All tasks of near duplicates and of toxicity return it where they begin and end."""
    calls, wrapped = [], []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    assert list(common.thrifty(lambda b: (x + len(calls) for x in b))(iter([1, 2]))) == [2, 3] and len(calls) == 2
    for module in (minhash, toxicity):
        monkeypatch.setattr(module, "thrifty", lambda run: wrapped.append(run) or run)
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, "x")], "doc_id long, text string")
    assert [r.doc_id for r in minhash.keep_one(docs).orderBy("doc_id").collect()] == [1, 3]
    assert len(wrapped) == 4
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    toxicity.keep_clean(docs, labels)
    assert len(wrapped) > 4


def test_packing_and_redaction_take_small_slices(spark):
    tasks = []

    class Seen:
        schema, columns = spark.range(1).selectExpr("id AS doc_id", "'' AS text").schema, ["doc_id", "text"]

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            tasks.append(run)
            return self

    pii.redact(Seen())
    packing.pieces(Seen(), packing.word_bpe())
    texts = pa.array(["mail a@b.org now " * 30_000] * 20)  # 10 MB
    keys = pa.array(range(20), pa.int64())
    wholes = [pa.record_batch([keys, texts], ["doc_id", "text"]), pa.record_batch([keys, keys, texts], ["doc_id", "row", "text"])]
    for run, whole in zip(tasks, wholes):
        out = list(run(iter([whole])))
        assert len(out) >= 5 and sorted({k for b in out for k in b.column(0).to_pylist()}) == list(range(20))


def test_packing_sends_small_batches(spark, monkeypatch):
    name, seen, write = "spark.sql.execution.arrow.maxBytesPerBatch", [], packing.durable
    monkeypatch.setattr(packing, "durable", lambda df: seen.append(int(spark.conf.get(name))) or write(df))
    before = spark.conf.get(name, None)
    packing.pack(small(spark).limit(20), packing.word_bpe()).collect()
    assert seen == [4 << 20] and spark.conf.get(name, None) == before


def test_near_duplicates_odd(odd, none):
    rows = minhash.near_duplicates(odd, 4).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert got[1] == (0, 1, True) and got[3] == (0, 3, True)
    assert got[5] == got[6] == (1, 4, False) and got[9] == (58, 8, False)
    assert got[None][1:] == (None, True) and got[7] == (1, 7, True)
    assert minhash.near_duplicates(none, 4).count() == 0
    assert sorted(r.doc_id or 0 for r in minhash.keep_one(odd).collect()) == [0, 1, 2, 3, 4, 7, 8, 10, 11]
    assert minhash.keep_one(odd).columns == odd.columns


# --- benchmark passages --------------------------------------------------------------


def test_contamination_brute_force(spark):
    split = lambda t: [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    items = [(r.item_id, split(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    wins = {}
    for item, w in items:
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    sizes = {len(k) for k in wins}
    texts = {r.doc_id: r.text for r in small(spark).collect()}
    rows = QUERIES["op7_decontamination"](spark, SF).collect()
    assert len(rows) == len(texts) and any(r.contaminated for r in rows)
    for r in rows:
        w, hit, found = split(texts[r.doc_id]), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (one := wins.get(tuple(w[i : i + n]))):
                    hit.update(range(i, i + n))
                    found |= one
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(w), len(hit), len(found), digest, bool(hit))


def test_contamination_odd(spark, odd, none):
    bench = spark.createDataFrame(
        [("b", " ".join(f"w{i}" for i in range(40, 52))), ("a", "Two, THREE"), (None, "one"), ("n", None),
         ("e", ""), ("r", "word " * 12), ("r", "word " * 12)], "item_id string, text string"
    )
    rows = contamination.contamination(odd, bench).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in rows}
    assert len(rows) == len(ODD)
    assert got[8] == (60, 12, 1) and got[9] == (61, 12, 1) and got[6] == (3, 2, 1)
    assert got[7] == (30_000, 30_000, 1) and got[1] == (0, 0, 0)
    kept = contamination.keep_uncontaminated(odd, bench)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {None, 1, 2, 3, 10, 11}
    assert contamination.contamination(none, bench).count() == 0
    assert contamination.contamination(odd, bench.limit(0)).filter("contaminated").count() == 0


# --- packing -------------------------------------------------------------------------


def check_packing(rows, texts):
    model = packing.tokenizer(packing.word_bpe())
    want = {d: np.array([*model.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in texts}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        part = want[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length > 0 and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(want[r.doc_id])
    for d, ids in want.items():
        got = sorted((r.start, r.length) for r in by_doc[d])
        assert sum(n for _, n in got) == len(ids) and got[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in zip(got, got[1:]))
    for group in by_sequence.values():
        group.sort(key=lambda r: r.offset)
        end = 0
        for r in group:
            assert r.offset == end
            end += r.length
        assert end <= packing.SEQUENCE
    return sum(r.length for r in rows) / (len(by_sequence) * packing.SEQUENCE)


def test_packing(spark):
    fill = check_packing(
        QUERIES["op5_packing"](spark, SF).collect(), [(r.doc_id, r.text) for r in small(spark).collect()]
    )
    assert fill > 0.97


def test_token_ids_by_word_equal_those_of_whole_texts():
    model = packing.tokenizer(packing.word_bpe())
    texts = ["", "  ", "Don't  stop\u00a0now, caf\u00e9 cafe\u0301 \u0301x \u2028y", "a<|endoftext|>b <|startoftext|> c", "\u03a3\u03a3 \u03a3. \u0130\u1e9e \ufb01",
             "\U0001f600\U0001f468\u200d\U0001f469 x\x1cy\x0bz\x85w", "1234 5,6", None, "\x00 \x01"] + ["word \n\t ing's"] * 3
    encoder = packing.Encoder(packing.word_bpe())
    assert encoder.lowers and encoder.parts_marks
    texts += ["Hello, World!? don't \u00c9a, A\u030a. x\u0301, a,\u0301 b.\x0bC;\nend.", "DOG'S a.b. ...z ab,cd, (x)!", "K\u0130. \u03a3A\u03a3, 12. A1."]
    for _ in range(2):  # the second time from what it knows
        sizes, flat = encoder.ids(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes))[:-1]] == [model.encode(t or "", add_special_tokens=False).ids for t in texts]


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, model):
        self.model, self.texts = model, []

    def encode_batch_fast(self, texts, **how):
        self.texts += texts
        return self.model.encode_batch_fast(texts, **how)


def test_few_calls_of_the_tokenizer(monkeypatch):
    """Words of letters are encoded together, marks apart, and frequent words stay known."""
    monkeypatch.setattr(packing, "KNOWN_WORDS", 400)
    encoder, plain = packing.Encoder(packing.word_bpe()), packing.tokenizer(packing.word_bpe())
    encoder.model = Counted(encoder.model)
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz\u00e9\u00df\u00d1"))
    for _ in range(6):
        words = ["".join(rng.choice(letters, 9)) for _ in range(300)]
        text = " ".join(["often'7", *words, words[0] + "###", words[1] + "$*,"])
        _, flat = encoder.ids(pa.array([text]))
        assert flat.tolist() == plain.encode(text, add_special_tokens=False).ids
    sent = encoder.model.texts
    assert sent.count("often'7") == 1 and len(sent) < 60
    assert len(encoder.known) + len(encoder.older) < 1000


def test_packing_plan_is_near_the_bound():
    rng = np.random.default_rng(1)
    counts = {int(n): int(rng.integers(1, 500)) for n in rng.choice(np.arange(1, 257), 60, replace=False)}
    made = packing.plan(counts, 256)
    placed = {}
    for times, each in made:
        assert sum(n * k for n, k in each.items()) <= 256
        for n, k in each.items():
            placed[n] = placed.get(n, 0) + times * k
    assert placed == counts
    lengths = sorted(counts)
    bound = sum(use for use, _ in packing.solve(lengths, [counts[n] for n in lengths], 256))
    assert bound >= sum(n * c for n, c in counts.items()) / 256 - 1e-6
    assert sum(t for t, _ in made) <= bound + 10


def test_packing_odd(spark, odd, none):
    docs = odd.filter("doc_id NOT IN (6)")
    rows = packing.pack(docs, packing.word_bpe(), with_ids=True).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert all(len(r.ids) == r.length for r in rows)
    assert packing.pack(none, packing.word_bpe()).count() == 0
    assert packing.pack(odd.filter("doc_id = 6"), packing.word_bpe()).count() == 2


@pytest.mark.parametrize("name", ["op7_decontamination", "op9_minhash"])
def test_against_sql(spark, name):
    assert compare(spark, connect(SF), SF, QUERIES[name], ORACLE[name]) is None


# --- toxicity ------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    scores = QUERIES["op3_toxicity"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scores.join(labels, "doc_id").filter("held_out").collect()
    assert {r.held_out for r in scores.collect()} == {True, False}
    pos = [r.score for r in rows if r.toxic == 1]
    neg = [r.score for r in rows if r.toxic == 0]
    auc = np.mean([[(p > n) + 0.5 * (p == n) for n in neg] for p in pos])
    assert auc > 0.95
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95


def test_toxicity_against_plain(spark):
    """Counts, ratios and the choice of n-grams, and scores as sums, each computed again in plain Python."""
    texts = [(i, f"good words here number {i % 7} and {'vile awful slur' if i % 4 == 0 else 'kind calm reply'} {i}") for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    marks = [(i, int(i % 4 == 0)) for i, _ in texts]
    model = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    learned = [(set(toxicity.ngrams(t).tolist()), y) for (i, t), (_, y) in zip(texts, marks) if zlib.crc32(str(i).encode()) % 3 != 1]
    n = [sum(y == c for _, y in learned) for c in (0, 1)]
    kept = {}
    for f in set().union(*(s for s, _ in learned)):
        k = [sum(f in s for s, y in learned if y == c) for c in (0, 1)]
        both = sum(k) / sum(n)
        if both == 1:
            continue
        g = 2 * sum(
            (k[c] * np.log(k[c] / n[c] / both) if k[c] else 0)
            + ((n[c] - k[c]) * np.log((1 - k[c] / n[c]) / (1 - both)) if k[c] < n[c] else 0) for c in (0, 1)
        )
        r = np.log((k[1] + 0.5) / (n[1] + 1)) - np.log((k[0] + 0.5) / (n[0] + 1))
        if g >= min(toxicity.EVIDENCE) and abs(r) >= toxicity.LEAST_RATIO:
            kept[f] = r
    assert model.features.tolist() == sorted(kept)
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    for row in toxicity.score(docs, model).collect():
        z = model.bias + sum(weight.get(f, 0.0) for f in set(toxicity.ngrams(texts[row.doc_id][1]).tolist()))
        assert row.score == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        assert row.predicted == int(row.doc_id % 4 == 0)


def test_toxicity_odd(spark, odd, none):
    labels = spark.createDataFrame([(8, 1), (4, 0), (None, 1), (5, None), (9, 7)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0), labels.filter("toxic = 1"), labels.filter("toxic = 0")):
        rows = toxicity.score(odd, toxicity.fit(odd, known)).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(none, toxicity.fit(odd, labels)).count() == 0
    assert toxicity.fit(odd, labels.limit(0)).bias == 0
    kept = toxicity.keep_clean(odd, labels.filter("toxic = 0"))
    assert kept.columns == odd.columns and kept.count() == len(ODD)
