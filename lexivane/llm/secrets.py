"""Secrets by patterns and by Markov models of characters, in DataFrame functions alone.

Three patterns name assignments, access keys and long hexadecimal runs. Other long strings are
judged by two first-order Markov models over characters: one of random strings, one of
ordinary identifiers. The mean log-likelihood ratio of a string's transitions decides. The
models are trained from labelled samples: values that the patterns found are random strings,
short words of other kinds and common words of programs are identifiers, in all their ways of
writing. Each distinct string counts by the logarithm of how often it is seen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import durable
from .common import query, table

ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
# a value starts right after the "=" of its name too; padding ends a string
STRING = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
WORD = r"[A-Za-z0-9+/_-]{5,}"
KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
SAMPLE_ROWS = 5000
BORROWED = 20.0
LEAST_MEAN = 0.35
LEAST_TOTAL = 14.0

# fixed values: common words in names of programs
COMMON = (
    "abstract access account action active address after alias allow application argument array async attribute "
    "author backup base before block body buffer build bundle button bytes cache callback change character check "
    "child class clear client close cluster code collection color column command commit common component config "
    "connection constant container content context control convert count create current custom data database date "
    "debug default define delete description device dictionary directory disable display document domain download "
    "driver dynamic editor element email enable encoding engine entry environment error event example exception "
    "execute export factory failed false feature field file filter find first flag folder font force format frame "
    "function generator global graph group handler hash header height helper hidden history host identifier image "
    "import index info initial input insert instance integer interface internal item iterator join keyboard label "
    "language last layer layout length level library license limit line link list listener load local location "
    "logger login main manager map match maximum memory menu message method minimum mode model module mouse name "
    "namespace native network node notification number object observer offset open operator option order output "
    "owner package page panel parameter parent parse path pattern permission player plugin point policy position "
    "prefix previous print private process product profile project property protocol provider proxy public query "
    "queue random range read record reference register release remote remove render replace report request reset "
    "resource response result return role root route row sample scale schema scope screen script search second "
    "section select sequence serial server service session setting shadow shape share signature simple single size "
    "socket sort source stack start state static status storage stream string style subject submit suffix support "
    "switch symbol system table target task template test text thread time title total transaction transform tree "
    "trigger type unique update upload user utility valid value variable vector version view visible warning watch "
    "width window word worker write get set add put has can with from into not key new old for and the is by of to on"
).split()

NONE = "array<struct<start int, stop int, value string>>"


def spans(text: str, pattern: str, value: Column | None = None) -> Column:
    """(start, stop, value) of all matches, in code points: what lies between matches is cut out
    by the same pattern, so lengths add up to positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(acc, i):
        start = acc["at"] + F.length(F.get(acc["gaps"], i))
        word = F.get(acc["found"], i)
        stop = start + F.length(word)
        one = F.struct(start.alias("start"), stop.alias("stop"), word.alias("value"))
        return F.struct(
            stop.alias("at"), acc["gaps"].alias("gaps"), acc["found"].alias("found"),
            F.array_append(acc["out"], one).alias("out"),
        )

    first = F.struct(
        F.lit(0).alias("at"), F.split(text, pattern, -1).alias("gaps"), found.alias("found"),
        F.array().cast(NONE).alias("out"),
    )
    # texts without a match are many and cost one search
    return F.when(
        F.col(text).rlike(pattern),
        F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), first, step, lambda acc: acc["out"]),
    ).otherwise(F.array().cast(NONE))


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column ``text``) and one column of spans for each base kind and strings."""
    found = docs.select("*", spans("text", ASSIGN).alias("assign"), spans("text", ACCESS).alias("access"),
                        spans("text", HEX).alias("hex"), spans("text", STRING).alias("strings"))
    value = lambda s: F.regexp_extract(s["value"], ASSIGN, 1)
    kept = F.filter("assign", lambda s: F.length(value(s)) >= 6)
    named = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), value(s).alias("value")))
    return found.withColumn("assign", named)


def _transitions(strings: DataFrame) -> DataFrame:
    """(y, pair, n): how much characters follow each other in strings of both labels."""
    weighed = strings.groupBy("y", "s").agg(F.log1p(F.count("*")).alias("n"))
    low, up, cap = F.lower("s"), F.upper("s"), F.concat(F.upper(F.substring("s", 1, 1)), F.expr("lower(substring(s, 2))"))
    # names join words by signs or capitals, and constants are in upper case
    forms = F.array("s", *(F.concat(a, F.lit(by), a) for a in (low, up) for by in "_-/"), F.concat(cap, cap))
    written = F.when(F.col("y") == 1, F.array("s")).otherwise(forms)
    return weighed.select("y", "n", F.explode(written).alias("s")).select("y", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring("s", i, 2)
    )).alias("pair")).groupBy("y", "pair").agg(F.sum("n").alias("n"))


def train(found: DataFrame, docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[float]:
    """Log-likelihood ratio of each transition, in the order of ``ALPHABET`` squared.

    ``found`` holds base spans: its values are the random strings. Identifiers are ``COMMON`` and
    the words of ``rows`` documents, those of the smallest hashes, that the patterns left alone.
    At most ``len(ALPHABET) ** 2`` sums of each label reach the driver.
    """
    secret = found.select(F.explode(F.flatten(F.array(*(F.transform(k, lambda s: s["value"]) for k in BASE)))).alias("s"))
    ids = durable(docs.select("doc_id").filter("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    blank = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    plain = docs.select("doc_id", "text").join(ids.distinct(), "doc_id", "left_semi").select(
        F.explode(F.regexp_extract_all(blank, F.lit(WORD), F.lit(0))).alias("s")
    )
    labelled = secret.filter(F.length("s") > 1).select(F.lit(1).alias("y"), "s").unionByName(
        # what is to be judged is no label: long strings stay out
        plain.filter(F.length("s") < 20).select(F.lit(0).alias("y"), "s")
    ).unionByName(
        found.sparkSession.range(1).select(F.lit(0).alias("y"), F.explode(F.split(F.lit(" ".join(COMMON)), " ")).alias("s"))
    )
    known = {(r["y"], r["pair"]): r["n"] for r in _transitions(labelled).filter(
        F.col("pair").rlike(r"^[A-Za-z0-9+/_=.-]{2}$")
    ).collect()}
    models = []
    for y in (1, 0):
        # a character that was rarely seen before another borrows from how often it is seen at all
        every = {b: 1 + sum(known.get((y, a + b), 0) for a in ALPHABET) for b in ALPHABET}
        after = {a: sum(known.get((y, a + b), 0) for b in ALPHABET) for a in ALPHABET}
        # and all characters are as likely in a random string
        share = {b: 1 / len(ALPHABET) if y else n / sum(every.values()) for b, n in every.items()}
        models.append([
            math.log((known.get((y, a + b), 0) + BORROWED * share[b]) / (after[a] + BORROWED))
            for a in ALPHABET for b in ALPHABET
        ])
    return [p - q for p, q in zip(*models)]


def ratio(string: Column, model: list[float]) -> Column:
    """Sum of the log-likelihood ratios of a string's transitions."""
    weights = F.split(F.lit(",".join(f"{w:.5f}" for w in model)), ",").cast("array<double>")
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(string, i, 1)) - 1
    return F.aggregate(
        F.sequence(F.lit(1), F.length(string) - 1), F.lit(0.0),
        lambda acc, i: acc + F.coalesce(F.get(weights, place(i) * len(ALPHABET) + place(i + 1)), F.lit(0.0)),
    )


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) for every row: spans are (kind, start, stop, value) by start, then kind.

    Strings that the patterns found are not judged again. Null and empty texts have no spans;
    rows with a null key stay, repeated rows repeat their result, other columns are ignored.
    Without any secret to learn from, random strings are those of evenly likely characters.
    """
    source = docs.select(F.col(key).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    found = durable(base_spans(source).drop("text"))
    model = train(found, source)
    base = F.concat(*BASE)
    apart = lambda s: ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    free = found.withColumn("strings", F.filter("strings", apart))
    scored = free.withColumn("strings", F.transform("strings", lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"), ratio(s["value"], model).alias("llr")
    )))
    random = F.filter("strings", lambda s: (s["llr"] >= LEAST_TOTAL) & (
        s["llr"] >= LEAST_MEAN * (F.length(s["value"]) - 1)))

    def named(found, kind: str) -> Column:
        return F.transform(found, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"),
            s["stop"].alias("stop"), s["value"].alias("value"),
        ))

    parts = [*(named(k, k) for k in BASE), named(random, "random")]
    every = F.transform(F.array_sort(F.concat(*parts)), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value")
    ))
    return scored.select(F.col("doc_id").alias(key), every.alias("spans"))


def written(column: Column) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


@query("op6_secrets")
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", *(count(k) for k in KINDS), F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
