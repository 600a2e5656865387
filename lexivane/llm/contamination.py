"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Words are hashed in groups of ``GRAM``; of each run of ``WINDOW - GRAM + 1`` neighbouring
hashes the smallest is a fingerprint. A shared span of ``WINDOW`` words holds the same run on
both sides, hence the same fingerprint, so none is missed. Fingerprints of documents and items
are joined; where they meet, the two texts are laid over each other at that shift and equal
stretches are extended to their full length. Items shorter than a window count as one window
and are found by the hash of all their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import durable
from .common import query, table

GRAM = 5
WINDOW = 10
SALTS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """Words of a text, A-Z in lower case: runs of digits, letters and non-ASCII characters."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def grams(n: int) -> Column:
    """Hashes of all runs of ``n`` words of the column ``words``, by position."""
    return F.when(
        F.size("words") >= n,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - n),
            lambda i: F.xxhash64(*(F.get("words", i + k) for k in range(n))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def smallest(hashes: str) -> Column:
    """The distinct smallest hashes of all windows."""
    run = WINDOW - GRAM + 1
    return F.when(
        F.size(hashes) >= run,
        F.array_distinct(
            F.transform(
                F.sequence(F.lit(1), F.size(hashes) - run + 1),
                lambda i: F.array_min(F.slice(hashes, i, run)),
            )
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_salt", F.pmod(F.xxhash64("k"), F.lit(SALTS)).cast("int"))


def _spread(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _seeds(docs: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """(k, item_id, shift) where a group of ``n`` words of document and item are equal."""
    found = docs.select("k", F.posexplode(grams(n)).alias("at", "h"))
    asked = items.select("item_id", F.posexplode(grams(n)).alias("item_at", "h"), *(
        ["prints"] if "prints" in items.columns else []
    ))
    if "prints" in items.columns:
        asked = asked.filter(F.array_contains("prints", F.col("h"))).drop("prints")
    return (
        _salted(found).join(_spread(asked), ["h", "_salt"])
        .select("k", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``.

    ``n_hit`` counts the words inside any run of ``WINDOW`` words (or all words, if fewer) of
    an item. Null and empty texts have no words and no hits; items without words and without
    an id never occur; rows with a null key stay and are judged by their text; repeated rows
    have equal results. Other columns are ignored.
    """
    source = docs.select(F.col(key).alias("key"), F.xxhash64(key, text).alias("k"), F.col(text).alias("text"))
    items = durable(
        benchmark.filter(F.col(item).isNotNull()).select(
            F.col(item).cast("string").alias("item_id"), words(item_text).alias("words")
        ).filter(F.size("words") > 0).distinct()
    )
    long_items = items.filter(F.size("words") >= WINDOW)
    short = sorted(r[0] for r in items.filter(F.size("words") < WINDOW).select(F.size("words")).distinct().collect())
    prints = long_items.withColumn("h", grams(GRAM)).withColumn("prints", smallest("h")).drop("h")
    asked = prints.select(F.lit(0).alias("n"), F.explode("prints").alias("h"))
    for n in short:
        asked = asked.unionByName(
            items.filter(F.size("words") == n).select(F.lit(n).alias("n"), F.explode(grams(n)).alias("h"))
        )
    asked = durable(asked.distinct())

    cut = source.select("key", "k", words("text").alias("words")).withColumn("h", grams(GRAM))
    read = durable(cut.select(
        "key", "k", F.size("words").cast("bigint").alias("n_words"),
        smallest("h").alias("f0"), *(F.array_distinct(grams(n)).alias(f"f{n}") for n in short),
    ))
    marks = None
    for n in [0, *short]:
        one = read.select("k", F.lit(n).alias("n"), F.explode(f"f{n}").alias("h"))
        marks = one if marks is None else marks.unionByName(one)
    suspects = durable(
        _salted(marks).join(_spread(asked), ["n", "h", "_salt"]).select("k").distinct()
    )
    texts = durable(
        source.select("k", "text").join(suspects, "k", "left_semi")
        .select("k", words("text").alias("words")).dropDuplicates(["k"])
    )
    seeds = _seeds(texts, prints, GRAM)
    for n in short:
        seeds = seeds.unionByName(_seeds(texts, items.filter(F.size("words") == n), n))

    # lay the item over the document at the shift, and keep every full window of equal words
    start, item_start = F.greatest("shift", F.lit(0)), F.greatest(-F.col("shift"), F.lit(0))
    length = F.least(F.size("words") - start, F.size("item_words") - item_start)
    need = F.least(F.lit(WINDOW), F.size("item_words"))
    laid = (
        seeds.join(items.withColumnRenamed("words", "item_words"), "item_id")
        .join(texts, "k")
        .select("k", "item_id", start.alias("start"), need.alias("need"), F.zip_with(
            F.slice("words", start + 1, length), F.slice("item_words", item_start + 1, length),
            lambda a, b: a == b,
        ).alias("same"))
        .filter(F.size("same") >= F.col("need"))
        .select("k", "item_id", "need", F.transform(
            F.filter(
                F.sequence(F.lit(0), F.size("same") - F.col("need")),
                lambda i: ~F.array_contains(F.slice("same", i + 1, F.col("need")), False),
            ),
            lambda i: i + F.col("start"),
        ).alias("windows"))
        .filter(F.size("windows") > 0)
    )
    covered = F.flatten(F.transform("windows", lambda s: F.sequence(s, s + F.col("need") - 1)))
    hits = laid.select("k", "item_id", F.array_distinct(covered).alias("hit")).groupBy("k").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("bigint").alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    none = F.array().cast("array<string>")
    return read.select("key", "k", "n_words").join(hits, "k", "left").select(
        F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", none)).cast("binary"), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, unchanged, whose texts hold no window of any item.

    Rows are matched by id and text, so equal rows are kept or dropped together.
    """
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    bad = contamination(keyed.select("_row", "text"), benchmark, key="_row").filter("contaminated")
    return keyed.join(bad.select("_row").distinct(), "_row", "left_anti").drop("_row")


SQL = r"""
WITH w AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS words FROM benchmark),
n AS (SELECT DISTINCT least(len(words), 10) AS n FROM b WHERE len(words) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS win
  FROM (SELECT item_id, words, least(len(words), 10) AS n, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM b WHERE len(words) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, n WHERE len(words) >= n)),
h AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""


@query("op7_decontamination", SQL)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
