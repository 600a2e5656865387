"""Column functions over text: tokens, fixed-size groups, chunks, ids, prompts."""

from __future__ import annotations

from pyspark.ml.feature import NGram, StopWordsRemover
from pyspark.sql import Column, DataFrame, functions as F

from .vector import bind

# Fixed value: word characters are Unicode letters, digits and underscore, two or more.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

MAX_STOP_WORDS = 100_000


def tokens(text: Column | str) -> Column:
    """Lower-case word tokens of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def token_count(text: Column | str) -> Column:
    return F.coalesce(F.size(tokens(text)).cast("bigint"), F.lit(0).cast("bigint"))


def batched(values: Column | str, n: int) -> Column:
    """Groups of ``n`` consecutive elements; the last one may be short."""
    if n < 1:
        raise ValueError("n must be at least one")
    values = F.col(values) if isinstance(values, str) else values

    def groups(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(v), F.lit(n))
        cut = F.transform(starts, lambda i: F.slice(v, i, F.lit(n)))
        return F.when(F.size(v) > 0, cut).otherwise(F.slice(F.array(v), 1, 0))

    return bind(values, groups)


def token_chunks(text: Column | str, context_limit: int, special_tokens: int = 0) -> Column:
    """Chunks of at most ``context_limit - special_tokens`` tokens, cut from the original text.

    A token takes all characters up to the next one with it, and what comes before the first
    token opens the first chunk, so the chunks add up to the text. A text without tokens is
    one chunk, an empty one none.
    """
    text = F.col(text) if isinstance(text, str) else text
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0)).alias("token"),
        F.split(text, TOKEN_PATTERN, -1).alias("gap"),
    )

    def cut(p: Column) -> Column:
        after = F.slice(p["gap"], 2, F.size(p["token"]))
        units = F.zip_with(p["token"], after, lambda t, g: F.concat(t, g))
        groups = batched(units, context_limit - special_tokens)
        return F.transform(groups, lambda g, i: F.concat(
            F.when(i == 0, F.get(p["gap"], F.lit(0))).otherwise(""), F.array_join(g, "")
        ))

    return (
        F.when(F.length(text) == 0, F.slice(F.array(text), 1, 0))
        .when(~text.rlike(TOKEN_PATTERN), F.array(text))
        .otherwise(bind(parts, cut))
    )


def char_chunks(text: Column | str, context_limit: int, test: str = "chars") -> Column:
    """Chunks of ``4 * context_limit`` characters, only for texts that are too long.

    ``test='chars'`` calls a text long by its characters, ``test='tokens'`` by its tokens.
    """
    text = F.col(text) if isinstance(text, str) else text
    width = 4 * context_limit
    if test == "chars":
        fits = F.length(text) <= width
    elif test == "tokens":
        fits = F.size(tokens(text)) <= context_limit
    else:
        raise ValueError(f"unknown test {test!r}")
    pieces = F.transform(
        F.sequence(F.lit(1), F.length(text), F.lit(width)),
        lambda i: F.substring(text, i, F.lit(width)),
    )
    return (
        F.when(F.length(text) == 0, F.slice(F.array(text), 1, 0))
        .when(fits, F.array(text))
        .otherwise(pieces)
    )


def explode_chunks(
    docs: DataFrame, chunks: Column, key: str = "doc_id", keep_empty: bool = False
) -> DataFrame:
    """One row per chunk with its position and its weight, the number of characters.

    With ``keep_empty`` a document without chunks has one row of nulls.
    """
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return docs.select(key, explode(chunks).alias("chunk_no", "chunk")).withColumn(
        "weight", F.length("chunk").cast("bigint")
    )


def provider_id(provider: Column, model: Column, api_spec: Column, kind: Column) -> Column:
    """``provider_model`` plus, for the two services with task kinds, that kind."""
    base = F.concat_ws("_", provider, model)
    return (
        F.when(api_spec == "cohere", F.concat_ws("_", base, kind))
        .when(api_spec == "google", F.concat_ws("_", base, F.coalesce(kind, F.lit("default"))))
        .otherwise(base)
    )


def provider_display(identifier: Column) -> Column:
    """Struct (provider, model): split at the first underscore, provider in display form."""
    parts = F.split(identifier, "_", 2)
    model = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("unknown"))
    tidy = F.initcap(F.replace(parts[0], F.lit("-"), F.lit(" ")))
    return F.struct(tidy.alias("provider"), model.alias("model"))


def percent_encode(value: Column | str) -> Column:
    """Percent-encoding with no safe characters besides the unreserved ones."""
    out = F.url_encode(value)
    for old, new in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def row_to_text(df: DataFrame) -> Column:
    """All columns joined by a blank; nulls are skipped."""
    return F.concat_ws(" ", *[F.col(f"`{c}`").cast("string") for c in df.columns])


def drop_stop_words(df: DataFrame, column: str, stop_words: DataFrame, key: str) -> DataFrame:
    """Remove stop words from an array column.

    ``stop_words`` has one column ``word``. Up to MAX_STOP_WORDS the list goes to the
    executors as a hash set; a longer list is joined to exploded tokens, which come back
    together by a row number of their own. Both give the same: a null array stays null, and
    ``key`` may repeat.
    """
    found = [r[0] for r in stop_words.select("word").distinct().limit(MAX_STOP_WORDS + 1).collect()]
    if len(found) <= MAX_STOP_WORDS:
        remover = StopWordsRemover(
            inputCol=column, outputCol="__kept", stopWords=found, caseSensitive=True
        )
        if not found:
            return df
        held = df.withColumn("__null", F.col(column).isNull()).withColumn(
            column, F.coalesce(column, F.array().cast("array<string>"))
        )
        kept = remover.transform(held).withColumn(column, F.when(~F.col("__null"), F.col("__kept")))
        return kept.drop("__kept", "__null")
    listed = stop_words.select(F.col("word").alias("__word"), F.lit(True).alias("__stop")).distinct()
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    rest = [c for c in df.columns if c != column]
    spread = numbered.select(
        "__row", *rest, F.col(column).isNull().alias("__null"),
        F.posexplode_outer(column).alias("__pos", "__word"),
    ).join(listed, "__word", "left")
    wanted = F.col("__word").isNotNull() & F.col("__stop").isNull()
    kept = spread.groupBy("__row").agg(
        *(F.first(c).alias(c) for c in rest),
        F.first("__null").alias("__null"),
        F.array_sort(F.collect_list(F.when(wanted, F.struct("__pos", "__word")))).alias("__kept"),
    )
    return kept.withColumn(column, F.when(~F.col("__null"), F.col("__kept.__word"))).select(*df.columns)


def add_ngrams(df: DataFrame, column: str, out: str, low: int = 1, high: int = 3) -> DataFrame:
    """Array of all n-grams of the token array, ``low <= n <= high``, joined by a blank."""
    parts = []
    for n in range(low, high + 1):
        if n == 1:
            parts.append(F.col(column))
            continue
        df = NGram(n=n, inputCol=column, outputCol=f"__n{n}").transform(df)
        parts.append(F.col(f"__n{n}"))
    return df.withColumn(out, F.concat(*parts)).drop(*[f"__n{n}" for n in range(low, high + 1)])


# Fixed value: the summary prompt with its two placeholders.
SUMMARY_PROMPT = (
    "I have a topic that is described by the following keywords: [KEYWORDS]\n"
    "In this topic, the following documents are a small but representative subset of "
    "all documents in the topic:\n[DOCUMENTS]\n\n"
    "Based on the information above, please give a summarizing description of this topic:\n"
)


def fill_prompt(keywords: Column, documents: Column, template: str = SUMMARY_PROMPT) -> Column:
    filled = F.replace(F.lit(template), F.lit("[KEYWORDS]"), keywords)
    return F.replace(filled, F.lit("[DOCUMENTS]"), documents)
