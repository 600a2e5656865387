"""Questions about ordered request logs: trailing counts, gaps, 429 runs.

A single provider may own a third of the log, so nothing here orders a whole provider in
one task. Running values number the rows by a distributed sort, work inside slices of
equal row count, and carry one summary row per slice; trailing counts are differences of
such running values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.corpus import with_row_index

SLICE_ROWS = 100_000


def trailing_counts(
    log: DataFrame, seconds: dict[str, int], key: str = "provider", row: str = "event_id",
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """For every request, the requests of its provider in the last n seconds, itself included.

    A count is the number of requests up to now less the number up to n seconds ago. Both
    moments of every request are put in order with the requests themselves, and one running
    sum over slices of equal row count answers them all, so no task holds a provider's day.
    """
    us = F.unix_micros("ts")
    spans = {"": 0, **seconds}
    moments = [F.struct(F.lit(0).alias("kind"), us.alias("at"), F.lit("own").alias("of"))] + [
        F.struct(F.lit(1).alias("kind"), (us - n * 1_000_000).alias("at"), F.lit(f"up_to_{name}").alias("of"))
        for name, n in spans.items()
    ]
    asked = log.select(key, F.col(row).alias("__row"), F.inline(F.array(*moments))).withColumn(
        "__id", F.struct("__row", "of")
    )
    placed = with_row_index(asked, [key, "at", "kind", "__id"], "__id", "__idx").withColumn(
        "__slice", F.floor(F.col("__idx") / rows)
    )
    seen = running(placed, {"__seen": ("sum", 1 - F.col("kind"))}, key).filter("kind = 1")
    at = lambda name: F.max(F.when(F.col("of") == f"up_to_{name}", F.col("__seen")))
    counted = seen.groupBy("__row").agg(*((at("") - at(name)).alias(name) for name in seconds))
    counted = counted.withColumnRenamed("__row", row).hint("merge")  # a row per request
    return log.join(counted, row).select(*log.columns, *seconds)


def breaches(counted: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Requests that exceed at least one limit on their trailing counts."""
    over = F.lit(False)
    for name, limit in limits.items():
        over = over | (F.col(name) > limit)
    return counted.filter(over)


def sliced(
    log: DataFrame, key: str = "provider", row: str = "event_id", rows: int = SLICE_ROWS
) -> DataFrame:
    """Add the row position ``__idx`` in (key, ts, row) order and the slice ``__slice``."""
    indexed = with_row_index(log, [key, "ts", row], row, "__idx")
    return indexed.withColumn("__slice", F.floor(F.col("__idx") / rows))


def running(
    df: DataFrame, values: dict[str, tuple[str, Column]], key: str = "provider",
    inclusive: bool = True,
) -> DataFrame:
    """Running sums or maxima per key over sliced rows, in ``__idx`` order.

    ``values`` maps a new column to ('sum' | 'max', expression). The current row counts
    unless ``inclusive`` is false.
    """
    kinds = {"sum": F.sum, "max": F.max}
    inputs = {name: f"__in_{name}" for name in values}
    df = df.select("*", *[expr.alias(inputs[n]) for n, (_, expr) in values.items()])
    per_slice = df.groupBy(key, "__slice").agg(
        *[kinds[kind](inputs[n]).alias(f"__s_{n}") for n, (kind, _) in values.items()]
    )
    before = Window.partitionBy(key).orderBy("__slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = per_slice.select(
        key,
        "__slice",
        *[kinds[kind](f"__s_{n}").over(before).alias(f"__c_{n}") for n, (kind, _) in values.items()],
    )
    inside = Window.partitionBy(key, "__slice").orderBy("__idx").rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    out = df.join(carried, [key, "__slice"])
    for n, (kind, _) in values.items():
        here = kinds[kind](inputs[n]).over(inside)
        both = (
            F.coalesce(here, F.lit(0)) + F.coalesce(f"__c_{n}", F.lit(0))
            if kind == "sum"
            else F.greatest(here, F.col(f"__c_{n}"))  # skips nulls
        )
        out = out.withColumn(n, both)
    return out.drop(*inputs.values(), *[f"__c_{n}" for n in values])


def previous_gap(
    log: DataFrame, key: str = "provider", row: str = "event_id", rows: int = SLICE_ROWS
) -> DataFrame:
    """Seconds since the provider's previous row; null for its first one."""
    df = sliced(log, key, row, rows)
    last = df.groupBy(key, "__slice").agg(F.max("ts").alias("__last"))
    before = Window.partitionBy(key).orderBy("__slice")
    carried = last.select(key, "__slice", F.lag("__last").over(before).alias("__before"))
    inside = Window.partitionBy(key, "__slice").orderBy("__idx")
    previous = F.coalesce(F.lag("ts").over(inside), F.col("__before"))
    gap = (F.unix_micros("ts") - F.unix_micros(previous)) / 1e6
    return (
        df.join(carried, [key, "__slice"])
        .withColumn("gap_s", gap)
        .drop("__idx", "__slice", "__before")
    )


def longest_gap(log: DataFrame, key: str = "provider", row: str = "event_id") -> DataFrame:
    return previous_gap(log, key, row).groupBy(key).agg(F.max("gap_s").alias("longest_gap_s"))


def throttle_runs(
    log: DataFrame, key: str = "provider", row: str = "event_id", rows: int = SLICE_ROWS
) -> DataFrame:
    """Per request: 429s since the last success, and whether this success ends a run of them.

    Only a success ends a run; other errors leave it open.
    """
    hit = (F.col("http_status") == 429).cast("bigint")
    ok = F.col("http_status") < 400
    df = running(sliced(log, key, row, rows), {"__hits": ("sum", hit)}, key)
    df = running(df, {"__at_ok": ("max", F.when(ok, F.col("__hits")))}, key, inclusive=False)
    open_run = F.col("__hits") - F.coalesce("__at_ok", F.lit(0))
    return (
        df.withColumn("ends_run", ok & (open_run > 0))
        .withColumn("consecutive_429", F.when(ok, F.lit(0)).otherwise(open_run))
        .drop("__hits", "__at_ok")
    )
