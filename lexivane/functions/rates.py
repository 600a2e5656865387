"""Column functions for request handling: waits, rates, bands, hours, stamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def allowed_hour(hour: Column, start: int | None, end: int | None) -> Column:
    """Start inclusive, end exclusive, wraps midnight when start is later; none: always."""
    if start is None or end is None:
        return F.lit(True)
    if start > end:
        return (hour >= start) | (hour < end)
    return (hour >= start) & (hour < end)


def retry_wait(header: Column, ts: Column, consecutive: Column) -> Column:
    """Seconds to wait after a 429: header seconds, header date, else capped doubling."""
    number = header.try_cast("double")
    date = F.try_to_timestamp(
        F.regexp_extract(header, r"^\w{3}, (\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1),
        F.lit("dd MMM yyyy HH:mm:ss"),
    )
    until = (F.unix_micros(date) - F.unix_micros(ts)) / 1_000_000
    # 2^6 is already above the cap, so the exponent is cut there as well
    backoff = F.least(F.lit(60.0), F.pow(F.lit(2.0), F.least(consecutive, F.lit(6))))
    return F.coalesce(number, until, backoff)


def success_rate(success: Column, total: Column) -> Column:
    """Percentage with two decimals; zero when nothing was attempted."""
    return F.coalesce(F.round(100.0 * success / F.nullif(total, F.lit(0)), 2), F.lit(0.0))


def report_rate(success: Column, failed: Column, total: Column) -> Column:
    """The delivery report's rule: no failure reads as 100 per cent, even if nothing was sent."""
    return F.when(failed == 0, F.lit(100.0)).otherwise(success_rate(success, total))


def quota_band(remaining: Column, capacity: Column) -> Column:
    share = 100.0 * remaining / capacity
    return F.when(share > 50, "green").when(share > 20, "yellow").otherwise("red")


def run_stamps(ts: Column) -> Column:
    """Date prefix, file stamp and ISO time of one run moment."""
    return F.struct(
        F.date_format(ts, "yyyy-MM-dd_").alias("date_prefix"),
        F.date_format(ts, "yyyyMMdd_HHmmss").alias("file_stamp"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("iso_time"),
    )
