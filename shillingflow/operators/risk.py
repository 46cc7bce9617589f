"""Batch twins of the stream rules, alert conditions and rate breaches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payments as P
from ..plans.skew import HOT_ROWS, profile_join, slotted_sums, trailing_counts


def velocity(events: DataFrame, key: str, ts: str, row_id: str, seconds: int = 60, threshold: int = 5,
             hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with the number of the key's rows in the last ``seconds`` and a flag above ``threshold``."""
    counts = trailing_counts(events, [key], ts, seconds, "recent_transaction_count")
    joined = profile_join(events, counts, [key, ts], "rows_at", row_id, hot_rows)
    return joined.drop("rows_at").withColumn(
        "velocity_flag", F.col("recent_transaction_count") > threshold
    )


def windows_by_category(events: DataFrame, ts: str, amount: str, size: str, slide: str | None = None) -> DataFrame:
    """Tumbling or sliding totals per amount category."""
    value, category = F.col(amount), F.col("amount_category")
    return (
        events.groupBy(F.window(ts, size, slide or size), category)
        .agg(
            F.count("*").alias("transaction_count"), F.sum(value).alias("total_amount"), F.avg(value).alias("avg_amount"),
            *[F.count_if(category == c).alias(f"{c}_count") for c in ("low", "medium", "high")],
        )
        .select(
            P.ntz("window.start").alias("window_start"), P.ntz("window.end").alias("window_end"),
            category.alias("key"), "transaction_count", P.money_round("total_amount").alias("total_amount"),
            P.money_round("avg_amount").alias("avg_amount"), "low_count", "medium_count", "high_count",
        )
    )


def volume_drop(events: DataFrame, ts: str, ratio: float = 0.5) -> DataFrame:
    """Minutes whose 10-minute rate is below ``ratio`` of the 1-hour rate one hour earlier.

    Every minute of every active day is looked at, so silence counts as a drop.
    """
    minute = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / 60)
    counts = events.groupBy(minute.alias("minute")).agg(F.count("*").alias("n"))
    grid = (
        counts.select(F.floor(F.col("minute") / 1440).alias("day")).distinct()
        .select(F.explode(F.sequence(F.col("day") * 1440, F.col("day") * 1440 + 1439)).alias("minute"))
    )
    filled = grid.join(counts, "minute", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = slotted_sums(filled, [], "minute", 1440, {"last_10m": ("n", -9, 0), "hour_before": ("n", -119, -60)})
    now, before = F.col("last_10m") / F.lit(600.0), F.coalesce("hour_before", F.lit(0)) / F.lit(3600.0)
    return sums.filter(now < before * ratio).select(
        P.ntz(F.timestamp_seconds(F.col("minute") * 60)).alias("time"),
        now.cast("double").alias("rate_10m"), before.cast("double").alias("rate_1h_before"),
    )


def rate_alert(rows: DataFrame, ts: str, hit: Column, minutes: int, threshold: float) -> DataFrame:
    """Tumbling windows where the share of ``hit`` rows exceeds ``threshold``."""
    share = F.count_if(hit) / F.count("*")
    return (
        rows.groupBy(F.window(ts, f"{minutes} minutes")).agg(
            F.count("*").alias("total"), F.count_if(hit).alias("hits"), share.alias("rate")
        )
        .filter(F.col("rate") > threshold)
        .select(P.ntz("window.start").alias("window_start"), "total", "hits", "rate")
    )


def rate_breach(events: DataFrame, key: str, ts: str, limit: int, seconds: int = 60) -> DataFrame:
    """Keys above ``limit`` rows in a clock-aligned window."""
    return (
        events.groupBy(F.window(ts, f"{seconds} seconds"), F.col(key).alias("key")).agg(F.count("*").alias("requests"))
        .filter(F.col("requests") > limit)
        .select("key", P.ntz("window.start").alias("window_start"), "requests")
    )
