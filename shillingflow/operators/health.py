"""Volume, freshness, latency and reconciliation checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payments as P
from ..plans.skew import exact_quantiles

# Histogram bounds and the staleness limit in seconds.
AMOUNT_BOUNDS = [100, 500, 1000, 5000, 10000, 50000, 100000, 500000]
STALE_AFTER = 300


def volume_check(raw: DataFrame, as_of: Column, hours: int = 1) -> DataFrame:
    amount = F.col("_amount")
    lower = as_of - P.interval(hours, "HOURS")
    rows = P.arrived_from(raw, lower).filter(F.col("received_at") > lower).withColumn(
        "_amount", F.col("amount").try_cast("decimal(12,2)")
    )

    def zero(c: Column) -> Column:
        return F.coalesce(c.cast("double"), F.lit(0.0))

    return rows.agg(
        F.count("*").alias("transaction_count"), F.countDistinct("phone_number").alias("unique_customers"),
        zero(F.sum(amount)).alias("total_amount"), zero(P.exact_mean(amount)).alias("avg_amount"),
        zero(F.max(amount)).alias("max_amount"), zero(F.min(amount)).alias("min_amount"),
    )


def staleness_check(raw: DataFrame, as_of: Column, limit: int = STALE_AFTER) -> DataFrame:
    last = F.max("received_at")
    gap = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(last.cast("timestamp"))
    return raw.agg(last.alias("last_transaction_time"), gap.alias("staleness_seconds")).withColumn(
        "status", F.when(F.col("staleness_seconds") < limit, "healthy").otherwise("warning")
    )


def db_status(payments: DataFrame, as_of: Column) -> DataFrame:
    today = F.to_date("transaction_time") == F.to_date(as_of)
    return payments.agg(
        F.count("*").alias("raw_transactions"), F.countDistinct("phone_number").alias("unique_customers"),
        F.coalesce(F.sum(F.when(today, F.col("amount"))).cast("double"), F.lit(0.0)).alias("total_volume"),
    )


def amount_histogram(payments: DataFrame, bounds: list[int] = AMOUNT_BOUNDS) -> DataFrame:
    """Cumulative counts per upper bound."""
    names = [str(b) for b in bounds]
    row = payments.agg(
        *[F.count_if(F.col("amount") <= b).alias(str(b)) for b in bounds], F.count("amount").alias("+Inf")
    )
    return row.unpivot([], [F.col(f"`{n}`") for n in [*names, "+Inf"]], "le", "cumulative_count")


def status_counts(payments: DataFrame) -> DataFrame:
    return payments.groupBy(F.col("transaction_status").alias("status")).agg(F.count("*").alias("transactions"))


def metrics_by_window(payments: DataFrame, size: str = "1 hour") -> DataFrame:
    return payments.groupBy(F.window("transaction_time", size)).agg(
        F.countDistinct("phone_number").alias("unique_customers"), F.sum("amount").cast("double").alias("amount_sum")
    ).select(P.ntz("window.start").alias("window_start"), "unique_customers", "amount_sum")


def ingest_latency(raw: DataFrame) -> DataFrame:
    """Seconds between payment and arrival per event type."""
    lag = (
        F.unix_micros(F.col("received_at").cast("timestamp"))
        - F.unix_micros(P.txn_time("transaction_time").cast("timestamp"))
    ) / F.lit(1e6)
    rows = raw.select("event_type", lag.alias("latency"))
    probs = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    q = exact_quantiles(rows, "latency", probs, by=["event_type"])
    return q.select("event_type", *[P.money_round(p, 4).alias(p) for p in probs])


def arrivals_per_minute(raw: DataFrame) -> DataFrame:
    return raw.groupBy("event_type", P.trunc_ts("minute", "received_at").alias("minute")).agg(
        F.count("*").alias("rows")
    )


def reconcile_daily(raw: DataFrame, staged: DataFrame) -> DataFrame:
    """Landed ids against staged ids per day. Ids are reduced to one row on each side first."""
    left = raw.filter(F.col("transaction_id").isNotNull()).groupBy("transaction_id").agg(
        F.min(F.to_date("received_at")).alias("_raw_day")
    )
    right = staged.groupBy("transaction_id").agg(F.min(F.to_date("loaded_at")).alias("_staged_day"))
    both = F.col("_raw_day").isNotNull() & F.col("_staged_day").isNotNull()
    return (
        left.join(right, "transaction_id", "full_outer")
        .groupBy(F.coalesce("_raw_day", "_staged_day").alias("date"))
        .agg(F.count_if(both).alias("matched"), F.count_if(~both).alias("unmatched"),
             (F.count_if(both) / F.count("*")).alias("match_rate"))
    )


def bench_select(payments: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    return P.from_time(payments, as_of - P.interval(days, "DAYS")).agg(
        F.count("*").alias("transaction_count"), F.sum("amount").cast("double").alias("total_amount"),
        P.exact_mean("amount").alias("avg_amount"),
    )


def bench_complex(payments: DataFrame, as_of: Column, days: int = 30, more_than: int = 5, limit: int = 100) -> DataFrame:
    return (
        P.from_time(payments, as_of - P.interval(days, "DAYS")).groupBy("phone_number")
        .agg(F.count("*").alias("transaction_count"), F.sum("amount").cast("double").alias("total_amount"),
             P.exact_mean("amount").alias("avg_amount"), F.max("amount").cast("double").alias("max_amount"))
        .filter(F.col("transaction_count") > more_than)
        .orderBy(F.desc("total_amount"), "phone_number").limit(limit)
    )
