"""Marts over typed confirmations, and warehouse aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import payments as P


def hourly_volumes(tx: DataFrame) -> DataFrame:
    return tx.groupBy(P.trunc_ts("hour", "transaction_timestamp").alias("hour_bucket")).agg(
        F.count("*").alias("transaction_count"),
        F.sum("transaction_amount").cast("double").alias("total_amount"),
        F.countDistinct("customer_phone_number").alias("unique_customers"),
    )


def daily_transactions(tx: DataFrame) -> DataFrame:
    hour, amount = F.col("transaction_hour"), F.col("transaction_amount")

    def share(band: str):
        hits = F.count_if(F.col("amount_category") == band)
        return F.round(F.lit(100.0).cast("double") * hits / F.count("amount_category"), 2)

    return tx.groupBy("transaction_date", "customer_phone_number", "account_reference").agg(
        F.countDistinct("transaction_id").alias("transaction_count"),
        F.sum(amount).cast("double").alias("total_transaction_value"),
        P.exact_mean(amount).alias("avg_transaction_amount"),
        F.min(amount).cast("double").alias("min_transaction_amount"),
        F.max(amount).cast("double").alias("max_transaction_amount"),
        F.round(F.stddev_samp(amount.cast("double")), 2).alias("stddev_transaction_amount"),
        F.count_if((hour >= 6) & (hour < 12)).alias("morning_transactions"),
        F.count_if((hour >= 12) & (hour < 18)).alias("afternoon_transactions"),
        F.count_if((hour >= 18) | (hour < 6)).alias("evening_transactions"),
        share("low").alias("pct_low_amount"),
        share("medium").alias("pct_medium_amount"),
        share("high").alias("pct_high_amount"),
        F.max(F.when(F.col("day_of_week").isin(6, 7), 1).otherwise(0)).cast("bigint").alias("is_weekend"),
    )


def county_heatmap(tx: DataFrame) -> DataFrame:
    return tx.groupBy("transaction_date", "account_reference").agg(
        F.count("*").alias("transaction_count"),
        F.sum("transaction_amount").cast("double").alias("total_amount"),
    )


def warehouse_hourly(payments: DataFrame, payment_type: str = "C2B") -> DataFrame:
    """Date x hour x type with outcome counts."""
    status = F.col("transaction_status")
    ok = F.count_if(status == "completed")
    return payments.groupBy(
        P.day_of(payments).alias("date"),
        F.hour("transaction_time").cast("bigint").alias("hour"),
        F.lit(payment_type).alias("transaction_type"),
    ).agg(
        F.count("*").alias("total_transactions"),
        F.sum("amount").cast("double").alias("total_amount"),
        P.exact_mean("amount").alias("average_amount"),
        ok.alias("successful_transactions"),
        F.count_if(status == "failed").alias("failed_transactions"),
        F.round(F.lit(100.0).cast("double") * ok / F.count("*"), 2).alias("success_rate_percent"),
    )


def warehouse_county(payments: DataFrame) -> DataFrame:
    return payments.groupBy(
        P.day_of(payments).alias("date"), F.col("region").alias("county_name")
    ).agg(
        F.count("*").alias("transaction_count"),
        F.sum("amount").cast("double").alias("transaction_volume"),
        P.exact_mean("amount").alias("average_transaction_size"),
    )
