"""Fraud features per payment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import payments as P
from ...plans.skew import HOT_ROWS, exact_quantiles, profile_join

# Feature order.
FEATURES = [
    "amount_log", "is_round_amount", "is_very_high_amount", "is_very_low_amount", "hour_of_day", "day_of_week",
    "is_night_transaction", "is_weekend", "phone_length", "customer_avg_amount", "customer_transaction_count",
    "amount_deviation", "merchant_avg_amount", "merchant_transaction_count", "region_risk_factor",
]


def customer_profile(payments: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return payments.filter(F.col("phone_number").isNotNull()).groupBy("phone_number").agg(
        P.exact_mean(amount).alias("customer_avg_amount"),
        F.stddev_samp(amount.cast("double")).alias("customer_std_amount"),
        F.min(amount).cast("double").alias("customer_min_amount"),
        F.max(amount).cast("double").alias("customer_max_amount"),
        F.count("*").alias("customer_transaction_count"),
        F.countDistinct("transaction_time").alias("unique_times"),
    )


def merchant_profile(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("business_shortcode").isNotNull()).groupBy("business_shortcode").agg(
        P.exact_mean("amount").alias("merchant_avg_amount"),
        F.count("*").alias("merchant_transaction_count"),
        F.countDistinct("phone_number").alias("merchant_unique_customers"),
    )


def customer_features_join(payments: DataFrame, profile: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    profile = customer_profile(payments) if profile is None else profile
    return profile_join(payments, profile, ["phone_number"], "customer_transaction_count", "transaction_id", hot_rows)


def merchant_features_join(payments: DataFrame, profile: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    profile = merchant_profile(payments) if profile is None else profile
    return profile_join(payments, profile, ["business_shortcode"], "merchant_transaction_count", "transaction_id", hot_rows)


def amount_cuts(payments: DataFrame) -> DataFrame:
    return exact_quantiles(payments, "amount", {"p05": 0.05, "p95": 0.95})


def fraud_features(payments: DataFrame, profiles: dict[str, DataFrame] | None = None,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """The 15 features next to the row's own columns; ``payments`` carries a region.

    ``profiles`` (customer, merchant, cuts) come from a saved training run when single rows are
    scored; otherwise they are taken from ``payments`` itself.
    """
    profiles = profiles or {
        "customer": customer_profile(payments).select(
            "phone_number", "customer_avg_amount", "customer_std_amount", "customer_transaction_count"),
        "merchant": merchant_profile(payments).drop("merchant_unique_customers"),
        "cuts": amount_cuts(payments),
    }
    cuts = profiles["cuts"].select(F.struct("p05", "p95")).scalar()
    rows = customer_features_join(payments, profiles["customer"], hot_rows)
    rows = merchant_features_join(rows, profiles["merchant"], hot_rows).withColumn("_cuts", cuts)
    keep = [c for c in payments.columns if c not in FEATURES]
    return rows.selectExpr(*keep, *[f"{sql} AS {name}" for name, sql in FEATURE_SQL.items()])


def _flag(condition: str) -> str:
    return f"coalesce(cast({condition} as double), 0D)"


_AMOUNT = "cast(amount as double)"
FEATURE_SQL = {
    "amount_log": f"ln(1 + {_AMOUNT})",
    "is_round_amount": _flag("amount % 1 = 0"),
    "is_very_high_amount": _flag(f"{_AMOUNT} > _cuts.p95"),
    "is_very_low_amount": _flag(f"{_AMOUNT} < _cuts.p05"),
    "hour_of_day": "cast(hour(transaction_time) as double)",
    "day_of_week": "cast(weekday(transaction_time) as double)",
    "is_night_transaction": _flag("hour(transaction_time) >= 22 OR hour(transaction_time) < 6"),
    "is_weekend": _flag("weekday(transaction_time) >= 5"),
    "phone_length": "cast(length(phone_number) as double)",
    "customer_avg_amount": "customer_avg_amount",
    "customer_transaction_count": "cast(customer_transaction_count as double)",
    "amount_deviation": f"coalesce(abs({_AMOUNT} - customer_avg_amount) / (customer_std_amount + 1), 0D)",
    "merchant_avg_amount": "merchant_avg_amount",
    "merchant_transaction_count": "cast(merchant_transaction_count as double)",
    "region_risk_factor": P.region_risk_sql("region"),
}


def fill_means(features: DataFrame) -> DataFrame:
    """Missing values to the column mean, then zero. Needs one extra pass over the features."""
    means = features.agg(F.struct(*[F.avg(c).alias(c) for c in FEATURES])).scalar()
    return features.withColumns({c: F.coalesce(c, means[c], F.lit(0.0)) for c in FEATURES})
