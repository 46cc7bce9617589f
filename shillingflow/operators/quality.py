"""Row validation, dead letters and model tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import validation as V
from ..schemas import TOPIC_TRANSACTIONS

# Failure reason per failing rule; rules not listed are validation errors.
FORMAT_RULES = ["time_format", "unreadable_time", "amount_not_numeric", "corrupt_message"]
REASONS = {"unknown_region": "region_mapping_failed"}
# Reasons that may pass on another attempt.
TRANSIENT = ["database_error", "timeout", "unknown_error", "region_mapping_failed"]
MAX_RETRIES = 3


def validate_transactions(raw: DataFrame, txn_id="transaction_id", amount="amount", phone="phone_number",
                          shortcode="business_shortcode", time="transaction_time") -> DataFrame:
    rule = V.first_failing_rule(txn_id, amount, phone, shortcode, time)
    return raw.withColumn("rule", rule).withColumn("is_valid", F.col("rule") == "ok")


def rule_counts(validated: DataFrame) -> DataFrame:
    return validated.groupBy("rule").agg(F.count("*").alias("rows"))


def route(validated: DataFrame, message: str = "payload", topic: str = TOPIC_TRANSACTIONS) -> tuple[DataFrame, DataFrame]:
    """Valid rows and dead letters; together they hold every input row."""
    ok = F.coalesce(F.col("is_valid"), F.lit(False))
    return validated.filter(ok), dead_letters(validated.filter(~ok), message, topic)


def dead_letters(bad: DataFrame, message: str = "payload", topic: str = TOPIC_TRANSACTIONS) -> DataFrame:
    """Letters with every field of the record; a reason that may pass later makes them recoverable.

    A letter is stamped with its row's arrival where that is known, so a replay writes the same letter."""
    reason = F.when(F.col("rule").isin(FORMAT_RULES), "invalid_format")
    for rule, told in REASONS.items():
        reason = reason.when(F.col("rule") == rule, told)
    reason = reason.otherwise("validation_error")
    arrival = F.col("received_at").cast("timestamp") if "received_at" in bad.columns else F.lit(None).cast("timestamp")
    return bad.select(
        F.coalesce("transaction_id", F.sha2(F.col(message), 256)).alias("message_id"),
        F.lit(topic).alias("original_topic"),
        F.col(message).alias("original_message"),
        reason.alias("failure_reason"),
        F.concat(F.lit("rule failed: "), F.coalesce("rule", F.lit("unknown"))).alias("error_message"),
        F.lit(None).cast("string").alias("error_stacktrace"),
        F.coalesce(arrival, F.current_timestamp()).alias("timestamp"),
        F.lit(0).cast("bigint").alias("retry_count"),
        F.lit(MAX_RETRIES).cast("bigint").alias("max_retries"),
        reason.isin(TRANSIENT).alias("is_recoverable"),
    )


def callback_letters(rejects: DataFrame, topic: str = TOPIC_TRANSACTIONS) -> DataFrame:
    """Letters of callbacks that could not become rows (their amount can't be read)."""
    text = F.to_json(F.struct(*rejects.columns))
    return dead_letters(rejects.select(
        F.col("TransID").alias("transaction_id"), text.alias("payload"), F.lit("amount_not_numeric").alias("rule")), topic=topic)


def retry_plan(letters: DataFrame) -> DataFrame:
    """Next step of each dead letter: another attempt or an incident."""
    again = F.col("is_recoverable") & (F.col("retry_count") < F.col("max_retries"))
    return letters.withColumn("action", F.when(again, "retry").otherwise("incident")).withColumn(
        "retry_count", F.when(again, F.col("retry_count") + 1).otherwise(F.col("retry_count"))
    )


def dlq_stats(letters: DataFrame) -> DataFrame:
    """Total, count per reason and per recovery status in one pass."""
    status = F.when(F.col("is_recoverable"), "pending").otherwise("unrecoverable")
    counted = (
        letters.select(F.col("failure_reason").alias("_type"), status.alias("_status"))
        .groupingSets([[F.col("_type")], [F.col("_status")], []], F.col("_type"), F.col("_status"))
        .agg(F.count("*").alias("errors"), F.grouping_id().alias("_set"))
    )
    return counted.select(
        F.when(F.col("_set") == 1, "type").when(F.col("_set") == 2, "recovery_status").otherwise("total").alias("dimension"),
        F.coalesce("_type", "_status", F.lit("all")).alias("value"), "errors",
    )


def processing_stats(validated: DataFrame) -> DataFrame:
    errors = F.count_if(~F.coalesce(F.col("is_valid"), F.lit(False)))
    total = F.count("*")
    return validated.agg(
        (total - errors).alias("processed_count"), errors.alias("error_count"),
        F.coalesce(F.try_divide(errors * F.lit(100.0).cast("double"), total), F.lit(0.0)).alias("error_rate"),
    )


# Model tests.
NOT_NULL = {
    "stg_raw_events": ["transaction_id", "phone_number", "amount", "transaction_time", "received_at"],
    "stg_c2b_transactions": ["transaction_id", "customer_phone_number", "transaction_amount", "transaction_date"],
    "mart_county_heatmap": ["transaction_date", "transaction_count", "total_amount"],
    "mart_daily_transactions": [
        "transaction_date", "customer_phone_number", "transaction_count", "total_transaction_value",
        "avg_transaction_amount", "max_transaction_amount", "min_transaction_amount",
    ],
    "mart_hourly_volumes": ["hour_bucket", "transaction_count", "total_amount", "unique_customers"],
}
UNIQUE = {
    "stg_raw_events": ["transaction_id"], "stg_c2b_transactions": ["transaction_id"],
    "mart_hourly_volumes": ["hour_bucket"],
}
ACCEPTED = {"stg_c2b_transactions": {"amount_category": ["low", "medium", "high"]}}


def _findings(name: str, df: DataFrame) -> DataFrame:
    """All tests of one model from one scan and one exchange: rows become (check, value) pairs, only where a
    test needs them, and the pairs are counted."""
    pairs: dict[str, Column] = {}
    fails: dict[str, Column] = {}

    def pair(check: str, when: Column, value: Column, failed: Column) -> None:
        pairs[check] = F.when(when, F.struct(F.lit(check).alias("check"), value.cast("string").alias("value")))
        fails[check] = F.coalesce(F.sum(F.when(F.col("check") == check, failed)), F.lit(0)).cast("bigint")

    for c in NOT_NULL.get(name, []):
        pair(f"{c}:not_null", F.col(c).isNull(), F.lit(None), F.col("n"))
    for c in UNIQUE.get(name, []):
        pair(f"{c}:unique", F.col(c).isNotNull(), F.col(c), (F.col("n") > 1).cast("bigint"))
    for c, allowed in ACCEPTED.get(name, {}).items():
        pair(f"{c}:accepted_values", ~F.col(c).isin(allowed), F.col(c), F.lit(1))
    found = df.select(F.explode(F.filter(F.array(*pairs.values()), lambda p: p.isNotNull())).alias("p")).select("p.*")
    counted = found.groupBy("check", "value").agg(F.count("*").alias("n"))
    row = counted.agg(*[f.alias(k) for k, f in fails.items()])
    return row.unpivot([], list(fails), "check", "failures").select(
        F.lit(name).alias("model"), F.split("check", ":")[0].alias("column"), F.split("check", ":")[1].alias("test"), "failures")


def model_tests(models: dict[str, DataFrame]) -> DataFrame:
    """(model, column, test, failures): null rows, repeated values, values outside the list."""
    return reduce(DataFrame.unionByName, [_findings(name, df) for name, df in models.items()])


def staging_checks(tx: DataFrame, as_of: Column) -> DataFrame:
    """Four row checks in one pass."""
    checks = {
        "transaction_id_null": F.col("transaction_id").isNull(),
        "invalid_phone": ~F.col("customer_phone_number").like("254%"),
        "negative_amount": F.col("transaction_amount") < 0,
        "future_transactions": F.col("transaction_date") > F.to_date(as_of),
    }
    row = tx.agg(*[F.count_if(c).alias(k) for k, c in checks.items()])
    return row.unpivot([], list(checks), "check_name", "failures")
