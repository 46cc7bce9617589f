"""Staging models: raw events to typed confirmations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payments as P
from ..plans.skew import HOT_ROWS, ordered_sequence


def stage_raw(raw: DataFrame) -> DataFrame:
    """Raw rows in staging shape: event type and account from the payload, times as compact text."""
    payload = F.col("payload")
    time = P.txn_time("transaction_time")
    return raw.select(
        "transaction_id", "received_at", "source",
        F.coalesce(F.get_json_object(payload, "$.event_type"), F.lit("c2b_confirmation")).alias("event_type"),
        "phone_number",
        F.col("amount").cast("string").alias("amount"),
        F.coalesce(
            F.get_json_object(payload, "$.account_reference"), F.get_json_object(payload, "$.AccountReference")
        ).alias("account_reference"),
        F.date_format(time, "yyyyMMddHHmmss").alias("transaction_time"),
        "payload",
    )


def _typed(df: DataFrame, amount: str, time: Column | None = None) -> DataFrame:
    if time is not None:
        df = df.withColumn("transaction_time", time)
    day = "transaction_date" if "transaction_date" in df.columns else "to_date(transaction_time)"
    return df.selectExpr(
        "transaction_id", "phone_number AS customer_phone_number", "account_reference",
        f"{amount} AS transaction_amount", "transaction_time AS transaction_timestamp", "received_at AS loaded_at",
        f"{day} AS transaction_date",
        "cast(hour(transaction_time) as bigint) AS transaction_hour",
        "cast(weekday(transaction_time) + 1 as bigint) AS day_of_week",
        f"{P.amount_category_sql('transaction_amount')} AS amount_category",
    )


def stage_c2b(stg_raw: DataFrame) -> DataFrame:
    """Typed confirmations; ``with_sequence`` adds the running number per customer."""
    kept = stg_raw.filter(
        (F.col("event_type") == "c2b_confirmation") & F.col("transaction_id").isNotNull()
        & F.col("phone_number").isNotNull() & F.col("amount").isNotNull()
    )
    return _typed(kept, "try_cast(amount as decimal(12,2))", P.txn_time("transaction_time"))


def typed_payments(payments: DataFrame) -> DataFrame:
    """Same layout from an already typed feed, without the text round trip."""
    return _typed(payments, "cast(amount as decimal(12,2))")


def with_sequence(tx: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Running number per customer by time; equal times are ordered by the reversed id.

    Crowded customers split by hour, then second, then the last two id characters.
    """
    micros = F.unix_micros(F.col("transaction_timestamp").cast("timestamp"))
    tail = F.reverse("transaction_id")
    last_two = F.ascii(tail) * 256 + F.ascii(F.substring(tail, 2, 1))
    return ordered_sequence(
        tx, ["customer_phone_number"],
        order=[F.asc_nulls_first("transaction_timestamp"), tail, F.asc_nulls_first("loaded_at")],
        levels=[F.floor(micros / 3_600_000_000), F.floor(micros / 1_000_000), last_two.cast("bigint")],
        out="transaction_sequence_per_customer", hot_rows=hot_rows,
    )
