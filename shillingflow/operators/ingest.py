"""Callbacks and events to canonical rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payments as P
from ..functions import validation as V


# Fixed value: source tag of callback events.
SOURCE = "daraja_webhook"


def event_envelope(callbacks: DataFrame, event_type: str = "c2b_confirmation",
                   received_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Callback to normalised event; an empty account reference falls through to the bill number."""
    cols = [
        F.lit(event_type).alias("event_type"),
        F.col("TransID").alias("transaction_id"),
        F.col("MSISDN").alias("phone_number"),
        F.col("TransAmount").cast("string").alias("amount"),
        F.coalesce(P.blank_to_null("AccountReference"), F.col("BillRefNumber")).alias("account_reference"),
        F.col("TransTime").alias("transaction_time"),
        F.lit(SOURCE).alias("source"),
        *[F.col(c) for c in keep],
    ]
    if received_at is not None:
        cols.append(received_at.alias("received_at"))
    return callbacks.select(*cols)


def event_json(callbacks: DataFrame, **kw) -> DataFrame:
    """Envelope as a keyed JSON message; the callback itself travels in ``data``."""
    data = F.struct(*[F.col(c) for c in callbacks.columns if c != "payment_key"])
    keyed = event_envelope(callbacks.withColumn("data", data), keep=("data",), **kw)
    return keyed.select(F.col("phone_number").alias("key"), F.to_json(F.struct("*")).alias("value"))


def legacy_coerce(events: DataFrame) -> DataFrame:
    """Older event shape to the current one: renamed type, amount as text."""
    return events.withColumn("amount", F.col("amount").cast("string")).withColumn(
        "event_type",
        F.when(F.col("event_type") == "c2b_transaction", "c2b_confirmation").otherwise(F.col("event_type")),
    )


def parse_times(events: DataFrame, c: str = "transaction_time") -> DataFrame:
    """Parsed time next to the text, and whether a non-empty text could not be read."""
    return events.withColumn("parsed_time", P.txn_time(c)).withColumn("unreadable", P.txn_time_unreadable(c))


def parse_c2b(callbacks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Callback to a landing row, and the callbacks whose amount cannot be read.

    A missing amount counts as zero; the region uses the local form of the number.
    """
    amount = V.finite_amount("TransAmount")
    readable = F.col("TransAmount").isNull() | amount.isNotNull()

    def text(c: str) -> Column:
        return F.coalesce(c, F.lit(""))

    rows = P.with_region(
        callbacks.filter(readable).withColumn("_local", P.standardize_phone("MSISDN")), "_local"
    ).select(
        text("TransID").alias("transaction_id"),
        text("MSISDN").alias("phone_number"),
        text("BusinessShortCode").alias("business_shortcode"),
        F.coalesce(amount, F.lit(0.0)).alias("amount"),
        text("TransTime").alias("transaction_time"),
        F.lit("completed").alias("transaction_status"),
        F.lit("c2b").alias("payment_method"),
        text("BillRefNumber").alias("reference"),
        text("AccountReference").alias("account_reference"),
        text("BusinessShortCode").alias("merchant_id"),
        "region",
        F.to_json(F.struct(*[c for c in callbacks.columns if c != "payment_key"])).alias("raw_data"),
    )
    return rows, callbacks.filter(~readable)


def fraud_alert_envelope(alerts: DataFrame, detected_at: Column, severity: str = "medium") -> DataFrame:
    """Alert rows wrapped for the alert topic, keyed by phone."""
    return alerts.select(
        F.col("phone_number").alias("key"),
        F.to_json(
            F.struct(
                F.lit("fraud_detection").alias("alert_type"), F.lit(severity).alias("severity"),
                detected_at.alias("detected_at"), F.struct(*alerts.columns).alias("alert_data"),
            )
        ).alias("value"),
    )
