"""Prompted payments: callback parsing, status and matching; payout results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payments import blank_to_null
from ..schemas import B2C_RESULT, STK_CALLBACK


def stk_flatten(messages: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested callback JSON to one row; the metadata list becomes columns."""
    body = F.from_json(F.col(value), STK_CALLBACK)["Body"]["stkCallback"]
    flat = messages.select(body.alias("_c"), *keep)
    entry = F.transform(F.col("_c.CallbackMetadata.Item"), lambda i: F.struct(i["Name"], i["Value"]))
    flat = flat.withColumn("_items", F.map_from_entries(entry))
    code = F.coalesce(F.col("_c.ResultCode"), F.lit(-1)).cast("bigint")
    return flat.select(
        F.col("_c.MerchantRequestID").alias("merchant_request_id"),
        F.col("_c.CheckoutRequestID").alias("checkout_request_id"),
        code.alias("result_code"),
        F.coalesce("_c.ResultDesc", F.lit("")).alias("result_desc"),
        F.col("_items").getItem("Amount").try_cast("double").alias("amount"),
        F.coalesce(F.col("_items").getItem("MpesaReceiptNumber"), F.col("_c.MpesaReceiptNumber")).alias("receipt"),
        F.col("_items").getItem("PhoneNumber").alias("phone_number"),
        *keep,
    )


def stk_items(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per metadata item."""
    body = F.from_json(F.col(value), STK_CALLBACK)["Body"]["stkCallback"]
    return messages.select(body.alias("_c")).select(
        F.col("_c.CheckoutRequestID").alias("checkout_request_id"), F.explode("_c.CallbackMetadata.Item").alias("_i")
    ).select("checkout_request_id", F.col("_i.Name").alias("name"), F.col("_i.Value").alias("value"))


def stk_status(code: Column) -> Column:
    return F.when(code == 0, "completed").when(code == 1, "cancelled").when(code == 10, "expired").otherwise("failed")


def stk_status_api(code: Column) -> Column:
    return F.when(code == 0, "success").otherwise("failed")


def latest_callbacks(callbacks: DataFrame) -> DataFrame:
    """Last callback per checkout id; an aggregate, so repeats shrink before the shuffle."""
    rest = [c for c in callbacks.columns if c not in ("checkout_request_id", "received_at")]
    return (
        callbacks.filter(F.col("checkout_request_id").isNotNull()).groupBy("checkout_request_id")
        .agg(F.max(F.struct("received_at", *rest)).alias("_last"))
        .select("checkout_request_id", "_last.*")
    )


def match_callbacks(requests: DataFrame, callbacks: DataFrame) -> DataFrame:
    """Initiated requests updated by their last callback; stray callbacks change nothing."""
    last = latest_callbacks(callbacks).select(
        "checkout_request_id", F.col("result_code").alias("_code"), F.col("result_desc").alias("_desc"),
        F.col("received_at").alias("_at"),
    )
    return requests.join(last, "checkout_request_id", "left").select(
        *[c for c in requests.columns if c != "status"],
        F.when(F.col("_at").isNotNull(), stk_status(F.col("_code"))).otherwise(F.col("status")).alias("status"),
        F.col("_code").alias("result_code"), F.col("_desc").alias("result_desc"), F.col("_at").alias("completed_at"),
    )


def api_transactions(requests: DataFrame, callbacks: DataFrame) -> DataFrame:
    """Transactions created by successful callbacks; without a request the fields stay empty."""
    last = latest_callbacks(callbacks).filter("result_code = 0").select(
        "checkout_request_id", "receipt", F.col("received_at").alias("_at")
    )
    known = requests.select("checkout_request_id", "phone_number", "amount", "account_reference")
    return last.join(known, "checkout_request_id", "left").select(
        F.coalesce(blank_to_null("receipt"), F.col("checkout_request_id")).alias("transaction_id"),
        F.coalesce("phone_number", F.lit("")).alias("phone_number"),
        F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("amount"),
        F.lit("success").alias("status"),
        F.coalesce("account_reference", F.lit("")).alias("account_reference"),
        F.lit("stk_callback").alias("source"),
        F.col("_at").alias("received_at"),
    )


def b2c_status(messages: DataFrame, value: str = "value") -> DataFrame:
    """Payout result; the code may sit at the top level or inside ``Result``."""
    parsed = F.from_json(F.col(value), B2C_RESULT)
    code = F.coalesce(parsed["ResultCode"], F.element_at(parsed["Result"], F.lit("ResultCode"))).try_cast("int")
    return messages.select(
        parsed["ConversationID"].alias("transaction_id"), F.lit("B2C").alias("transaction_type"),
        F.when(code == 0, "completed").otherwise("failed").alias("status"),
    )
