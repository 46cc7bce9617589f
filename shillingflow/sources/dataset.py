"""Payment tables derived from the test star schema.

``orders`` supplies payments, ``events`` the stream. Every derived column is a deterministic
expression of one row, so the work of a query grows with the given tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import payments as P
from ..operators import marts, staging


# Layouts of the test tables in use; giving them saves a footer read per query.
LAYOUTS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


class Dataset:
    """Lazy frames over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(LAYOUTS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def payments(self) -> DataFrame:
        return payments(self.table("orders"))

    @cached_property
    def regional(self) -> DataFrame:
        """Payments with their region; kept apart because the lookup is a join."""
        return P.with_region(self.payments)

    @cached_property
    def raw_feed(self) -> DataFrame:
        return raw_feed(self.table("orders"))

    @cached_property
    def callbacks(self) -> DataFrame:
        return callbacks(self.table("orders"))

    @cached_property
    def stg_raw(self) -> DataFrame:
        return staging.stage_raw(self.raw_feed)

    @cached_property
    def tx(self) -> DataFrame:
        """Typed confirmations without the per-customer sequence, which costs a shuffle."""
        return staging.typed_payments(self.payments)

    @cached_property
    def tx_sequenced(self) -> DataFrame:
        return staging.with_sequence(self.tx)

    @cached_property
    def staged(self) -> DataFrame:
        """Typed confirmations staged from the dirty feed."""
        return staging.stage_c2b(self.stg_raw)

    @cached_property
    def stream_events(self) -> DataFrame:
        return stream_events(self.table("events"))

    @cached_property
    def validator_records(self) -> DataFrame:
        """Dirty feed with ISO times, the form the record validator expects."""
        iso = F.date_format(P.txn_time("transaction_time"), "yyyy-MM-dd'T'HH:mm:ss")
        return self.raw_feed.withColumn("transaction_time", F.coalesce(iso, "transaction_time"))

    @cached_property
    def legacy_events(self) -> DataFrame:
        return legacy_events(self.payments)

    @cached_property
    def stk_requests(self) -> DataFrame:
        return stk_requests(self.payments)

    @cached_property
    def stk_messages(self) -> DataFrame:
        return stk_messages(self.payments)

    @cached_property
    def b2c_messages(self) -> DataFrame:
        return b2c_messages(self.payments)

    @cached_property
    def hourly(self) -> DataFrame:
        return marts.hourly_volumes(self.tx)

    @cached_property
    def daily(self) -> DataFrame:
        return marts.daily_transactions(self.tx)

    @cached_property
    def heatmap(self) -> DataFrame:
        return marts.county_heatmap(self.tx)

    @cached_property
    def as_of(self) -> Column:
        """Latest payment time. One value, read once: as a literal it reaches the scan filters."""
        return _literal_time(self.payments.agg(F.max("transaction_time")))

    @property
    def fixed_clock(self) -> Column:
        """Twelve hours after the newest arrival, for freshness measures."""
        return self.raw_as_of + F.expr("INTERVAL 12 HOURS")

    @cached_property
    def raw_as_of(self) -> Column:
        return _literal_time(self.raw_feed.agg(F.max("received_at")))


def _literal_time(single: DataFrame) -> Column:
    value = single.first()[0]
    return F.lit(None if value is None else value.isoformat(sep=" ")).cast("timestamp_ntz")


def seconds(sql: str) -> str:
    """SQL interval of a whole number of seconds."""
    return f"make_dt_interval(0, 0, 0, cast({sql} as decimal(18,6)))"


def payments(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS payment_key",
        "concat('TXN', lpad(cast(o_orderkey as string), 10, '0')) AS transaction_id",
        "concat('2547', lpad(cast((o_custkey * 666013) % 100000000 as string), 8, '0')) AS phone_number",
        "cast(cast(o_totalprice as decimal(12,2)) * cast(CASE o_orderkey % 4 WHEN 0 THEN '1.00' WHEN 1 THEN '0.50' "
        "WHEN 2 THEN '0.10' ELSE '0.01' END as decimal(3,2)) as decimal(12,2)) AS amount",
        f"o_orderdate + {seconds('(o_orderkey * 7919) % 86400')} AS transaction_time",
        "to_date(o_orderdate) AS transaction_date",
        "CASE WHEN o_orderkey % 29 <> 0 THEN o_orderpriority END AS account_reference",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'failed' END AS transaction_status",
        "cast(174000 + o_custkey % 37 as string) AS business_shortcode",
        f"transaction_time + {seconds('payment_key % 120')} AS received_at",
    )


def raw_feed(orders: DataFrame) -> DataFrame:
    """Landed events with deliberate dirt: copies, bad phones, negative amounts, null ids, bad times."""
    def tagged(name: str) -> str:
        return (
            f"""concat('{{"event_type":"', event_type, '"', """
            f"""coalesce(concat(',"{name}":"', account_reference, '"'), ''), '}}')"""
        )

    return payments(orders).selectExpr(
        "payment_key",
        "CASE WHEN payment_key % 83 <> 0 THEN transaction_id END AS transaction_id",
        "CASE WHEN payment_key % 97 = 0 THEN '12345' ELSE phone_number END AS phone_number",
        "CASE WHEN payment_key % 89 = 0 THEN '-5' ELSE cast(amount as string) END AS amount",
        "account_reference",
        "CASE WHEN payment_key % 79 = 0 THEN 'not-a-time' ELSE date_format(transaction_time, 'yyyyMMddHHmmss') END "
        "AS transaction_time",
        # a copy arrives ten minutes after the payment itself
        f"""explode(CASE WHEN payment_key % 50 = 0 THEN array(received_at,
            received_at + {seconds('600 - payment_key % 120')}) ELSE array(received_at) END) AS received_at""",
        "'daraja_webhook' AS source", "business_shortcode", "transaction_status",
        "CASE WHEN payment_key % 41 = 7 THEN 'c2b_validation' ELSE 'c2b_confirmation' END AS event_type",
        f"CASE payment_key % 3 WHEN 0 THEN {tagged('account_reference')} WHEN 1 THEN {tagged('AccountReference')} "
        "ELSE '{}' END AS payload",
    )


def callbacks(orders: DataFrame) -> DataFrame:
    """Wire callbacks: text fields, mixed phone spellings, blanks and broken values."""
    p, key = payments(orders), F.col("payment_key")
    phone = F.col("phone_number")
    return p.select(
        key,
        F.lit("Pay Bill").alias("TransactionType"),
        F.col("transaction_id").alias("TransID"),
        F.when(key % 79 == 0, "not-a-time").when(key % 79 == 1, "")
        .when(key % 79 == 2, F.date_format("transaction_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format("transaction_time", "yyyyMMddHHmmss")).alias("TransTime"),
        F.when(key % 89 == 0, "-5").when(key % 89 == 1, "abc").when(key % 89 == 2, F.lit(None))
        .when(key % 89 == 3, "2500000.00").otherwise(F.col("amount").cast("string")).alias("TransAmount"),
        F.when(key % 31 != 0, F.col("business_shortcode")).alias("BusinessShortCode"),
        F.concat(F.lit("BILL"), (key % 1000).cast("string")).alias("BillRefNumber"),
        F.lit("INV").alias("InvoiceNumber"),
        F.when(key % 7 == 0, F.concat(F.lit("+"), phone))
        .when(key % 7 == 1, F.concat(F.lit("0"), F.substring(phone, 4, 9)))
        .when(key % 7 == 2, F.concat(F.lit(" 0"), F.substring(phone, 4, 3), F.lit("-"), F.substring(phone, 7, 6)))
        .when(key % 97 == 0, "12345").otherwise(phone).alias("MSISDN"),
        F.when(key % 5 == 0, "").otherwise(F.col("account_reference")).alias("AccountReference"),
        F.concat(F.lit("First"), (key % 10).cast("string")).alias("FirstName"),
        F.when(key % 3 == 0, "").otherwise(F.lit("Mid")).alias("MiddleName"),
        F.when(key % 11 != 0, F.concat(F.lit("Last"), (key % 13).cast("string"))).alias("LastName"),
    )


def stream_events(events: DataFrame) -> DataFrame:
    """Payment events on the wire schema of the stream; amounts reach every rule branch."""
    amount = F.when(F.col("event_id") % 61 == 0, F.lit(0.5)).otherwise(F.round(F.col("value") * 1100, 2))
    return events.select(
        F.concat(F.lit("EVT"), F.col("event_id").cast("string")).alias("TransID"),
        F.concat(F.lit("07"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("MSISDN"),
        amount.alias("TransAmount"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        "event_type",
    )


def legacy_events(payments: DataFrame) -> DataFrame:
    """Older event shapes: the former type name, an unknown type, numeric amounts."""
    key = F.col("payment_key")
    return payments.select(
        F.when(key % 4 == 0, "c2b_transaction").when(key % 37 == 1, "refund").otherwise("c2b_confirmation").alias("event_type"),
        "transaction_id", "phone_number", "amount",
        F.date_format("transaction_time", "yyyyMMddHHmmss").alias("transaction_time"), "received_at",
    )


def stk_requests(payments: DataFrame) -> DataFrame:
    return payments.select(
        F.concat(F.lit("ws_CO_"), F.col("payment_key").cast("string")).alias("checkout_request_id"),
        "phone_number", F.col("amount").cast("double").alias("amount"), "account_reference",
        F.lit("initiated").alias("status"), F.col("transaction_time").alias("initiated_at"),
    )


def stk_messages(payments: DataFrame) -> DataFrame:
    """Nested callbacks: one in ten requests gets none, one in fifty callbacks matches no request,
    and one in seven is first reported as failed and later as its final code."""
    key = F.col("payment_key")
    number = key.cast("string")
    code = F.when(key % 5 == 1, 1).when(key % 5 == 2, 10).when(key % 5 == 3, 1032).otherwise(0)
    prefix = F.when(key % 50 == 3, "ws_XX_").otherwise("ws_CO_")

    def body(result, at):
        items = F.concat(
            F.lit(',"CallbackMetadata":{"Item":[{"Name":"Amount","Value":'), F.col("amount").cast("string"),
            F.lit('},{"Name":"MpesaReceiptNumber","Value":"RCP'), number,
            F.lit('"},{"Name":"PhoneNumber","Value":'), F.col("phone_number"), F.lit("}]}"),
        )
        text = F.concat(
            F.lit('{"Body":{"stkCallback":{"MerchantRequestID":"REQ'), number, F.lit('","CheckoutRequestID":"'), prefix, number,
            F.lit('","ResultCode":'), result.cast("string"), F.lit(',"ResultDesc":"code '), result.cast("string"), F.lit('"'),
            F.when(result == 0, items).otherwise(F.lit("")), F.lit("}}}"),
        )
        return F.struct(text.alias("value"), at.alias("received_at"))

    first = body(F.lit(1032), F.col("transaction_time") + F.expr("INTERVAL 20 SECONDS"))
    last = body(code, F.col("transaction_time") + F.expr("INTERVAL 45 SECONDS"))
    both = F.when(key % 7 == 0, F.array(first, last)).otherwise(F.array(last))
    return payments.filter(key % 10 != 9).select(F.explode(both).alias("_m")).select("_m.*")


def b2c_messages(payments: DataFrame) -> DataFrame:
    key = F.col("payment_key")
    number, code = key.cast("string"), F.when(key % 3 == 0, "1").otherwise("0")
    nested = F.concat(F.lit('{"ConversationID":"AG_'), number, F.lit('","Result":{"ResultCode":"'), code, F.lit('"}}'))
    flat = F.concat(F.lit('{"ConversationID":"AG_'), number, F.lit('","ResultCode":'), code, F.lit("}"))
    return payments.select(F.when(key % 2 == 0, nested).otherwise(flat).alias("value"))
