"""Registry of named queries and the shared table expressions of their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..functions.payments import PREFIX_REGIONS
from ..sources.dataset import Dataset


@dataclass(frozen=True)
class Entry:
    build: Callable[[Dataset], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Dataset(spark, folder))


CATALOG: dict[str, Entry] = {}


def query(key: str, sql: str | None = None):
    """Register a query under ``key``; ``sql`` may name any table of ``TABLES``."""

    def register(build: Callable[[Dataset], DataFrame]):
        if key in CATALOG:
            raise ValueError(f"{key} is already registered")
        CATALOG[key] = Entry(build, with_tables(sql) if sql else None)
        return build

    return register


_REGIONS = ", ".join(f"('{p}', '{r}')" for p, r in PREFIX_REGIONS.items())

# the same derivations as sources.dataset, written for DuckDB
TABLES: dict[str, str] = {
    "prefix_regions": f"SELECT * FROM (VALUES {_REGIONS}) v(prefix, region)",
    "payments_base": """
        SELECT o_orderkey AS payment_key,
          'TXN' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS transaction_id,
          '2547' || lpad(CAST((o_custkey * 666013) % 100000000 AS VARCHAR), 8, '0') AS phone_number,
          CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(CASE o_orderkey % 4 WHEN 0 THEN 1.00 WHEN 1 THEN 0.50
            WHEN 2 THEN 0.10 ELSE 0.01 END AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS amount,
          o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS transaction_time,
          CASE WHEN o_orderkey % 29 <> 0 THEN o_orderpriority END AS account_reference,
          CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'failed' END AS transaction_status,
          CAST(174000 + o_custkey % 37 AS VARCHAR) AS business_shortcode
        FROM orders""",
    "payments": """
        SELECT b.*, coalesce(r.region, 'Unknown') AS region,
          transaction_time + to_seconds(payment_key % 120) AS received_at
        FROM payments_base b LEFT JOIN prefix_regions r ON r.prefix = '0' || substr(b.phone_number, 4, 3)""",
    "feed_base": """
        SELECT payment_key,
          CASE WHEN payment_key % 83 <> 0 THEN transaction_id END AS transaction_id,
          CASE WHEN payment_key % 97 = 0 THEN '12345' ELSE phone_number END AS phone_number,
          CASE WHEN payment_key % 89 = 0 THEN '-5' ELSE CAST(amount AS VARCHAR) END AS amount,
          account_reference,
          CASE WHEN payment_key % 79 = 0 THEN 'not-a-time' ELSE strftime(transaction_time, '%Y%m%d%H%M%S') END
            AS transaction_time,
          received_at, 'daraja_webhook' AS source, business_shortcode, transaction_status,
          CASE WHEN payment_key % 41 = 7 THEN 'c2b_validation' ELSE 'c2b_confirmation' END AS event_type
        FROM payments""",
    "raw_feed": """
        SELECT *, CASE WHEN payment_key % 3 = 2 THEN '{}' ELSE '{"event_type":"' || event_type || '"' ||
            coalesce(CASE WHEN payment_key % 3 = 0 THEN ',"account_reference":"' ELSE ',"AccountReference":"' END
              || account_reference || '"', '') || '}' END AS payload
        FROM (SELECT * FROM feed_base UNION ALL
              SELECT * REPLACE (received_at + to_seconds(600 - payment_key % 120) AS received_at)
              FROM feed_base WHERE payment_key % 50 = 0) f""",
    "stg_raw": """
        SELECT transaction_id, received_at, source,
          coalesce(json_extract_string(payload, '$.event_type'), 'c2b_confirmation') AS event_type,
          phone_number, amount,
          coalesce(json_extract_string(payload, '$.account_reference'),
                   json_extract_string(payload, '$.AccountReference')) AS account_reference,
          strftime(try_strptime(transaction_time, '%Y%m%d%H%M%S'), '%Y%m%d%H%M%S') AS transaction_time, payload
        FROM raw_feed""",
    "typed_raw": """
        SELECT transaction_id, phone_number AS customer_phone_number, account_reference,
          TRY_CAST(amount AS DECIMAL(12,2)) AS transaction_amount,
          try_strptime(transaction_time, '%Y%m%d%H%M%S') AS transaction_timestamp, received_at AS loaded_at
        FROM stg_raw WHERE event_type = 'c2b_confirmation' AND transaction_id IS NOT NULL
          AND phone_number IS NOT NULL AND amount IS NOT NULL""",
    "typed_payments": """
        SELECT transaction_id, phone_number AS customer_phone_number, account_reference,
          amount AS transaction_amount, transaction_time AS transaction_timestamp, received_at AS loaded_at
        FROM payments""",
    "tx": """
        SELECT *, CAST(transaction_timestamp AS DATE) AS transaction_date,
          hour(transaction_timestamp) AS transaction_hour, isodow(transaction_timestamp) AS day_of_week,
          CASE WHEN transaction_amount >= 100000 THEN 'high' WHEN transaction_amount >= 10000 THEN 'medium'
            ELSE 'low' END AS amount_category,
          row_number() OVER (PARTITION BY customer_phone_number ORDER BY transaction_timestamp NULLS FIRST,
            reverse(transaction_id), loaded_at NULLS FIRST) AS transaction_sequence_per_customer
        FROM typed_payments""",
    "staged": """
        SELECT *, CAST(transaction_timestamp AS DATE) AS transaction_date,
          hour(transaction_timestamp) AS transaction_hour, isodow(transaction_timestamp) AS day_of_week,
          CASE WHEN transaction_amount >= 100000 THEN 'high' WHEN transaction_amount >= 10000 THEN 'medium'
            ELSE 'low' END AS amount_category,
          row_number() OVER (PARTITION BY customer_phone_number ORDER BY transaction_timestamp NULLS FIRST,
            reverse(transaction_id), loaded_at NULLS FIRST) AS transaction_sequence_per_customer
        FROM typed_raw""",
    "risky": """
        SELECT *, CASE WHEN transaction_amount >= 100000 THEN 'critical'
          WHEN transaction_hour < 6 OR transaction_hour >= 22 THEN 'elevated'
          WHEN transaction_sequence_per_customer >= 10 THEN 'velocity' ELSE 'normal' END AS risk_bucket
        FROM tx""",
    "heatmap": """
        SELECT transaction_date, account_reference, count(*) AS transaction_count,
          CAST(sum(transaction_amount) AS DOUBLE) AS total_amount
        FROM tx GROUP BY ALL""",
    "hourly": """
        SELECT date_trunc('hour', transaction_timestamp) AS hour_bucket, count(*) AS transaction_count,
          CAST(sum(transaction_amount) AS DOUBLE) AS total_amount,
          count(DISTINCT customer_phone_number) AS unique_customers
        FROM tx GROUP BY ALL""",
    "daily": """
        SELECT transaction_date, customer_phone_number, account_reference,
          count(DISTINCT transaction_id) AS transaction_count,
          CAST(sum(transaction_amount) AS DOUBLE) AS total_transaction_value,
          CAST(sum(transaction_amount) AS DOUBLE) / count(*) AS avg_transaction_amount,
          CAST(min(transaction_amount) AS DOUBLE) AS min_transaction_amount,
          CAST(max(transaction_amount) AS DOUBLE) AS max_transaction_amount,
          round(stddev_samp(CAST(transaction_amount AS DOUBLE)), 2) AS stddev_transaction_amount,
          count(CASE WHEN transaction_hour >= 6 AND transaction_hour < 12 THEN 1 END) AS morning_transactions,
          count(CASE WHEN transaction_hour >= 12 AND transaction_hour < 18 THEN 1 END) AS afternoon_transactions,
          count(CASE WHEN transaction_hour >= 18 OR transaction_hour < 6 THEN 1 END) AS evening_transactions,
          round(100.0::DOUBLE * count(CASE WHEN amount_category = 'low' THEN 1 END) / count(amount_category), 2) AS pct_low_amount,
          round(100.0::DOUBLE * count(CASE WHEN amount_category = 'medium' THEN 1 END) / count(amount_category), 2) AS pct_medium_amount,
          round(100.0::DOUBLE * count(CASE WHEN amount_category = 'high' THEN 1 END) / count(amount_category), 2) AS pct_high_amount,
          CAST(max(CASE WHEN day_of_week IN (6, 7) THEN 1 ELSE 0 END) AS BIGINT) AS is_weekend
        FROM tx GROUP BY transaction_date, customer_phone_number, account_reference""",
    "clock": "SELECT max(transaction_time) AS as_of FROM payments_base",
    "raw_clock": "SELECT max(received_at) AS as_of FROM raw_feed",
    "callbacks": """
        SELECT payment_key, 'Pay Bill' AS "TransactionType", transaction_id AS "TransID",
          CASE WHEN payment_key % 79 = 0 THEN 'not-a-time' WHEN payment_key % 79 = 1 THEN ''
            WHEN payment_key % 79 = 2 THEN strftime(transaction_time, '%Y-%m-%dT%H:%M:%SZ')
            ELSE strftime(transaction_time, '%Y%m%d%H%M%S') END AS "TransTime",
          CASE WHEN payment_key % 89 = 0 THEN '-5' WHEN payment_key % 89 = 1 THEN 'abc' WHEN payment_key % 89 = 2 THEN NULL
            WHEN payment_key % 89 = 3 THEN '2500000.00' ELSE CAST(amount AS VARCHAR) END AS "TransAmount",
          CASE WHEN payment_key % 31 <> 0 THEN business_shortcode END AS "BusinessShortCode",
          'BILL' || CAST(payment_key % 1000 AS VARCHAR) AS "BillRefNumber", 'INV' AS "InvoiceNumber",
          CASE WHEN payment_key % 7 = 0 THEN '+' || phone_number
            WHEN payment_key % 7 = 1 THEN '0' || substr(phone_number, 4, 9)
            WHEN payment_key % 7 = 2 THEN ' 0' || substr(phone_number, 4, 3) || '-' || substr(phone_number, 7, 6)
            WHEN payment_key % 97 = 0 THEN '12345' ELSE phone_number END AS "MSISDN",
          CASE WHEN payment_key % 5 = 0 THEN '' ELSE account_reference END AS "AccountReference",
          'First' || CAST(payment_key % 10 AS VARCHAR) AS "FirstName",
          CASE WHEN payment_key % 3 = 0 THEN '' ELSE 'Mid' END AS "MiddleName",
          CASE WHEN payment_key % 11 <> 0 THEN 'Last' || CAST(payment_key % 13 AS VARCHAR) END AS "LastName"
        FROM payments""",
    "validator_records": """
        SELECT * REPLACE (coalesce(strftime(try_strptime(transaction_time, '%Y%m%d%H%M%S'), '%Y-%m-%dT%H:%M:%S'),
          transaction_time) AS transaction_time) FROM raw_feed""",
    "validated": """
        SELECT *, CASE WHEN transaction_id IS NULL THEN 'missing_transaction_id' WHEN amount IS NULL THEN 'missing_amount'
          WHEN phone_number IS NULL THEN 'missing_phone' WHEN business_shortcode IS NULL THEN 'missing_shortcode'
          WHEN transaction_time IS NULL THEN 'missing_time'
          WHEN TRY_CAST(amount AS DOUBLE) IS NULL OR NOT isfinite(TRY_CAST(amount AS DOUBLE)) THEN 'amount_not_numeric'
          WHEN NOT regexp_full_match(phone_number, '254[0-9]{9}') THEN 'phone_format'
          WHEN TRY_CAST(transaction_time AS TIMESTAMP) IS NULL THEN 'time_format'
          WHEN TRY_CAST(amount AS DOUBLE) <= 0 THEN 'amount_not_positive' ELSE 'ok' END AS rule
        FROM validator_records""",
    "letters": """
        SELECT coalesce(transaction_id, sha256(payload)) AS message_id, 'transactions' AS original_topic,
          payload AS original_message,
          CASE WHEN rule IN ('time_format', 'amount_not_numeric') THEN 'invalid_format' ELSE 'validation_error' END AS failure_reason,
          'rule failed: ' || rule AS error_message, CAST(NULL AS VARCHAR) AS error_stacktrace, received_at AS "timestamp",
          0::BIGINT AS retry_count, 3::BIGINT AS max_retries, false AS is_recoverable
        FROM validated WHERE rule <> 'ok'""",
    "legacy_events": """
        SELECT CASE WHEN payment_key % 4 = 0 THEN 'c2b_transaction' WHEN payment_key % 37 = 1 THEN 'refund'
          ELSE 'c2b_confirmation' END AS event_type, transaction_id, phone_number, amount,
          strftime(transaction_time, '%Y%m%d%H%M%S') AS transaction_time, received_at FROM payments""",
    "stk_requests": """
        SELECT 'ws_CO_' || CAST(payment_key AS VARCHAR) AS checkout_request_id, phone_number,
          CAST(amount AS DOUBLE) AS amount, account_reference, 'initiated' AS status, transaction_time AS initiated_at
        FROM payments""",
    "stk_calls": """
        SELECT 'REQ' || CAST(payment_key AS VARCHAR) AS merchant_request_id,
          CASE WHEN payment_key % 50 = 3 THEN 'ws_XX_' ELSE 'ws_CO_' END || CAST(payment_key AS VARCHAR) AS checkout_request_id,
          CAST(code AS BIGINT) AS result_code, 'code ' || CAST(code AS VARCHAR) AS result_desc,
          CASE WHEN code = 0 THEN CAST(amount AS DOUBLE) END AS amount,
          CASE WHEN code = 0 THEN 'RCP' || CAST(payment_key AS VARCHAR) END AS receipt,
          CASE WHEN code = 0 THEN phone_number END AS phone_number, transaction_time + to_seconds(delay) AS received_at
        FROM (SELECT *, CASE payment_key % 5 WHEN 1 THEN 1 WHEN 2 THEN 10 WHEN 3 THEN 1032 ELSE 0 END AS code, 45 AS delay
              FROM payments
              UNION ALL SELECT *, 1032, 20 FROM payments WHERE payment_key % 7 = 0) c
        WHERE payment_key % 10 <> 9""",
    "stream_events": """
        SELECT 'EVT' || CAST(event_id AS VARCHAR) AS "TransID",
          '07' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS "MSISDN",
          CASE WHEN event_id % 61 = 0 THEN 0.5::DOUBLE ELSE round(value * 1100, 2) END AS "TransAmount",
          ts AS event_time, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type
        FROM events""",
}


def with_tables(sql: str) -> str:
    """Prefix ``sql`` with the shared table expressions it needs, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(TABLES[name])

    visit(sql)
    head = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in TABLES if name in needed)
    body = sql.strip()
    if not head:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
