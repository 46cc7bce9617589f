"""Parsing, validation, dead letters, security columns, landing, prompted payments."""

from pyspark.sql import functions as F

from .. import schemas
from ..functions import payments as P
from ..functions import security as S
from ..functions import validation as V
from ..operators import ingest, quality, stk
from ..session import shared_dir
from ..sources import files, landing
from .base import query

STD = r"""regexp_replace(regexp_replace(trim("MSISDN"), '^\+', ''), '^0', '254')"""
STRICT = r"""regexp_replace(regexp_replace(translate(trim("MSISDN"), ' -', ''), '^\+', ''), '^0', '254')"""
PHONE_OK = f"regexp_full_match({STRICT}, '254[0-9]{{9}}')"
COMPACT = """CASE WHEN regexp_full_match("TransTime", '[0-9]{14}') THEN try_strptime("TransTime", '%Y%m%d%H%M%S') END"""
NUMBER = """CASE WHEN isfinite(TRY_CAST("TransAmount" AS DOUBLE)) THEN TRY_CAST("TransAmount" AS DOUBLE) END"""


def q(key, build, sql=None):
    query(key, sql)(build)


# -- projections ---------------------------------------------------------------------------

q("event_envelope", lambda d: ingest.event_envelope(d.callbacks), """
SELECT 'c2b_confirmation' AS event_type, "TransID" AS transaction_id, "MSISDN" AS phone_number,
  "TransAmount" AS amount, coalesce(nullif("AccountReference", ''), "BillRefNumber") AS account_reference,
  "TransTime" AS transaction_time, 'daraja_webhook' AS source FROM callbacks""")

CALLBACK_FIELDS = schemas.CALLBACK.fieldNames()
ROWS_PER_FILE = 5_000


def _from_files(d):
    """Callbacks written as files of JSON arrays and read again, every field as text."""
    path, sent = shared_dir(d.spark, "json-callbacks"), d.callbacks.select([c for c in d.callbacks.columns if c in CALLBACK_FIELDS])
    files.write_json_arrays(sent, path, max(1, -(-sent.count() // ROWS_PER_FILE)))
    return files.json_callbacks(d.spark, path).select(*sent.columns)


q("json_file_source", _from_files, """
SELECT "TransactionType", "TransID", "TransTime", "TransAmount", "BusinessShortCode", "BillRefNumber",
  "InvoiceNumber", "MSISDN", "AccountReference", "FirstName", "MiddleName", "LastName" FROM callbacks""")

q("legacy_coerce", lambda d: ingest.legacy_coerce(d.legacy_events), """
SELECT CASE WHEN event_type = 'c2b_transaction' THEN 'c2b_confirmation' ELSE event_type END AS event_type,
  transaction_id, phone_number, CAST(amount AS VARCHAR) AS amount, transaction_time, received_at FROM legacy_events""")

q("parse_txn_time",
  lambda d: ingest.parse_times(d.callbacks, "TransTime").select("TransID", "TransTime", "parsed_time", "unreadable"), f"""
SELECT "TransID", "TransTime", parsed_time, coalesce("TransTime" <> '' AND parsed_time IS NULL, false) AS unreadable
FROM (SELECT *, coalesce({COMPACT}, TRY_CAST(replace(nullif("TransTime", ''), 'Z', '') AS TIMESTAMP)) AS parsed_time
      FROM callbacks) t""")

q("amount_category",
  lambda d: d.payments.select("transaction_id", P.amount_category("amount").alias("amount_category")), """
SELECT transaction_id, CASE WHEN amount >= 100000 THEN 'high' WHEN amount >= 10000 THEN 'medium' ELSE 'low' END
  AS amount_category FROM payments""")

q("standardize_phone", lambda d: d.callbacks.select("TransID", P.standardize_phone("MSISDN").alias("phone")),
  f'SELECT "TransID", {STD} AS phone FROM callbacks')

q("normalize_ke_phone", lambda d: d.callbacks.select("TransID", P.normalize_ke_phone("MSISDN").alias("phone")),
  f'SELECT "TransID", CASE WHEN {PHONE_OK} THEN {STRICT} END AS phone FROM callbacks')

q("parse_c2b", lambda d: ingest.parse_c2b(d.callbacks)[0].drop("raw_data"), f"""
SELECT "TransID" AS transaction_id, "MSISDN" AS phone_number, coalesce("BusinessShortCode", '') AS business_shortcode,
  coalesce({NUMBER}, 0) AS amount, "TransTime" AS transaction_time, 'completed' AS transaction_status,
  'c2b' AS payment_method, "BillRefNumber" AS reference, coalesce("AccountReference", '') AS account_reference,
  coalesce("BusinessShortCode", '') AS merchant_id, coalesce(r.region, 'Unknown') AS region
FROM callbacks c LEFT JOIN prefix_regions r
  ON r.prefix = substr(regexp_replace({STD}, '^254', '0'), 1, 4)
WHERE "TransAmount" IS NULL OR {NUMBER} IS NOT NULL""")

REGION_SQL = "SELECT transaction_id, phone_number, region FROM payments"
for _key in ("region_lookup", "region_join"):
    q(_key, lambda d: d.regional.select("transaction_id", "phone_number", "region"), REGION_SQL)


def _anomalies(df, amount, limit, *keep):
    return df.select(*keep, *[c.alias(n) for n, c in P.anomaly_columns(amount, max_single=limit).items()])


q("anomaly_rule", lambda d: _anomalies(d.raw_feed.withColumn("number", V.finite_amount("amount")), "number", 400000,
                                       "transaction_id", "received_at"), """
SELECT transaction_id, received_at, a > 400000 OR a < 1 AS anomaly_flag,
  CASE WHEN a > 400000 THEN 'unusually_large' WHEN a < 1 THEN 'invalid_amount' END AS anomaly_type,
  CASE WHEN a > 400000 THEN 85.0::DOUBLE WHEN a < 1 THEN 100.0::DOUBLE
    ELSE 10.0::DOUBLE + a / 400000.0::DOUBLE * 30.0::DOUBLE END AS risk_score
FROM (SELECT *, coalesce(TRY_CAST(amount AS DOUBLE), 0) AS a FROM raw_feed) t""")

q("day_period", lambda d: d.tx.select("transaction_id", P.day_period("transaction_hour").alias("period")), """
SELECT transaction_id, CASE WHEN transaction_hour >= 6 AND transaction_hour < 12 THEN 'Morning'
  WHEN transaction_hour >= 12 AND transaction_hour < 18 THEN 'Afternoon' ELSE 'Evening/Night' END AS period FROM tx""")

q("value_band", lambda d: d.tx.groupBy("customer_phone_number").agg(F.sum("transaction_amount").alias("_t")).select(
    "customer_phone_number", P.value_band("_t").alias("value_band")), """
SELECT customer_phone_number, CASE WHEN sum(transaction_amount) >= 100000 THEN 'Enterprise'
  WHEN sum(transaction_amount) >= 25000 THEN 'High Value' WHEN sum(transaction_amount) >= 5000 THEN 'Core'
  ELSE 'Long Tail' END AS value_band FROM tx GROUP BY 1""")

q("customer_name", lambda d: d.callbacks.select("TransID", P.customer_name().alias("customer_name")), """
SELECT "TransID", concat_ws(' ', nullif(trim("FirstName"), ''), nullif(trim("MiddleName"), ''),
  nullif(trim("LastName"), '')) AS customer_name FROM callbacks""")

q("fraud_alert_envelope", lambda d: ingest.fraud_alert_envelope(
    d.payments.filter("amount >= 100000").select("transaction_id", "phone_number", F.col("amount").cast("string")),
    F.col("transaction_id"), "high"), """
SELECT phone_number AS key, '{"alert_type":"fraud_detection","severity":"high","detected_at":"' || transaction_id
  || '","alert_data":{"transaction_id":"' || transaction_id || '","phone_number":"' || phone_number
  || '","amount":"' || CAST(amount AS VARCHAR) || '"}}' AS value FROM payments WHERE amount >= 100000""")

# -- validation and dead letters -----------------------------------------------------------

q("validate_transactions",
  lambda d: quality.validate_transactions(d.validator_records).select("transaction_id", "received_at", "rule", "is_valid"),
  "SELECT transaction_id, received_at, rule, rule = 'ok' AS is_valid FROM validated")
q("dq_transaction_rules", lambda d: quality.rule_counts(quality.validate_transactions(d.validator_records)),
  "SELECT rule, count(*) AS rows FROM validated GROUP BY 1")

FIELDS = ["TransactionType", "TransID", "TransTime", "TransAmount", "BusinessShortCode", "BillRefNumber",
          "InvoiceNumber", "MSISDN"]


def _reasons():
    return V.c2b_request_reasons({f: f for f in FIELDS})


REASONS_SQL = "list_filter([" + ", ".join(
    [f"""CASE WHEN "{f}" IS NULL THEN 'missing_{f}' END""" for f in FIELDS] + [
        f"""CASE WHEN "TransAmount" IS NOT NULL AND {NUMBER} IS NULL THEN 'amount_not_numeric' END""",
        f"CASE WHEN {NUMBER} < 1 THEN 'amount_too_small' END",
        f"CASE WHEN {NUMBER} > 1000000 THEN 'amount_too_large' END",
        f"""CASE WHEN "MSISDN" IS NOT NULL AND NOT {PHONE_OK} THEN 'invalid_phone' END""",
        f"""CASE WHEN "TransTime" IS NOT NULL AND ({COMPACT}) IS NULL THEN 'invalid_time' END""",
    ]) + "], lambda x: x IS NOT NULL)"

q("validate_c2b_request", lambda d: d.callbacks.select("TransID", F.array_join(_reasons(), ",").alias("reasons")),
  f"""SELECT "TransID", coalesce(array_to_string({REASONS_SQL}, ','), '') AS reasons FROM callbacks""")
q("c2b_decision", lambda d: d.callbacks.select(
    "TransID", *[c.alias(n) for n, c in V.c2b_decision(_reasons(), "TransAmount").items()]), f"""
SELECT "TransID", CASE WHEN len({REASONS_SQL}) > 0 THEN '1' ELSE '0' END AS "ResultCode",
  CASE WHEN len({REASONS_SQL}) > 0 THEN 'Validation failed' ELSE 'Validation accepted' END AS "ResultDesc"
FROM callbacks""")
q("api_c2b_check", lambda d: d.callbacks.select(
    "TransID", V.api_c2b_ok("TransAmount", "MSISDN", "TransTime").alias("accepted")), f"""
SELECT "TransID", coalesce({NUMBER} > 0 AND {NUMBER} <= 1000000 AND {PHONE_OK}
  AND ("TransTime" IS NULL OR "TransTime" = '' OR ({COMPACT}) IS NOT NULL), false) AS accepted FROM callbacks""")



def _description():
    key = F.col("payment_key")
    return F.when(key % 17 == 0, "pay <Script>x").when(key % 19 == 0, 'a onerror = "x"').otherwise("Payment")


q("stk_request_check", lambda d: d.callbacks.select("TransID", V.stk_request_reason(
    "MSISDN", "TransAmount", "AccountReference", _description()).alias("reason")), f"""
SELECT "TransID", CASE WHEN NOT {PHONE_OK} THEN 'invalid_phone'
  WHEN {NUMBER} IS NULL OR {NUMBER} <= 0 THEN 'amount_not_positive' WHEN {NUMBER} > 1000000 THEN 'amount_too_large'
  WHEN "AccountReference" IS NULL OR length("AccountReference") NOT BETWEEN 1 AND 64 THEN 'reference_length'
  WHEN payment_key % 17 = 0 OR payment_key % 19 = 0 THEN 'unsafe_text' ELSE 'ok' END AS reason FROM callbacks""")
q("event_type_check", lambda d: ingest.legacy_coerce(d.legacy_events).groupBy(
    "event_type", V.event_type_ok("event_type").alias("allowed")).agg(F.count("*").alias("events")), """
SELECT CASE WHEN event_type = 'c2b_transaction' THEN 'c2b_confirmation' ELSE event_type END AS event_type,
  event_type <> 'refund' AS allowed, count(*) AS events FROM legacy_events GROUP BY 1, 2""")


def _routed(d):
    return quality.route(quality.validate_transactions(d.validator_records))


q("dlq_route", lambda d: _routed(d)[1].withColumn("timestamp", P.ntz("timestamp")), "SELECT * FROM letters")
q("dlq_valid_rows", lambda d: _routed(d)[0].select("transaction_id", "received_at", "amount"),
  "SELECT transaction_id, received_at, amount FROM validated WHERE rule = 'ok'")


def _attempts(d):
    key = F.col("payment_key")
    return d.payments.select(
        F.col("transaction_id").alias("message_id"), (key % 5).alias("retry_count"),
        F.lit(3).cast("bigint").alias("max_retries"), (key % 3 != 0).alias("is_recoverable"),
        F.when(key % 2 == 0, "timeout").otherwise("validation_error").alias("failure_reason"),
    )


ATTEMPTS = """(SELECT transaction_id AS message_id, payment_key % 5 AS retry_count, 3::BIGINT AS max_retries,
  payment_key % 3 <> 0 AS is_recoverable,
  CASE WHEN payment_key % 2 = 0 THEN 'timeout' ELSE 'validation_error' END AS failure_reason FROM payments) a"""
q("dlq_retry_plan", lambda d: quality.retry_plan(_attempts(d)), f"""
SELECT message_id, CASE WHEN is_recoverable AND retry_count < 3 THEN retry_count + 1 ELSE retry_count END AS retry_count,
  max_retries, is_recoverable, failure_reason,
  CASE WHEN is_recoverable AND retry_count < 3 THEN 'retry' ELSE 'incident' END AS action FROM {ATTEMPTS}""")
q("dlq_stats", lambda d: quality.dlq_stats(_attempts(d)), f"""
SELECT 'total' AS dimension, 'all' AS value, count(*) AS errors FROM {ATTEMPTS}
UNION ALL SELECT 'type', failure_reason, count(*) FROM {ATTEMPTS} GROUP BY 2
UNION ALL SELECT 'recovery_status', CASE WHEN is_recoverable THEN 'pending' ELSE 'unrecoverable' END, count(*)
FROM {ATTEMPTS} GROUP BY 2""")
q("processing_stats", lambda d: quality.processing_stats(quality.validate_transactions(d.validator_records)), """
SELECT count(*) FILTER (rule = 'ok') AS processed_count, count(*) FILTER (rule <> 'ok') AS error_count,
  count(*) FILTER (rule <> 'ok') * 100.0::DOUBLE / count(*) AS error_rate FROM validated""")


# -- security ------------------------------------------------------------------------------

SECRET = "test-secret"


def _signed(d):
    key = F.col("payment_key")
    good = S.hmac_sha256("payload", SECRET)
    given = F.when(key % 7 == 0, F.lit(None)).when(key % 5 == 0, F.lit("0" * 64)).otherwise(good)
    return d.raw_feed.withColumn("signature", given)


q("verify_signature", lambda d: _signed(d).select(
    "payment_key", "received_at", S.signature_status("payload", "signature", SECRET).alias("status")), """
SELECT payment_key, received_at, CASE WHEN payment_key % 7 = 0 THEN 'missing' WHEN payment_key % 5 = 0 THEN 'invalid'
  ELSE 'ok' END AS status FROM raw_feed""")

REDACTED = "text"
_EDGE = f"[^{S.WORD}]"
for _pattern, _with in S.REDACTIONS:
    if _pattern.startswith("(?<!"):  # no look-around here: the neighbours are kept, and a second pass takes numbers that share one
        for _ in range(2):
            REDACTED = f"regexp_replace({REDACTED}, '(^|{_EDGE})\\p{{Nd}}{{10,12}}($|{_EDGE})', '\\1{_with}\\2', 'g')"
    else:
        REDACTED = f"regexp_replace({REDACTED}, '{_pattern}', '{_with}', 'g')"
q("redact_text", lambda d: d.table("documents").select("doc_id", S.redact_text("text").alias("text")),
  f"SELECT doc_id, {REDACTED} AS text FROM documents")
_ACCENTS = " josé@mail.ke, müller@büro.de 0712345678 254712345678 Ä0712345678 ٠٧١٢٣٤٥٦٧٨ Ελένη.κ@ταχυδρομείο.gr"
q("redact_accents", lambda d: d.table("documents").select("doc_id", S.redact_text(F.concat("text", F.lit(_ACCENTS))).alias("text")),
  f"SELECT doc_id, {REDACTED} AS text FROM (SELECT doc_id, text || '{_ACCENTS}' AS text FROM documents) t")
q("redact_payloads", lambda d: d.payments.select("transaction_id", S.redact_text(F.concat(
    F.lit("payer "), "phone_number", F.lit(' sent {"amount": '), F.col("amount").cast("string"),
    F.lit("} to shop-"), "business_shortcode", F.lit("@till.example"))).alias("text")),
  """SELECT transaction_id, 'payer [PHONE_REDACTED] sent {"amount": [AMOUNT_REDACTED]} to [EMAIL_REDACTED]' AS text
  FROM payments""")
q("mask_phone", lambda d: d.payments.select("transaction_id", S.mask_phone("phone_number").alias("phone")),
  "SELECT transaction_id, repeat('*', length(phone_number) - 4) || right(phone_number, 4) AS phone FROM payments")

FIELD_KEY = "0123456789abcdef"


def _round_trip(d):
    sealed = d.payments.select("transaction_id", "phone_number", S.encrypt_field("phone_number", FIELD_KEY).alias("sealed"))
    return sealed.select(
        "transaction_id", S.decrypt_field("sealed", FIELD_KEY).alias("opened"),
        S.decrypt_field("sealed", FIELD_KEY[::-1]).alias("wrong_key"),
        (F.col("sealed") != F.col("phone_number")).alias("hidden"),
    )


for _key in ("encrypt_field", "decrypt_field"):
    q(_key, _round_trip, """SELECT transaction_id, phone_number AS opened, CAST(NULL AS VARCHAR) AS wrong_key,
      true AS hidden FROM payments""")

# -- landing -------------------------------------------------------------------------------

LANDED = ["transaction_id", "received_at", "phone_number", "amount", "payload"]


def _split(d):
    """Rows already stored, and rows that arrive now; the boundary is a date, copies straddle it."""
    feed = d.raw_feed.select(*LANDED)
    edge = F.lit("1998-01-01").cast("timestamp_ntz")
    return landing.first_per_id(feed.filter(F.col("received_at") < edge)), feed.filter(F.col("received_at") >= edge)


FIRST = """SELECT transaction_id, received_at, phone_number, amount, payload FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY received_at, phone_number, amount, payload) AS rn
  FROM raw_feed {where}) f WHERE rn = 1 OR transaction_id IS NULL"""
q("raw_insert_ignore", lambda d: landing.first_per_id(d.raw_feed.select(*LANDED)), FIRST.format(where=""))
q("insert_ignore_anti", lambda d: landing.insert_ignore(*_split(d)),
  f"""SELECT * FROM ({FIRST.format(where="WHERE received_at >= TIMESTAMP '1998-01-01'")}) n
  WHERE transaction_id IS NULL OR transaction_id NOT IN
    (SELECT transaction_id FROM raw_feed WHERE received_at < TIMESTAMP '1998-01-01' AND transaction_id IS NOT NULL)""")


def _indexed(d):
    """The feed in arrival order, landed in three batches against the id index."""
    from ..session import shared_dir
    from ..sources.idindex import IdIndex

    path = shared_dir(d.spark, "indexed")
    index, feed = IdIndex(d.spark, f"{path}/ids", fan=2, period="year"), d.raw_feed.select(*LANDED)
    cuts = feed.select(F.unix_seconds(F.col("received_at").cast("timestamp")).alias("t")).stat.approxQuantile("t", [1 / 3, 2 / 3], 0.01)
    number = F.lit(0)
    for cut in cuts:
        number = number + F.when(F.unix_seconds(F.col("received_at").cast("timestamp")) >= cut, 1).otherwise(0)
    feed = feed.withColumn("_batch", number)
    for n in range(3):
        index.compact(n)
        rows = landing.insert_indexed(index, feed.filter(F.col("_batch") == n).drop("_batch"), n)
        rows.write.parquet(f"{path}/raw/batch={n}")
        index.add(d.spark.read.schema(rows.schema).parquet(f"{path}/raw/batch={n}"), n)
    return d.spark.read.parquet(f"{path}/raw").drop("batch")


q("insert_ignore_indexed", _indexed, FIRST.format(where=""))
q("confirm_upsert", lambda d: landing.confirm_upsert(d.raw_feed.select(*LANDED)), """
SELECT transaction_id, min(received_at) AS received_at, arg_min(phone_number, received_at) AS phone_number,
  arg_min(amount, received_at) AS amount, arg_max(payload, received_at) AS payload,
  CASE WHEN count(*) > 1 THEN max(received_at) END AS updated_at, 'confirmed' AS status
FROM raw_feed WHERE transaction_id IS NOT NULL GROUP BY 1
UNION ALL SELECT transaction_id, received_at, phone_number, amount, payload, NULL, 'confirmed'
FROM raw_feed WHERE transaction_id IS NULL""")


def _appended(d):
    from ..session import shared_dir

    path = shared_dir(d.spark, "append")
    stored, incoming = _split(d)
    landing.append_plain(stored, path)
    landing.append_plain(incoming, path)
    return d.spark.read.parquet(path).groupBy("transaction_id").agg(F.count("*").alias("arrivals"))


q("raw_append_plain", _appended, f"""
SELECT transaction_id, count(*) AS arrivals FROM (
  SELECT transaction_id FROM ({FIRST.format(where="WHERE received_at < TIMESTAMP '1998-01-01'")}) s
  UNION ALL SELECT transaction_id FROM raw_feed WHERE received_at >= TIMESTAMP '1998-01-01') a GROUP BY 1""")
q("windowed_scan", lambda d: landing.windowed_scan(d.payments, d.as_of, 30).withColumn("amount", F.col("amount").cast("double")),
  """SELECT transaction_id, phone_number, CAST(amount AS DOUBLE) AS amount, transaction_time, business_shortcode
  FROM payments WHERE transaction_time >= (SELECT as_of FROM clock) - INTERVAL 30 DAY""")

# -- model tests ---------------------------------------------------------------------------


def _dirty_models(d):
    from ..operators import marts

    return {
        "stg_raw_events": d.stg_raw, "stg_c2b_transactions": d.staged,
        "mart_county_heatmap": marts.county_heatmap(d.staged),
        "mart_daily_transactions": marts.daily_transactions(d.staged),
        "mart_hourly_volumes": marts.hourly_volumes(d.staged),
    }


def _tests_sql():
    tables = {
        "stg_raw_events": "stg_raw", "stg_c2b_transactions": "staged",
        "mart_county_heatmap": "(SELECT transaction_date, account_reference, count(*) AS transaction_count, "
                               "sum(transaction_amount) AS total_amount FROM staged GROUP BY ALL) h",
        "mart_daily_transactions": "(SELECT transaction_date, customer_phone_number, account_reference, "
                                   "count(DISTINCT transaction_id) AS transaction_count, sum(transaction_amount) AS total_transaction_value, "
                                   "avg(transaction_amount) AS avg_transaction_amount, max(transaction_amount) AS max_transaction_amount, "
                                   "min(transaction_amount) AS min_transaction_amount FROM staged GROUP BY 1, 2, 3) d",
        "mart_hourly_volumes": "(SELECT date_trunc('hour', transaction_timestamp) AS hour_bucket, count(*) AS transaction_count, "
                               "sum(transaction_amount) AS total_amount, count(DISTINCT customer_phone_number) AS unique_customers "
                               "FROM staged GROUP BY 1) v",
    }
    parts = []
    for model, columns in quality.NOT_NULL.items():
        for c in columns:
            parts.append(f"""SELECT '{model}' AS model, '{c}' AS "column", 'not_null' AS test,
              count(*) FILTER ({c} IS NULL) AS failures FROM {tables[model]}""")
    for model, columns in quality.UNIQUE.items():
        for c in columns:
            parts.append(f"""SELECT '{model}', '{c}', 'unique', count(*) FROM (SELECT {c} FROM {tables[model]}
              WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) u""")
    parts.append("""SELECT 'stg_c2b_transactions', 'amount_category', 'accepted_values',
      count(DISTINCT amount_category) FILTER (amount_category NOT IN ('low', 'medium', 'high')) FROM staged""")
    return " UNION ALL ".join(parts)


q("dq_tests", lambda d: quality.model_tests(_dirty_models(d)), _tests_sql())
q("dq_dag_checks", lambda d: quality.staging_checks(d.staged, F.lit("2001-01-01").cast("timestamp_ntz")), """
SELECT 'transaction_id_null' AS check_name, count(*) FILTER (transaction_id IS NULL) AS failures FROM staged
UNION ALL SELECT 'invalid_phone', count(*) FILTER (customer_phone_number NOT LIKE '254%') FROM staged
UNION ALL SELECT 'negative_amount', count(*) FILTER (transaction_amount < 0) FROM staged
UNION ALL SELECT 'future_transactions', count(*) FILTER (transaction_date > DATE '2001-01-01') FROM staged""")

# -- prompted payments ---------------------------------------------------------------------


def _calls(d):
    return stk.stk_flatten(d.stk_messages, keep=("received_at",))


q("stk_flatten", _calls, "SELECT * FROM stk_calls")
q("stk_items", lambda d: stk.stk_items(d.stk_messages), """
SELECT checkout_request_id, unnest(['Amount', 'MpesaReceiptNumber', 'PhoneNumber']) AS name,
  unnest([CAST(amount AS VARCHAR), receipt, phone_number]) AS value
FROM stk_calls WHERE result_code = 0""")
q("stk_status", lambda d: _calls(d).groupBy(stk.stk_status(F.col("result_code")).alias("status")).agg(F.count("*").alias("callbacks")), """
SELECT CASE result_code WHEN 0 THEN 'completed' WHEN 1 THEN 'cancelled' WHEN 10 THEN 'expired' ELSE 'failed' END AS status,
  count(*) AS callbacks FROM stk_calls GROUP BY 1""")
LAST_CALL = """(SELECT checkout_request_id, max(received_at) AS called_at, arg_max(result_code, received_at) AS code,
  arg_max(result_desc, received_at) AS descr, arg_max(coalesce(receipt, ''), received_at) AS receipt
  FROM stk_calls GROUP BY 1) l"""
q("stk_match_callback", lambda d: stk.match_callbacks(d.stk_requests, _calls(d)), f"""
SELECT r.checkout_request_id, phone_number, amount, account_reference, initiated_at,
  CASE WHEN called_at IS NULL THEN status WHEN code = 0 THEN 'completed' WHEN code = 1 THEN 'cancelled'
    WHEN code = 10 THEN 'expired' ELSE 'failed' END AS status,
  code AS result_code, descr AS result_desc, called_at AS completed_at
FROM stk_requests r LEFT JOIN {LAST_CALL} ON r.checkout_request_id = l.checkout_request_id""")
q("stk_status_api", lambda d: stk.api_transactions(d.stk_requests, _calls(d)), f"""
SELECT CASE WHEN receipt <> '' THEN receipt ELSE l.checkout_request_id END AS transaction_id,
  coalesce(phone_number, '') AS phone_number, coalesce(amount, 0) AS amount, 'success' AS status,
  coalesce(account_reference, '') AS account_reference, 'stk_callback' AS source, called_at AS received_at
FROM {LAST_CALL} LEFT JOIN stk_requests r ON r.checkout_request_id = l.checkout_request_id WHERE code = 0""")
q("b2c_status", lambda d: stk.b2c_status(d.b2c_messages), """
SELECT 'AG_' || CAST(payment_key AS VARCHAR) AS transaction_id, 'B2C' AS transaction_type,
  CASE WHEN payment_key % 3 = 0 THEN 'failed' ELSE 'completed' END AS status FROM payments""")
