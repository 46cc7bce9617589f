"""Branches of the row rules on hand-written rows."""

import hashlib
import hmac
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shillingflow.functions import payments as P
from shillingflow.functions import security as S
from shillingflow.functions import validation as V
from shillingflow.operators import analytics, dashboards, ingest, quality, stk
from shillingflow.sources import landing
from shillingflow.sources.dataset import Dataset


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_phone_forms(spark):
    phones = ["+254712345678", "0712345678", " 0712-345 678 ", "254712345678", "712345678", "25471234567", "", None]
    strict = values(spark, [(p,) for p in phones], "p string", P.normalize_ke_phone("p"))
    assert strict == ["254712345678"] * 4 + [None] * 4
    lenient = values(spark, [(p,) for p in phones[:2] + ["abc"]], "p string", P.standardize_phone("p"))
    assert lenient == ["254712345678", "254712345678", "abc"]


def test_transaction_times(spark):
    texts = ["20260613120000", "2026-06-13T12:00:00Z", "2026-06-13T12:00:00", "2026", "20261399120000", "x", "", None]
    parsed = values(spark, [(t,) for t in texts], "t string", P.txn_time("t"))
    assert [p is not None for p in parsed] == [True, True, True, False, False, False, False, False]
    unreadable = values(spark, [(t,) for t in texts], "t string", P.txn_time_unreadable("t"))
    assert [bool(u) for u in unreadable] == [False, False, False, True, True, True, False, False]


def test_anomaly_limits(spark):
    rows = [(500000.0,), (500000.01,), (0.99,), (1.0,), (None,)]
    df = spark.createDataFrame(rows, "a double").select(*[c.alias(n) for n, c in P.anomaly_columns("a").items()])
    got = [(r.anomaly_flag, r.anomaly_type, round(r.risk_score, 4)) for r in df.collect()]
    assert got == [(False, None, 40.0), (True, "unusually_large", 85.0), (True, "invalid_amount", 100.0),
                   (False, None, 10.0001), (True, "invalid_amount", 100.0)]


def test_category_and_buckets(spark):
    rows = [(Decimal("9999.99"),), (Decimal("10000.00"),), (Decimal("100000.00"),), (None,)]
    assert values(spark, rows, "a decimal(12,2)", P.amount_category("a")) == ["low", "medium", "high", "low"]
    hours = [(5,), (6,), (11,), (12,), (17,), (18,), (22,)]
    assert values(spark, hours, "h int", P.day_period("h")) == [
        "Evening/Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening/Night", "Evening/Night"]
    risk = spark.createDataFrame(
        [(100000.0, 3, 50), (5.0, 5, 50), (5.0, 22, 1), (5.0, 12, 10), (5.0, 12, 9)],
        "transaction_amount double, transaction_hour int, transaction_sequence_per_customer int")
    assert [r[0] for r in risk.select(P.risk_bucket()).collect()] == [
        "critical", "elevated", "elevated", "velocity", "normal"]
    assert values(spark, [("Peter", "", "Johnson"), (None, " ", "X")], "FirstName string, MiddleName string, LastName string",
                  P.customer_name()) == ["Peter Johnson", "X"]


RECORD = ("T1", "100.5", "254712345678", "174379", "2026-06-13T12:00:00")


@pytest.mark.parametrize("change, rule", [
    ({}, "ok"), ({2: "0712345678"}, "phone_format"), ({1: "-100"}, "amount_not_positive"), ({1: "0"}, "amount_not_positive"),
    ({1: "abc"}, "amount_not_numeric"), ({1: "NaN"}, "amount_not_numeric"), ({1: "Infinity"}, "amount_not_numeric"),
    ({4: "yesterday"}, "time_format"), ({0: None}, "missing_transaction_id"), ({3: None}, "missing_shortcode"),
])
def test_first_failing_rule(spark, change, rule):
    row = tuple(change.get(i, v) for i, v in enumerate(RECORD))
    df = spark.createDataFrame([row], "transaction_id string, amount string, phone_number string, "
                                      "business_shortcode string, transaction_time string")
    assert quality.validate_transactions(df).first()["rule"] == rule


def test_request_decision(spark):
    fields = ["TransactionType", "TransID", "TransTime", "TransAmount", "BusinessShortCode", "BillRefNumber",
              "InvoiceNumber", "MSISDN"]
    good = ["Pay Bill", "T1", "20260613120000", "1000.00", "174379", "B1", "I1", "0712345678"]

    def decide(**change):
        row = [change.get(f, v) for f, v in zip(fields, good)]
        df = spark.createDataFrame([tuple(row)], ", ".join(f"{f} string" for f in fields))
        reasons = V.c2b_request_reasons({f: f for f in fields})
        r = df.select(reasons.alias("why"), *[c.alias(n) for n, c in V.c2b_decision(reasons, "TransAmount").items()]).first()
        return r.ResultCode, r.why

    assert decide() == ("0", [])
    assert decide(TransAmount="1000001") == ("1", ["amount_too_large"])
    assert decide(TransAmount="0.5", MSISDN="12") == ("1", ["amount_too_small", "invalid_phone"])
    assert decide(TransAmount=None, TransTime="2026") == ("1", ["missing_TransAmount", "invalid_time"])


def test_routing_loses_no_row(spark):
    raw = Dataset(spark, "/root/testdata/sf0.001").validator_records
    valid, letters = quality.route(quality.validate_transactions(raw))
    assert valid.count() + letters.count() == raw.count()


def test_null_ids_are_not_duplicates(spark):
    df = spark.createDataFrame(
        [(None, 1, "a"), (None, 1, "a"), ("x", 2, "late"), ("x", 1, "early"), ("y", 1, "held")],
        "transaction_id string, received_at int, payload string")
    target = spark.createDataFrame([("y",), ("y",)], "transaction_id string")
    rows = sorted(landing.insert_ignore(target, df).collect(), key=str)
    assert [tuple(r) for r in rows] == sorted([(None, 1, "a"), (None, 1, "a"), ("x", 1, "early")], key=str)


def test_signature_equals_hmac(spark):
    message, secrets = "20260613{\"a\": 1}", ["test-secret", "k" * 100]
    df = spark.createDataFrame([(message,)], "m string")
    for secret in secrets:
        want = hmac.new(secret.encode(), message.encode(), hashlib.sha256).hexdigest()
        assert df.select(S.hmac_sha256("m", secret)).first()[0] == want
    given = [(message, None), (message, ""), (message, "0"), (message, hmac.new(b"s", message.encode(), hashlib.sha256).hexdigest())]
    assert values(spark, given, "m string, s string", S.signature_status("m", "s", "s")) == ["missing", "missing", "invalid", "ok"]


def test_redaction_and_encryption(spark):
    text = 'call 254712345678 key ' + "A1" * 25 + ' {"amount": 12.50} to a.b@c.example'
    assert values(spark, [(text,)], "t string", S.redact_text("t")) == [
        'call [PHONE_REDACTED] key [KEY_REDACTED] {"amount": [AMOUNT_REDACTED]} to [EMAIL_REDACTED]']
    assert values(spark, [("254712345678",), ("123",)], "p string", S.mask_phone("p")) == ["********5678", "123"]
    key = "0123456789abcdef"
    df = spark.createDataFrame([("254712345678",)], "p string").withColumn("c", S.encrypt_field("p", key))
    row = df.select("c", S.decrypt_field("c", key).alias("ok"), S.decrypt_field(F.lit("junk"), key).alias("bad")).first()
    assert row.ok == "254712345678" and row.bad is None and row.c != row.ok
    with pytest.raises(ValueError):
        S.encrypt_field("p", "short")


def test_payout_result_codes(spark):
    rows = [('{"ConversationID":"A","ResultCode":0}',), ('{"ConversationID":"B","Result":{"ResultCode":"0"}}',),
            ('{"ConversationID":"C","Result":{"ResultCode":"7"}}',), ('{"ConversationID":"D"}',)]
    df = stk.b2c_status(spark.createDataFrame(rows, "value string"))
    assert [r.status for r in df.collect()] == ["completed", "completed", "failed", "failed"]


def test_callback_without_code(spark):
    df = spark.createDataFrame([('{"Body":{"stkCallback":{"CheckoutRequestID":"c1"}}}',)], "value string")
    row = stk.stk_flatten(df).withColumn("s", stk.stk_status(F.col("result_code"))).first()
    assert (row.checkout_request_id, row.result_code, row.result_desc, row.s, row.receipt) == ("c1", -1, "", "failed", None)


def test_unreadable_amounts_leave_the_landing_rows(spark):
    d = Dataset(spark, "/root/testdata/sf0.001")
    rows, bad = ingest.parse_c2b(d.callbacks)
    assert rows.count() + bad.count() == d.callbacks.count() and bad.count() > 0


def test_single_payment_is_never_an_anomaly(spark):
    df = spark.createDataFrame(
        [("a", "p1", Decimal("5.00")), ("b", "p2", Decimal("1.00")), ("c", "p2", Decimal("3.00"))],
        "transaction_id string, phone_number string, amount decimal(12,2)"
    ).withColumn("transaction_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    rows = {r.transaction_id: r for r in analytics.zscores(df, F.lit("2024-01-01").cast("timestamp_ntz")).collect()}
    assert rows["a"].amount_zscore is None and round(rows["b"].amount_zscore, 3) == round(1 / (1.41 + 1), 3)


def test_short_history_gives_no_forecast(spark):
    df = spark.range(5).selectExpr(
        "cast(id as string) transaction_id", "cast(1 as decimal(12,2)) amount",
        "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id as int), 0, 0, 0) transaction_time")
    assert analytics.trend_forecast(df, F.lit("2024-01-06").cast("timestamp_ntz")).count() == 0


def test_mart_totals_agree(spark):
    d = Dataset(spark, "/root/testdata/sf0.001")
    total = d.tx.agg(F.sum("transaction_amount").cast("double")).first()[0]
    for mart, c in ((d.hourly, "total_amount"), (d.daily, "total_transaction_value"), (d.heatmap, "total_amount")):
        assert round(mart.agg(F.sum(c)).first()[0], 2) == round(total, 2)


def test_empty_range_gives_zero(spark):
    d = Dataset(spark, "/root/testdata/sf0.001")
    early = F.lit("1980-01-01").cast("timestamp_ntz")
    for panel in (dashboards.value_today, dashboards.avg_ticket_today, dashboards.repeat_rate, dashboards.median_value,
                  dashboards.top_customer_share):
        assert panel(d.tx, early).first()["value"] == 0.0
