"""Lookups, risk, health, analyses, stream twins and fraud features."""

from pyspark.sql import functions as F

from ..functions import payments as P
from ..operators import analytics as A
from ..operators import health as H
from ..operators import lookups as L
from ..operators import risk as R
from ..operators.ml import ensemble, features, store
from .base import CATALOG, query

NOW = "(SELECT as_of FROM clock)"
RAW_NOW = "(SELECT as_of FROM raw_clock)"
DAY = "1998-03-14"
START, END = "1998-01-01", "1998-06-30"


def q(key, build, sql=None):
    query(key, sql)(build)


def since(days, table="payments"):
    return f"{table} WHERE transaction_time >= {NOW} - INTERVAL {days} DAY"


def r2(x, digits=2):
    return f"round(CAST({x} AS DECIMAL(24,6)), {digits})::DOUBLE"


def plain(df, c="transaction_amount"):
    return df.withColumn(c, F.col(c).cast("double"))


TX = """transaction_id, customer_phone_number, account_reference, CAST(transaction_amount AS DOUBLE) AS transaction_amount,
  transaction_timestamp, transaction_date, transaction_hour, day_of_week, loaded_at, amount_category"""

# -- lookups -------------------------------------------------------------------------------

q("txn_by_id", lambda d: plain(L.txn_by_id(d.tx, "TXN0000000042")), f"SELECT {TX} FROM tx WHERE transaction_id = 'TXN0000000042'")

BUSY = f"2547{50 * 666013 % 10**8:08d}"  # customer 50
q("txns_by_phone", lambda d: plain(L.txns_by_phone(d.tx, BUSY)), f"""
SELECT {TX} FROM tx WHERE customer_phone_number = '{BUSY}' ORDER BY transaction_timestamp DESC, transaction_id LIMIT 100""")
q("daily_summary", lambda d: L.daily_summary(d.daily, DAY), f"SELECT * FROM daily WHERE transaction_date = DATE '{DAY}'")
q("heatmap_data", lambda d: L.heatmap_data(d.heatmap, DAY), f"SELECT * FROM heatmap WHERE transaction_date = DATE '{DAY}'")
q("txn_statistics", lambda d: L.txn_statistics(d.tx, START, END), f"""
SELECT count(*) AS total_transactions, CAST(sum(transaction_amount) AS DOUBLE) AS total_amount,
  CAST(sum(transaction_amount) AS DOUBLE) / count(*) AS avg_amount, CAST(min(transaction_amount) AS DOUBLE) AS min_amount,
  CAST(max(transaction_amount) AS DOUBLE) AS max_amount, count(DISTINCT customer_phone_number) AS unique_customers
FROM tx WHERE transaction_date BETWEEN DATE '{START}' AND DATE '{END}'""")
q("top_merchants", lambda d: L.top_merchants(d.tx), """
SELECT account_reference, count(*) AS transaction_count, CAST(sum(transaction_amount) AS DOUBLE) AS total_amount,
  CAST(sum(transaction_amount) AS DOUBLE) / count(*) AS avg_amount
FROM tx GROUP BY 1 ORDER BY transaction_count DESC, account_reference NULLS FIRST LIMIT 10""")
q("hourly_trend", lambda d: L.hourly_trend(d.tx, DAY), f"""
SELECT date_trunc('hour', transaction_timestamp) AS hour, count(*) AS transaction_count,
  CAST(sum(transaction_amount) AS DOUBLE) AS total_amount FROM tx WHERE transaction_date = DATE '{DAY}' GROUP BY 1""")
q("list_transactions", lambda d: L.list_transactions(
    d.payments, status="completed", start_date=START, end_date=END, min_amount=100, max_amount=200000, page=3, limit=20), f"""
SELECT transaction_id, CAST(amount AS DOUBLE) AS amount, phone_number, transaction_time, transaction_status,
  total, CAST(ceil(total / 20.0) AS BIGINT) AS pages
FROM (SELECT *, count(*) OVER () AS total, row_number() OVER (ORDER BY transaction_time DESC, transaction_id) AS rn
  FROM payments WHERE transaction_status = 'completed' AND transaction_time >= TIMESTAMP '{START}'
    AND transaction_time < TIMESTAMP '{END}' + INTERVAL 1 DAY AND amount BETWEEN 100 AND 200000) p
WHERE rn BETWEEN 41 AND 60""")
def _history(d):
    names = d.callbacks.select(P.normalize_ke_phone("MSISDN").alias("phone_number"), P.customer_name().alias("customer_name"))
    return L.customer_history(d.tx, BUSY, names=names)


q("customer_history", _history)
q("customer_history_rows", lambda d: _history(d).select(
    "phone_number", "customer_name", "total_transactions", "total_amount", F.explode("transactions").alias("t")).select(
    "phone_number", "customer_name", "total_transactions", "total_amount", "t.transaction_id", "t.amount", "t.account_reference"), f"""
SELECT '{BUSY}' AS phone_number,
  (SELECT max(concat_ws(' ', nullif(trim("FirstName"), ''), nullif(trim("MiddleName"), ''), nullif(trim("LastName"), '')))
   FROM callbacks c JOIN payments p USING (payment_key) WHERE p.phone_number = '{BUSY}' AND "MSISDN" <> '12345') AS customer_name,
  count(*) OVER () AS total_transactions, CAST(sum(transaction_amount) OVER () AS DOUBLE) AS total_amount,
  transaction_id, CAST(transaction_amount AS DOUBLE) AS amount, account_reference
FROM tx WHERE customer_phone_number = '{BUSY}' ORDER BY transaction_timestamp DESC, transaction_id LIMIT 50"""
)
q("risk_profile", lambda d: L.risk_profile(d.payments), """
SELECT phone_number, count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
  CAST(max(amount) AS DOUBLE) AS max_amount,
  CASE WHEN count(*) >= 10 AND max(amount) >= 50000 THEN 0.9::DOUBLE WHEN max(amount) >= 100000 THEN 0.7::DOUBLE
    WHEN sum(amount) >= 250000 THEN 0.6::DOUBLE ELSE 0.1::DOUBLE END AS fraud_score,
  CASE WHEN (count(*) >= 10 AND max(amount) >= 50000) OR max(amount) >= 100000 THEN 'high' ELSE 'low' END AS risk_level
FROM payments GROUP BY 1""")
q("fraud_alerts", lambda d: L.fraud_alerts(d.payments, "high"), """
SELECT 'fraud-' || phone_number AS alert_id, phone_number, 'high' AS severity,
  CASE WHEN count(*) >= 10 AND max(amount) >= 50000 THEN 0.9::DOUBLE ELSE 0.7::DOUBLE END AS fraud_score
FROM payments GROUP BY phone_number HAVING (count(*) >= 10 AND max(amount) >= 50000) OR max(amount) >= 100000""")
q("customer_analytics", lambda d: L.customer_analytics(d.payments, "0" + BUSY[3:]), f"""
SELECT phone_number, count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
  CASE WHEN count(*) >= 10 AND max(amount) >= 50000 THEN 0.9::DOUBLE WHEN max(amount) >= 100000 THEN 0.7::DOUBLE
    WHEN sum(amount) >= 250000 THEN 0.6::DOUBLE ELSE 0.1::DOUBLE END AS fraud_score,
  CASE WHEN (count(*) >= 10 AND max(amount) >= 50000) OR max(amount) >= 100000 THEN 'high' ELSE 'low' END AS risk_level
FROM payments WHERE phone_number = '{BUSY}' GROUP BY 1""")
q("analytics_summary", lambda d: L.analytics_summary(d.payments), """
SELECT count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
  count(DISTINCT phone_number) AS unique_customers FROM payments""")
q("api_daily_summary", lambda d: L.api_daily_summary(d.payments, DAY), f"""
SELECT DATE '{DAY}' AS date, count(*) AS total_transactions, CAST(sum(amount) AS DOUBLE) AS total_amount,
  CAST(sum(amount) AS DOUBLE) / count(*) AS average_amount, count(DISTINCT phone_number) AS unique_customers,
  {r2("100.0::DOUBLE * count(*) FILTER (transaction_status = 'completed') / count(*)")} AS success_rate,
  (SELECT hour(transaction_time) AS h FROM payments WHERE CAST(transaction_time AS DATE) = DATE '{DAY}'
   GROUP BY 1 ORDER BY count(*) DESC, h LIMIT 1) AS peak_hour
FROM payments WHERE CAST(transaction_time AS DATE) = DATE '{DAY}'""")
RANGE = f"payments WHERE CAST(transaction_time AS DATE) BETWEEN DATE '{START}' AND DATE '{END}'"
q("api_report", lambda d: L.api_report(d.payments, START, END), f"""
SELECT s.*, {r2('g', 4)} AS daily_growth, {r2('c', 4)} AS customer_growth FROM
 (SELECT count(*) AS total_transactions, CAST(sum(amount) AS DOUBLE) AS total_volume,
    count(DISTINCT phone_number) AS unique_customers, CAST(sum(amount) AS DOUBLE) / count(*) AS average_transaction
  FROM {RANGE}) s,
 (SELECT avg(100.0::DOUBLE * (n - pn) / pn) AS g, avg(100.0::DOUBLE * (u - pu) / pu) AS c FROM (
    SELECT n, u, lag(n) OVER (ORDER BY day) AS pn, lag(u) OVER (ORDER BY day) AS pu FROM (
      SELECT CAST(transaction_time AS DATE) AS day, count(*) AS n, count(DISTINCT phone_number) AS u
      FROM {RANGE} GROUP BY 1) a) b) t""")
q("report_top_customers", lambda d: L.report_top_customers(d.payments, START, END), f"""
SELECT phone_number, count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) AS total_amount
FROM {RANGE} GROUP BY 1 ORDER BY total_amount DESC, phone_number LIMIT 10""")

# -- health --------------------------------------------------------------------------------

NUM = "TRY_CAST(amount AS DECIMAL(12,2))"
q("volume_check", lambda d: H.volume_check(d.raw_feed, d.raw_as_of, hours=720), f"""
SELECT count(*) AS transaction_count, count(DISTINCT phone_number) AS unique_customers,
  coalesce(CAST(sum({NUM}) AS DOUBLE), 0) AS total_amount, coalesce(CAST(sum({NUM}) AS DOUBLE) / count({NUM}), 0) AS avg_amount,
  coalesce(CAST(max({NUM}) AS DOUBLE), 0) AS max_amount, coalesce(CAST(min({NUM}) AS DOUBLE), 0) AS min_amount
FROM raw_feed WHERE received_at > {RAW_NOW} - INTERVAL 720 HOUR""")
RAW_CLOCK = "(SELECT max(received_at) + INTERVAL 12 HOUR FROM raw_feed)"
q("staleness_check", lambda d: H.staleness_check(d.raw_feed, d.fixed_clock), f"""
SELECT max(received_at) AS last_transaction_time,
  CAST(epoch({RAW_CLOCK}) - epoch(max(received_at)) AS BIGINT) AS staleness_seconds,
  CASE WHEN epoch({RAW_CLOCK}) - epoch(max(received_at)) < 300 THEN 'healthy' ELSE 'warning' END AS status
FROM raw_feed""")
q("db_status", lambda d: H.db_status(d.payments, d.as_of), f"""
SELECT count(*) AS raw_transactions, count(DISTINCT phone_number) AS unique_customers,
  coalesce(CAST(sum(amount) FILTER (CAST(transaction_time AS DATE) = CAST({NOW} AS DATE)) AS DOUBLE), 0) AS total_volume
FROM payments""")
q("amount_histogram", lambda d: H.amount_histogram(d.payments), " UNION ALL ".join(
    [f"SELECT '{b}' AS le, count(*) FILTER (amount <= {b}) AS cumulative_count FROM payments" for b in H.AMOUNT_BOUNDS]
    + ["SELECT '+Inf', count(amount) FROM payments"]))
q("metrics_by_status", lambda d: H.status_counts(d.payments),
  "SELECT transaction_status AS status, count(*) AS transactions FROM payments GROUP BY 1")
q("metrics_by_window", lambda d: H.metrics_by_window(d.payments), """
SELECT date_trunc('hour', transaction_time) AS window_start, count(DISTINCT phone_number) AS unique_customers,
  CAST(sum(amount) AS DOUBLE) AS amount_sum FROM payments GROUP BY 1""")
LAG = "epoch_us(received_at) - epoch_us(try_strptime(transaction_time, '%Y%m%d%H%M%S'))"
q("ingest_latency", lambda d: H.ingest_latency(d.raw_feed), f"""
SELECT event_type, {r2('quantile_cont(l, 0.5)', 4)} AS p50, {r2('quantile_cont(l, 0.95)', 4)} AS p95,
  {r2('quantile_cont(l, 0.99)', 4)} AS p99
FROM (SELECT event_type, ({LAG}) / 1000000.0::DOUBLE AS l FROM raw_feed) x WHERE l IS NOT NULL GROUP BY 1""")
q("arrivals_per_minute", lambda d: H.arrivals_per_minute(d.raw_feed), """
SELECT event_type, date_trunc('minute', received_at) AS minute, count(*) AS rows FROM raw_feed GROUP BY 1, 2""")
q("reconcile_daily", lambda d: H.reconcile_daily(d.raw_feed, d.staged), """
SELECT coalesce(rd, sd) AS date, count(*) FILTER (rd IS NOT NULL AND sd IS NOT NULL) AS matched,
  count(*) FILTER (rd IS NULL OR sd IS NULL) AS unmatched,
  count(*) FILTER (rd IS NOT NULL AND sd IS NOT NULL) / count(*) AS match_rate
FROM (SELECT transaction_id, min(CAST(received_at AS DATE)) AS rd FROM raw_feed WHERE transaction_id IS NOT NULL GROUP BY 1) r
FULL JOIN (SELECT transaction_id, min(CAST(loaded_at AS DATE)) AS sd FROM staged GROUP BY 1) s
ON r.transaction_id = s.transaction_id GROUP BY 1""")
q("bench_select", lambda d: H.bench_select(d.payments, d.as_of), f"""
SELECT count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
  CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount FROM {since(7)}""")
for _key, _days, _more in (("bench_complex", 30, 5), ("bench_complex_all_days", 3650, 5)):
    q(_key, lambda d, days=_days, more=_more: H.bench_complex(d.payments, d.as_of, days, more), f"""
SELECT phone_number, count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
  CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount, CAST(max(amount) AS DOUBLE) AS max_amount
FROM {since(_days)} GROUP BY 1 HAVING count(*) > {_more} ORDER BY total_amount DESC, phone_number LIMIT 100""")

# -- analyses ------------------------------------------------------------------------------


def customer_day_sql(days, top=None):
    return f"""
SELECT phone_number, last_transaction_date, transaction_count, total_amount, avg_amount, max_amount, min_amount,
  {r2('std', 4)} AS std_amount, total_amount / transaction_count AS avg_transaction_value,
  transaction_count / {days}.0::DOUBLE AS transaction_frequency, {r2('std / (avg_amount + 1)', 4)} AS volatility,
  {r2('total_amount / max(total_amount) OVER () * 0.5::DOUBLE + transaction_count / max(transaction_count) OVER () * 0.3::DOUBLE + avg_amount / max(avg_amount) OVER () * 0.2::DOUBLE', 4)}
    AS customer_value_score
FROM (SELECT phone_number, CAST(transaction_time AS DATE) AS last_transaction_date, count(*) AS transaction_count,
    CAST(sum(amount) AS DOUBLE) AS total_amount, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount,
    CAST(max(amount) AS DOUBLE) AS max_amount, CAST(min(amount) AS DOUBLE) AS min_amount,
    coalesce(stddev_samp(CAST(amount AS DOUBLE)), 0) AS std
  FROM {since(days)} GROUP BY 1, 2{f' ORDER BY total_amount DESC, phone_number, last_transaction_date LIMIT {top}' if top else ''}) g"""


q("customer_day_metrics", lambda d: A.customer_day_metrics(d.payments, d.as_of), customer_day_sql(90))
q("customer_day_metrics_all", lambda d: A.customer_day_metrics(d.payments, d.as_of, days=3650), customer_day_sql(3650))
BAND = "CASE WHEN total_amount >= 100000 THEN 'large' WHEN transaction_count > 1 THEN 'busy' ELSE 'other' END"
q("segment_stats_given", lambda d: A.segment_stats(
    A.customer_day_metrics(d.payments, d.as_of, days=3650).withColumn("segment_name", F.expr(BAND))), f"""
SELECT segment_name, count(*) AS customers, {r2('avg(transaction_count)')} AS mean_count, {r2('avg(total_amount)')} AS mean_total,
  {r2('stddev_samp(total_amount)')} AS std_total, {r2('avg(avg_amount)')} AS mean_avg,
  {r2('avg(customer_value_score)')} AS mean_score, {r2('quantile_cont(total_amount, 0.5)')} AS median_total
FROM (SELECT *, {BAND} AS segment_name FROM ({customer_day_sql(3650)}) m) s GROUP BY 1""")
q("customer_day_metrics_top", lambda d: A.customer_day_metrics(d.payments, d.as_of, days=3650, top=1000),
  customer_day_sql(3650, 1000))
HOURS = """(SELECT phone_number, date_trunc('hour', transaction_time) AS th, count(*) AS n, sum(amount) AS amount
  FROM {src} GROUP BY 1, 2) h"""
q("peak_hours", lambda d: A.peak_hours(d.payments, d.as_of, days=90), f"""
SELECT hour(th) AS hour_of_day, CAST(sum(n) AS BIGINT) AS transaction_count,
  (SELECT {r2('avg(n)')} FROM {HOURS.format(src=since(90))}) AS avg_transaction_per_hour
FROM {HOURS.format(src=since(90))} GROUP BY 1 ORDER BY transaction_count DESC, hour_of_day LIMIT 3""")
q("daily_pattern", lambda d: A.daily_pattern(d.payments, d.as_of, days=90), f"""
SELECT isodow(th) - 1 AS day_of_week, CAST(sum(n) AS BIGINT) AS transaction_count,
  CAST(sum(amount) AS DOUBLE) AS total_amount, count(DISTINCT phone_number) AS unique_customers
FROM {HOURS.format(src=since(90))} GROUP BY 1""")
DAILY = f"""(SELECT CAST(transaction_time AS DATE) AS transaction_date, count(*) AS transaction_count,
  CAST(sum(amount) AS DOUBLE) AS daily_volume FROM {since(90)} GROUP BY 1) d"""
q("daily_volume", lambda d: A.daily_volume(d.payments, d.as_of), f"SELECT * FROM {DAILY}")
MOVING = f"""(SELECT *, CASE WHEN count(*) OVER w7 = 7 THEN sum(transaction_count) OVER w7 / 7.0::DOUBLE END AS ma_7,
  CASE WHEN count(*) OVER w14 = 14 THEN sum(transaction_count) OVER w14 / 14.0::DOUBLE END AS ma_14
FROM {DAILY} WINDOW w7 AS (ORDER BY transaction_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
  w14 AS (ORDER BY transaction_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)) m"""
q("moving_average", lambda d: A.moving_average(d.payments, d.as_of), f"SELECT * FROM {MOVING}")
q("trend_forecast", lambda d: A.trend_forecast(d.payments, d.as_of), f"""
SELECT CASE WHEN recent > previous THEN 'up' ELSE 'down' END AS current_trend,
  CAST(floor(recent) AS BIGINT) AS next_day_forecast, CAST(floor(recent) AS BIGINT) AS recent_average,
  'Medium' AS forecast_confidence, ma_7, ma_14
FROM (SELECT count(*) AS days, avg(transaction_count) FILTER (back <= 7) AS recent,
    avg(transaction_count) FILTER (back BETWEEN 8 AND 14) AS previous,
    max(ma_7) FILTER (back = 1) AS ma_7, max(ma_14) FILTER (back = 1) AS ma_14
  FROM (SELECT *, row_number() OVER (ORDER BY transaction_date DESC) AS back FROM {MOVING}) r) x WHERE days >= 7""")
q("volume_deviation", lambda d: A.volume_deviation(d.payments, d.as_of), f"""
SELECT transaction_date, transaction_count AS actual, {r2('expected', 4)} AS expected,
  {r2('abs(transaction_count - expected) / expected * 100', 4)} AS deviation_percent,
  abs(transaction_count - expected) / expected * 100 > 20 AS alert
FROM (SELECT *, CASE WHEN count(*) OVER w = 7 THEN sum(transaction_count) OVER w / 7.0::DOUBLE END AS expected
  FROM {DAILY} WINDOW w AS (ORDER BY transaction_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) e
WHERE expected IS NOT NULL""")
for _key in ("regional_analysis", "share_of_total"):
    q(_key, lambda d: A.regional_analysis(d.regional, d.as_of, days=90), f"""
SELECT *, {r2('transaction_count / sum(transaction_count) OVER () * 100')} AS transaction_percentage,
  {r2('total_amount / sum(total_amount) OVER () * 100')} AS volume_percentage,
  {r2('stddev_samp(avg_amount) OVER ()')} AS regional_variance,
  row_number() OVER (ORDER BY total_amount DESC, region) AS volume_rank
FROM (SELECT region, count(*) AS transaction_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
    CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount, count(DISTINCT phone_number) AS unique_customers
  FROM {since(90)} AND region IS NOT NULL GROUP BY 1) g""")

STATS = f"""(SELECT phone_number, {r2('CAST(sum(amount) AS DOUBLE) / count(*)')} AS mean_amount,
  {r2('stddev_samp(CAST(amount AS DOUBLE))')} AS std_amount, count(*) AS transaction_count FROM {{src}} GROUP BY 1) s"""
q("customer_stats_join", lambda d: A.customer_stats_join(d.payments).select(
    "transaction_id", "phone_number", "mean_amount", "std_amount", "transaction_count"), f"""
SELECT transaction_id, p.phone_number, mean_amount, std_amount, s.transaction_count
FROM payments p JOIN {STATS.format(src='payments')} ON p.phone_number = s.phone_number""")
Z = f"""(SELECT transaction_id, p.phone_number, CAST(amount AS DOUBLE) AS amount, mean_amount,
  abs(CAST(amount AS DOUBLE) - mean_amount) / (std_amount + 1) AS z
  FROM (SELECT * FROM {since(3650)}) p JOIN {STATS.format(src=since(3650))} ON p.phone_number = s.phone_number) z"""
Z_ROWS = f"""SELECT transaction_id, phone_number, amount, {r2('z', 4)} AS amount_zscore,
  CASE WHEN amount > mean_amount THEN 'Unusually High' ELSE 'Unusually Low' END AS anomaly_type FROM {Z} WHERE z > 2.5"""
q("zscore_anomaly", lambda d: A.zscore_anomaly(d.payments, d.as_of, days=3650), Z_ROWS)
q("zscore_first", lambda d: A.zscore_first(d.payments, d.as_of, days=3650),
  f"SELECT * FROM ({Z_ROWS}) t ORDER BY amount_zscore DESC, transaction_id LIMIT 100")
q("zscore_summary", lambda d: A.zscore_summary(d.payments, d.as_of, days=3650), f"""
SELECT count(*) FILTER (z > 2.5) AS total_anomalies, {r2('count(*) FILTER (z > 2.5) * 100.0::DOUBLE / count(*)')} AS anomaly_percentage,
  count(*) FILTER (z > 2.5 AND amount > mean_amount) AS high, count(*) FILTER (z > 2.5 AND amount < mean_amount) AS low
FROM {Z}""")

# -- the whole report, with segments that are given

REPORT = [
    ("segmentation", "segment_name", "segment_stats_given", ["customers", "mean_count", "mean_total", "median_total", "std_total", "mean_avg", "mean_score"]),
    ("behaviour", "'hour_' || hour_of_day", "peak_hours", ["transaction_count", "avg_transaction_per_hour"]),
    ("behaviour", "'day_' || day_of_week", "daily_pattern", ["transaction_count", "total_amount", "unique_customers"]),
    ("anomalies", "'all'", "zscore_summary", ["total_anomalies", "anomaly_percentage", "high", "low"]),
    ("forecast", "'all'", "trend_forecast", ["current_trend", "next_day_forecast", "recent_average", "forecast_confidence", "ma_7", "ma_14"]),
    ("regions", "region", "regional_analysis", [
        "transaction_count", "total_amount", "avg_amount", "unique_customers", "transaction_percentage", "volume_percentage", "volume_rank"]),
]
REPORT_SQL = "\nUNION ALL ".join(
    f"SELECT '{section}' AS section, {label} || '.{m}' AS metric, TRY_CAST({m} AS DOUBLE) AS number, "
    f"CASE WHEN TRY_CAST({m} AS DOUBLE) IS NULL THEN CAST({m} AS VARCHAR) END AS text FROM r_{key}"
    for section, label, key, metrics in REPORT for m in metrics)


def _report(d):
    segmented = A.customer_day_metrics(d.payments, d.as_of, days=3650).withColumn("segment_name", F.expr(BAND))
    number = F.col("value").try_cast("double")
    return A.analytics_report(d.payments, d.regional, lambda: d.as_of, segmented, {"behaviour": 90, "anomalies": 3650, "regions": 90}).select(
        "section", "metric", number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text"))


REPORT_PARTS = ",\n".join(f"r_{key} AS ({CATALOG[key].sql})" for _, _, key, _ in REPORT)
q("analytics_report_given", _report, f"""WITH {REPORT_PARTS}
{REPORT_SQL}
UNION ALL SELECT 'report', 'all.as_of', NULL, strftime((SELECT as_of FROM clock), '%Y-%m-%d %H:%M:%S')
UNION ALL SELECT 'regions', 'all.top_region', NULL, region FROM r_regional_analysis WHERE volume_rank = 1
UNION ALL SELECT 'regions', 'all.regional_variance', regional_variance, NULL FROM r_regional_analysis WHERE volume_rank = 1""")

# -- stream twins and alerts ---------------------------------------------------------------


def events(d):
    """Stream events as a batch frame, enriched, with zone-free times."""
    return d.stream_events.select(
        "TransID", P.standardize_phone("MSISDN").alias("phone"), "TransAmount", P.ntz("event_time").alias("event_time"),
        P.amount_category("TransAmount").alias("amount_category"),
    )


EV = """(SELECT "TransID", regexp_replace("MSISDN", '^0', '254') AS phone, "TransAmount", event_time,
  CASE WHEN "TransAmount" >= 100000 THEN 'high' WHEN "TransAmount" >= 10000 THEN 'medium' ELSE 'low' END AS amount_category
  FROM stream_events) e"""
q("velocity_batch", lambda d: R.velocity(events(d), "phone", "event_time", "TransID", 3600, 2).select(
    "TransID", "phone", "event_time", "recent_transaction_count", "velocity_flag"), f"""
SELECT "TransID", phone, event_time, n AS recent_transaction_count, n > 2 AS velocity_flag FROM (
  SELECT *, count(*) OVER (PARTITION BY phone ORDER BY epoch_us(event_time)
    RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS n FROM {EV}) v""")


def windows_sql(src):
    return f"""SELECT window_start, window_start + {{size}} AS window_end, amount_category AS key, count(*) AS transaction_count,
  {r2('sum("TransAmount")')} AS total_amount, {r2('avg("TransAmount")')} AS avg_amount,
  count(*) FILTER (amount_category = 'low') AS low_count, count(*) FILTER (amount_category = 'medium') AS medium_count,
  count(*) FILTER (amount_category = 'high') AS high_count FROM {src} GROUP BY 1, 3"""


HOURLY_SQL = windows_sql(f"(SELECT *, date_trunc('hour', event_time) AS window_start FROM {EV}) w").format(size="INTERVAL 1 HOUR")
SLIDING_SQL = windows_sql(f"""(SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) - to_minutes(5 * k) AS window_start
  FROM {EV}, range(3) r(k)) w""").format(size="INTERVAL 15 MINUTE")
q("hourly_windows", lambda d: R.windows_by_category(events(d), "event_time", "TransAmount", "1 hour"), HOURLY_SQL)
q("sliding_15min_windows",
  lambda d: R.windows_by_category(events(d), "event_time", "TransAmount", "15 minutes", "5 minutes"), SLIDING_SQL)
q("volume_drop_alert", lambda d: R.volume_drop(events(d), "event_time"), """
SELECT make_timestamp(CAST(minute * 60000000 AS BIGINT)) AS time, n10 / 600.0::DOUBLE AS rate_10m,
  coalesce(n60, 0) / 3600.0::DOUBLE AS rate_1h_before
FROM (SELECT minute, sum(n) OVER (ORDER BY minute RANGE BETWEEN 9 PRECEDING AND CURRENT ROW) AS n10,
    sum(n) OVER (ORDER BY minute RANGE BETWEEN 119 PRECEDING AND 60 PRECEDING) AS n60
  FROM (SELECT g.minute, coalesce(c.n, 0) AS n FROM
      (SELECT DISTINCT CAST(epoch(date_trunc('day', event_time)) AS BIGINT) // 60 + m AS minute
       FROM stream_events, range(1440) r(m)) g
    LEFT JOIN (SELECT CAST(epoch(date_trunc('minute', event_time)) AS BIGINT) // 60 AS minute, count(*) AS n
       FROM stream_events GROUP BY 1) c ON g.minute = c.minute) f) s
WHERE n10 / 600.0::DOUBLE < 0.5::DOUBLE * (coalesce(n60, 0) / 3600.0::DOUBLE)""")


def _flagged(d):
    return events(d).withColumn("flagged", P.anomaly_columns("TransAmount", max_single=300000)["anomaly_flag"])


q("fraud_rate_alert", lambda d: R.rate_alert(_flagged(d), "event_time", F.col("flagged"), 10, 0.05), f"""
SELECT * FROM (SELECT time_bucket(INTERVAL 10 MINUTE, event_time) AS window_start, count(*) AS total,
  count(*) FILTER ("TransAmount" > 300000 OR "TransAmount" < 1) AS hits,
  count(*) FILTER ("TransAmount" > 300000 OR "TransAmount" < 1) / count(*) AS rate FROM {EV} GROUP BY 1) x WHERE rate > 0.05""")
q("failed_rate_alert", lambda d: R.rate_alert(d.payments, "transaction_time", F.col("transaction_status") == "failed", 5, 0.1), """
SELECT * FROM (SELECT time_bucket(INTERVAL 5 MINUTE, transaction_time) AS window_start, count(*) AS total,
  count(*) FILTER (transaction_status = 'failed') AS hits, count(*) FILTER (transaction_status = 'failed') / count(*) AS rate
  FROM payments GROUP BY 1) x WHERE rate > 0.1""")
q("rate_breach", lambda d: R.rate_breach(events(d), "phone", "event_time", 1, 3600), f"""
SELECT phone AS key, date_trunc('hour', event_time) AS window_start, count(*) AS requests
FROM {EV} GROUP BY 1, 2 HAVING count(*) > 1""")

# -- fraud features ------------------------------------------------------------------------

CUSTOMER = """(SELECT phone_number, CAST(sum(amount) AS DOUBLE) / count(*) AS customer_avg_amount,
  stddev_samp(CAST(amount AS DOUBLE)) AS customer_std_amount, CAST(min(amount) AS DOUBLE) AS customer_min_amount,
  CAST(max(amount) AS DOUBLE) AS customer_max_amount, count(*) AS customer_transaction_count,
  count(DISTINCT transaction_time) AS unique_times FROM payments GROUP BY 1) c"""
MERCHANT = """(SELECT business_shortcode, CAST(sum(amount) AS DOUBLE) / count(*) AS merchant_avg_amount,
  count(*) AS merchant_transaction_count, count(DISTINCT phone_number) AS merchant_unique_customers
  FROM payments GROUP BY 1) m"""
_STD = "customer_std_amount"
q("customer_profile", lambda d: features.customer_profile(d.payments).withColumn(_STD, P.money_round(_STD, 4)),
  f"SELECT * REPLACE ({r2(_STD, 4)} AS {_STD}) FROM {CUSTOMER}")
q("merchant_profile", lambda d: features.merchant_profile(d.payments), f"SELECT * FROM {MERCHANT}")
q("customer_features_join", lambda d: features.customer_features_join(
    d.payments.select("transaction_id", "phone_number", "amount", "transaction_time"),
    features.customer_profile(d.payments)).drop("amount", "transaction_time").withColumn(_STD, P.money_round(_STD, 4)), f"""
SELECT transaction_id, c.* REPLACE ({r2(_STD, 4)} AS {_STD}) FROM payments p JOIN {CUSTOMER} ON p.phone_number = c.phone_number""")
q("merchant_features_join", lambda d: features.merchant_features_join(
    d.payments.select("transaction_id", "business_shortcode"), features.merchant_profile(d.payments)), f"""
SELECT transaction_id, m.* FROM payments p JOIN {MERCHANT} ON p.business_shortcode = m.business_shortcode""")
q("region_risk", lambda d: d.regional.select("transaction_id", "region", P.region_risk("region").alias("region_risk_factor")),
  "SELECT transaction_id, region, CASE region " + " ".join(f"WHEN '{r}' THEN {v}::DOUBLE" for r, v in P.REGION_RISK.items())
  + " ELSE 0.3::DOUBLE END AS region_risk_factor FROM payments")


def _features(d):
    rows = store.stored_features(
        d.regional.select("transaction_id", "phone_number", "amount", "transaction_time", "business_shortcode", "region"))
    smooth = ("amount_log", "amount_deviation")
    return rows.select("transaction_id", *[
        P.money_round(c, 4).alias(c) if c in smooth else F.col(c) for c in features.FEATURES
    ])


q("fraud_features", _features, f"""
SELECT transaction_id, {r2('ln(1 + CAST(amount AS DOUBLE))', 4)} AS amount_log,
  CASE WHEN amount % 1 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_round_amount,
  CASE WHEN CAST(amount AS DOUBLE) > (SELECT quantile_cont(CAST(amount AS DOUBLE), 0.95) FROM payments) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_very_high_amount,
  CASE WHEN CAST(amount AS DOUBLE) < (SELECT quantile_cont(CAST(amount AS DOUBLE), 0.05) FROM payments) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_very_low_amount,
  CAST(hour(transaction_time) AS DOUBLE) AS hour_of_day, CAST(isodow(transaction_time) - 1 AS DOUBLE) AS day_of_week,
  CASE WHEN hour(transaction_time) >= 22 OR hour(transaction_time) < 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_night_transaction,
  CASE WHEN isodow(transaction_time) >= 6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend,
  CAST(length(p.phone_number) AS DOUBLE) AS phone_length, customer_avg_amount,
  CAST(customer_transaction_count AS DOUBLE) AS customer_transaction_count,
  {r2('coalesce(abs(CAST(amount AS DOUBLE) - customer_avg_amount) / (customer_std_amount + 1), 0)', 4)} AS amount_deviation,
  merchant_avg_amount, CAST(merchant_transaction_count AS DOUBLE) AS merchant_transaction_count,
  CASE region {' '.join(f"WHEN '{r}' THEN {v}::DOUBLE" for r, v in P.REGION_RISK.items())} ELSE 0.3::DOUBLE END AS region_risk_factor
FROM payments p JOIN {CUSTOMER} ON p.phone_number = c.phone_number
JOIN {MERCHANT} ON p.business_shortcode = m.business_shortcode""")


def _votes(d):
    key = F.col("payment_key")

    def vote(n, absent):
        return F.when(key % absent == 0, F.lit(None)).otherwise((key % n == 0).cast("bigint"))

    return d.payments.select(
        "transaction_id", vote(3, 1000).alias("isolation_forest_pred"),
        vote(5, 4).alias("random_forest_pred"), vote(2, 10).alias("gradient_boosting_pred"),
    )


def _vote_sql(n, absent):
    return f"CASE WHEN payment_key % {absent} = 0 THEN NULL WHEN payment_key % {n} = 0 THEN 1::BIGINT ELSE 0::BIGINT END"


q("ensemble_vote", lambda d: ensemble.ensemble_vote(_votes(d)), f"""
SELECT transaction_id, i AS isolation_forest_pred, r AS random_forest_pred, g AS gradient_boosting_pred,
  CAST(v AS BIGINT) AS consensus_votes, CAST(t AS BIGINT) AS total_votes, CASE WHEN t > 0 THEN v / t END AS fraud_probability,
  CASE WHEN t = 0 THEN NULL WHEN v > t / 2 THEN 'high' ELSE 'low' END AS fraud_risk,
  CASE WHEN t = 0 THEN 'UNKNOWN' WHEN v > t / 2 THEN 'HIGH' WHEN v > 0 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  CASE i WHEN 1 THEN 'fraud' WHEN 0 THEN 'normal' END AS isolation_forest,
  CASE r WHEN 1 THEN 'fraud' WHEN 0 THEN 'normal' END AS random_forest,
  CASE g WHEN 1 THEN 'fraud' WHEN 0 THEN 'normal' END AS gradient_boosting
FROM (SELECT *, coalesce(i, 0) + coalesce(r, 0) + coalesce(g, 0) AS v,
    (i IS NOT NULL)::INT + (r IS NOT NULL)::INT + (g IS NOT NULL)::INT AS t
  FROM (SELECT transaction_id, {_vote_sql(3, 1000)} AS i, {_vote_sql(5, 4)} AS r, {_vote_sql(2, 10)} AS g FROM payments) a) b""")
