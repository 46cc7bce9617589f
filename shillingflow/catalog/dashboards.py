"""The 36 dashboard panels and the account list behind their filter."""

from pyspark.sql import functions as F

from ..operators import dashboards as D
from ..operators import lookups
from ..session import shared_dir, write_out
from ..sources import warehouse
from ..sources.history import History
from .base import query

NOW = "(SELECT as_of FROM clock)"
RAW_NOW = "(SELECT as_of FROM raw_clock)"
ACCOUNTS = ["1-URGENT", "Unassigned"]
IN_ACCOUNTS = "coalesce(account_reference, 'Unassigned') IN ('1-URGENT', 'Unassigned')"


def last(n, unit, table="tx"):
    return f"{table} WHERE transaction_timestamp BETWEEN {NOW} - INTERVAL {n} {unit} AND {NOW}"


TODAY = f"tx WHERE transaction_date = CAST({NOW} AS DATE)"


RAW_CLOCK = "(SELECT max(received_at) + INTERVAL 12 HOUR FROM raw_feed)"

CATALOG_SQL = {}


def panel(key, build, sql):
    CATALOG_SQL[key] = sql
    query(key, sql)(build)


panel("exec_value_today", lambda d: D.value_today(d.tx, d.as_of),
      f"SELECT coalesce(CAST(sum(transaction_amount) AS DOUBLE), 0) AS value FROM {TODAY}")
panel("exec_txns_today", lambda d: D.txns_today(d.tx, d.as_of), f"SELECT count(*) AS value FROM {TODAY}")
panel("exec_customers_today", lambda d: D.customers_today(d.tx, d.as_of),
      f"SELECT count(DISTINCT customer_phone_number) AS value FROM {TODAY}")
panel("exec_avg_ticket", lambda d: D.avg_ticket_today(d.tx, d.as_of),
      f"SELECT coalesce(CAST(sum(transaction_amount) AS DOUBLE) / count(*), 0) AS value FROM {TODAY}")
panel("exec_value_by_hour", lambda d: D.value_by_hour(None, d.tx, d.as_of),
      f"""SELECT hour_bucket AS time, total_amount AS value_kes, transaction_count AS transactions FROM hourly
      WHERE hour_bucket BETWEEN {NOW} - INTERVAL 7 DAY AND {NOW}""")
panel("hourly_mart_join_detail", lambda d: D.value_by_hour(None, d.tx, d.as_of, ACCOUNTS, days=90),
      f"""SELECT hour_bucket AS time, total_amount AS value_kes, transaction_count AS transactions FROM hourly
      WHERE hour_bucket BETWEEN {NOW} - INTERVAL 90 DAY AND {NOW} AND hour_bucket IN
        (SELECT date_trunc('hour', transaction_timestamp) FROM tx WHERE {IN_ACCOUNTS})""")
panel("exec_value_by_hour_as_written", lambda d: D.value_by_hour_as_written(d.tx, d.as_of, days=90),
      f"""SELECT hour_bucket AS time, round(CAST(sum(total_amount) AS DECIMAL(24,6)), 2)::DOUBLE AS value_kes,
        CAST(sum(transaction_count) AS BIGINT) AS transactions
      FROM hourly h LEFT JOIN tx s ON date_trunc('hour', s.transaction_timestamp) = h.hour_bucket
      WHERE hour_bucket BETWEEN {NOW} - INTERVAL 90 DAY AND {NOW} GROUP BY 1""")
panel("exec_value_mix", lambda d: D.value_mix(d.tx, d.as_of),
      f"""SELECT amount_category AS band, CAST(sum(transaction_amount) AS DOUBLE) AS value
      FROM {last(7, 'DAY')} GROUP BY 1""")
panel("exec_top_accounts", lambda d: D.top_accounts(d.heatmap, d.as_of),
      f"""SELECT coalesce(account_reference, 'Unassigned') AS account_reference,
        CAST(sum(transaction_count) AS BIGINT) AS transactions,
        round(CAST(sum(total_amount) AS DECIMAL(24,6)), 2)::DOUBLE AS value_kes,
        round(CAST(avg(total_amount / transaction_count) AS DECIMAL(24,6)), 2)::DOUBLE AS avg_ticket
      FROM heatmap WHERE transaction_date >= CAST({NOW} AS DATE) - INTERVAL 7 DAY
      GROUP BY 1 ORDER BY value_kes DESC, 1 LIMIT 15""")
panel("exec_daily_trend", lambda d: D.daily_trend(d.daily, d.as_of),
      f"""SELECT CAST(transaction_date AS VARCHAR) AS day,
        round(CAST(sum(total_transaction_value) AS DECIMAL(24,6)), 2)::DOUBLE AS value_kes
      FROM daily WHERE transaction_date >= CAST({NOW} AS DATE) - INTERVAL 14 DAY GROUP BY 1""")

panel("ops_throughput_5m", lambda d: D.throughput(d.tx, d.as_of),
      f"SELECT count(*) AS value FROM {last(5, 'MINUTE')}")
panel("ops_freshness", lambda d: D.freshness_minutes(d.stg_raw, d.fixed_clock),
      f"""SELECT coalesce(CAST(epoch({RAW_CLOCK}) - epoch(max(received_at)) AS DOUBLE) / 60, 0)
      AS value FROM stg_raw""")
panel("ops_duplicate_ids", lambda d: D.duplicate_ids(d.stg_raw),
      """SELECT count(*) AS value FROM (SELECT transaction_id FROM stg_raw WHERE transaction_id IS NOT NULL
      GROUP BY 1 HAVING count(*) > 1) x""")
panel("ops_raw_loaded", lambda d: D.raw_loaded(d.stg_raw, d.raw_as_of),
      f"SELECT count(*) AS value FROM stg_raw WHERE received_at BETWEEN {RAW_NOW} - INTERVAL 24 HOUR AND {RAW_NOW}")
panel("ops_ingest_rate", lambda d: D.ingest_rate(d.stg_raw, d.raw_as_of, hours=240),
      f"""SELECT date_trunc('minute', received_at) AS time, count(*) AS raw_events FROM stg_raw
      WHERE received_at BETWEEN {RAW_NOW} - INTERVAL 240 HOUR AND {RAW_NOW} GROUP BY 1""")
panel("ops_value_minute", lambda d: D.value_per_minute(d.tx, d.as_of, hours=240),
      f"""SELECT date_trunc('minute', transaction_timestamp) AS time,
        CAST(sum(transaction_amount) AS DOUBLE) AS value_kes FROM {last(240, 'HOUR')} GROUP BY 1""")
panel("ops_recent", lambda d: D.recent_confirmations(d.tx, d.as_of, hours=240),
      f"""SELECT transaction_timestamp, transaction_id, customer_phone_number, account_reference,
        CAST(transaction_amount AS DOUBLE) AS transaction_amount, amount_category, loaded_at
      FROM {last(240, 'HOUR')} ORDER BY transaction_timestamp DESC, transaction_id LIMIT 50""")

panel("risk_critical", lambda d: D.critical_events(d.tx, d.as_of),
      f"SELECT count(*) AS value FROM {last(24, 'HOUR')} AND transaction_amount >= 100000")
panel("risk_night", lambda d: D.night_events(d.tx, d.as_of, hours=720),
      f"SELECT count(*) AS value FROM {last(720, 'HOUR')} AND (transaction_hour < 6 OR transaction_hour >= 22)")
panel("risk_velocity_customers", lambda d: D.velocity_customers(d.tx, d.as_of, hours=2160, at_least=2),
      f"""SELECT count(*) AS value FROM (SELECT customer_phone_number FROM {last(2160, 'HOUR')}
      GROUP BY 1 HAVING count(*) >= 2) v""")
panel("risk_exposure", lambda d: D.risk_exposure(d.tx, d.as_of),
      f"""SELECT coalesce(CAST(sum(transaction_amount) AS DOUBLE), 0) AS value
      FROM {last(24, 'HOUR', 'risky')} AND risk_bucket <> 'normal'""")
panel("risk_mix", lambda d: D.risk_mix(d.tx, d.as_of, hours=2160),
      f"SELECT risk_bucket, count(*) AS events FROM {last(2160, 'HOUR', 'risky')} GROUP BY 1")
panel("risk_over_time", lambda d: D.risk_over_time(d.tx, d.as_of, hours=2160),
      f"""SELECT date_trunc('hour', transaction_timestamp) AS time,
        count(*) FILTER (risk_bucket = 'critical') AS critical, count(*) FILTER (risk_bucket = 'elevated') AS elevated,
        count(*) FILTER (risk_bucket = 'velocity') AS velocity
      FROM {last(2160, 'HOUR', 'risky')} GROUP BY 1""")
panel("risk_review_list", lambda d: D.risk_review_list(d.tx, d.as_of),
      f"""SELECT customer_phone_number, count(*) AS events, CAST(sum(transaction_amount) AS DOUBLE) AS value_kes,
        CAST(max(transaction_amount) AS DOUBLE) AS largest_transaction, max(transaction_timestamp) AS latest_seen,
        string_agg(DISTINCT risk_bucket, ', ' ORDER BY risk_bucket) AS risk_reasons
      FROM {last(7, 'DAY', 'risky')} AND risk_bucket <> 'normal'
      GROUP BY 1 ORDER BY value_kes DESC, 1 LIMIT 50""")


def _history(d):
    """The customers' stored counts after three increments, each of payments of all times; the last one reaches
    behind the snapshot that is taken before it."""
    path = shared_dir(d.spark, "history")
    kept = History(d.spark, path).start()
    third = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    for n in range(3):
        kept.add(d.tx.filter(third == n), n)
        if n == 1:
            kept.snapshot(f"{d.spark.range(1).select(F.trunc(F.to_date(d.as_of), 'month')).first()[0]:%Y-%m}", n)
    return kept


panel("risk_review_list_stored", lambda d: D.risk_review_list(d.tx, d.as_of, history=_history(d)), CATALOG_SQL["risk_review_list"])
panel("risk_mix_stored", lambda d: D.risk_mix(d.tx, d.as_of, hours=2160, history=_history(d)), CATALOG_SQL["risk_mix"])
panel("risk_bucket", lambda d: D.with_risk(d.tx_sequenced).groupBy("risk_bucket").count().withColumnRenamed("count", "events"),
      "SELECT risk_bucket, count(*) AS events FROM risky GROUP BY 1")

TOTALS = f"""(SELECT customer_phone_number, count(*) AS txns, sum(transaction_amount) AS value_kes
  FROM {last(30, 'DAY')} GROUP BY 1) c"""
panel("cust_count", lambda d: D.customers_in_range(d.tx, d.as_of),
      f"SELECT count(DISTINCT customer_phone_number) AS value FROM {last(30, 'DAY')}")
panel("cust_repeat_rate", lambda d: D.repeat_rate(d.tx, d.as_of),
      f"""SELECT coalesce(100.0::DOUBLE * count(*) FILTER (txns > 1) / nullif(count(*), 0), 0) AS value
      FROM {TOTALS}""")
panel("cust_median_value", lambda d: D.median_value(d.tx, d.as_of),
      f"""SELECT coalesce(round(CAST(quantile_cont(CAST(value_kes AS DOUBLE), 0.5) AS DECIMAL(24,6)), 4)::DOUBLE, 0)
      AS value FROM {TOTALS}""")
panel("cust_top_share", lambda d: D.top_customer_share(d.tx, d.as_of),
      f"""SELECT coalesce(round(CAST(CAST(max(value_kes) AS DOUBLE) * 100 / CAST(sum(value_kes) AS DOUBLE)
        AS DECIMAL(24,6)), 4)::DOUBLE, 0) AS value FROM {TOTALS}""")
panel("cust_timing", lambda d: D.timing_pattern(d.tx, d.as_of),
      f"""SELECT CASE WHEN transaction_hour >= 6 AND transaction_hour < 12 THEN 'Morning'
        WHEN transaction_hour >= 12 AND transaction_hour < 18 THEN 'Afternoon' ELSE 'Evening/Night' END AS period,
        count(*) AS transactions FROM {last(30, 'DAY')} GROUP BY 1""")
panel("cust_value_bands", lambda d: D.value_bands(d.tx, d.as_of),
      f"""SELECT CASE WHEN value_kes >= 100000 THEN 'Enterprise' WHEN value_kes >= 25000 THEN 'High Value'
        WHEN value_kes >= 5000 THEN 'Core' ELSE 'Long Tail' END AS value_band, count(*) AS customers
      FROM {TOTALS} GROUP BY 1""")
panel("cust_top", lambda d: D.top_customers(d.tx, d.as_of),
      f"""SELECT customer_phone_number, count(*) AS transactions, CAST(sum(transaction_amount) AS DOUBLE) AS value_kes,
        round(CAST(CAST(sum(transaction_amount) AS DOUBLE) / count(*) AS DECIMAL(24,6)), 2)::DOUBLE AS avg_ticket,
        max(transaction_timestamp) AS latest_transaction
      FROM {last(30, 'DAY')} GROUP BY 1 ORDER BY value_kes DESC, 1 LIMIT 50""")

panel("dq_missing_id", lambda d: D.missing_text(d.stg_raw, "transaction_id"),
      "SELECT count(*) AS value FROM stg_raw WHERE transaction_id IS NULL OR transaction_id = ''")
panel("dq_missing_phone", lambda d: D.missing_text(d.stg_raw, "phone_number"),
      "SELECT count(*) AS value FROM stg_raw WHERE phone_number IS NULL OR phone_number = ''")
panel("dq_invalid_amount", lambda d: D.invalid_amount(d.stg_raw),
      """SELECT count(*) AS value FROM stg_raw WHERE TRY_CAST(amount AS DECIMAL(12,2)) IS NULL
      OR TRY_CAST(amount AS DECIMAL(12,2)) < 0""")


def _freshness(d):
    """The build time that the mart was stored with."""
    built = warehouse.build_models(d.raw_feed, d.raw_as_of)["mart_hourly_volumes"]
    return D.model_freshness(write_out(built, "hourly-mart"), d.fixed_clock)


panel("dq_model_freshness", _freshness,
      f"""SELECT coalesce(CAST(epoch({RAW_CLOCK}) - epoch(max(created_at)) AS DOUBLE) / 60, 0) AS value
      FROM (SELECT (SELECT max(received_at) FROM raw_feed) AS created_at FROM hourly) h""")
for _key, _days in (("dq_raw_vs_staged", 90), ("raw_vs_staged_hourly", 3000)):
    panel(_key, lambda d, days=_days: D.raw_vs_staged(d.stg_raw, d.staged, d.raw_as_of, days=days),
          f"""SELECT coalesce(r.time, s.time) AS time, coalesce(raw_events, 0) AS raw_events,
        coalesce(staged_events, 0) AS staged_events
      FROM (SELECT date_trunc('hour', received_at) AS time, count(*) AS raw_events FROM stg_raw
            WHERE received_at BETWEEN {RAW_NOW} - INTERVAL {_days} DAY AND {RAW_NOW} GROUP BY 1) r
      FULL JOIN (SELECT date_trunc('hour', transaction_timestamp) AS time, count(*) AS staged_events FROM staged
            WHERE transaction_timestamp BETWEEN {RAW_NOW} - INTERVAL {_days} DAY AND {RAW_NOW} GROUP BY 1) s
      ON r.time = s.time""")
panel("dq_completeness", lambda d: D.completeness(d.staged, d.raw_as_of, days=60),
      f"""SELECT transaction_date, count(*) AS staged_transactions,
        count(*) FILTER (customer_phone_number IS NULL) AS missing_phone,
        count(*) FILTER (transaction_amount IS NULL) AS missing_amount,
        count(*) FILTER (account_reference IS NULL) AS missing_reference
      FROM staged WHERE transaction_date >= CAST({RAW_NOW} AS DATE) - INTERVAL 60 DAY GROUP BY 1""")
panel("dq_duplicates", lambda d: D.duplicates(d.stg_raw),
      """SELECT transaction_id, count(*) AS duplicate_count, min(received_at) AS first_seen,
        max(received_at) AS last_seen
      FROM stg_raw WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1
      ORDER BY duplicate_count DESC, last_seen DESC, transaction_id LIMIT 50""")

panel("account_refs", lambda d: lookups.account_refs(d.tx),
      "SELECT DISTINCT coalesce(account_reference, 'Unassigned') AS account_reference FROM tx")
panel("account_filter", lambda d: D.value_mix(d.tx, d.as_of, ACCOUNTS, days=3000),
      f"""SELECT amount_category AS band, CAST(sum(transaction_amount) AS DOUBLE) AS value
      FROM {last(3000, 'DAY')} AND {IN_ACCOUNTS} GROUP BY 1""")
panel("time_filter", lambda d: D.recent(d.tx, d.as_of, 30, "DAYS").select("transaction_id", "transaction_timestamp"),
      f"SELECT transaction_id, transaction_timestamp FROM {last(30, 'DAY')}")
