"""Streaming operators run over the given files, compared with their batch twins."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import payments as P
from ..operators import stk
from ..session import shared_dir
from ..sources import dataset as data
from ..streaming import events as E
from ..streaming import lag as G
from ..streaming import landing as N
from ..streaming.runner import latest, materialize, run_available, use_rocksdb, write_batch
from ..streaming.velocity import velocity, velocity_batches
from .analytics import EV, HOURLY_SQL, r2
from .base import query
from .ingest import LAST_CALL


def q(key, build, sql=None):
    query(key, sql)(build)


ORDER = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
BATCHES = 3


_PREPARED: dict[tuple[str, str, str], tuple[str, int]] = {}  # by application, folder and table


def prepared(d, table) -> tuple[str, int]:
    """A table's rows in as many parts as a stream has micro-batches, oldest rows first; rows without a time
    come first. Returns the folder and the files of a part.

    The parts are written one after the other, since files are read in the order of their times. Every
    part has as many files as a batch reads, more of them for larger tables: what a small part lacks
    is filled up with empty files."""
    rows, path, by = d.table(table), shared_dir(d.spark, f"stream-{table}"), F.unix_seconds(F.col(ORDER[table]).cast("timestamp"))
    cuts = [None, *rows.select(by.alias("t")).stat.approxQuantile("t", [i / BATCHES for i in range(1, BATCHES)], 0.01), None]
    files = max(1, -(-rows.rdd.getNumPartitions() // BATCHES))
    for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
        part = rows if low is None else rows.filter(by >= low)
        part = part if high is None else part.filter((by < high) | by.isNull() if low is None else by < high)
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.parquet(f"{path}/{n}")
        written = len(d.spark.read.schema(rows.schema).parquet(f"{path}/{n}").inputFiles())
        for k in range(written, files):
            rows.limit(0).coalesce(1).write.parquet(f"{path}/{n}/empty-{k}")
    return path, files


def _prepared_key(d, table) -> tuple[str, str, str]:
    return d.spark.sparkContext.applicationId, getattr(d, "folder", None), table


def prepared_path(d, table) -> str:
    """The folder that ``source`` streams for a table of a folder."""
    return _PREPARED[_prepared_key(d, table)][0]


def source(d, table):
    """A table as a file stream of several micro-batches. The parts of a folder's table are prepared by the
    application's first stream over it; the tables are not written to meanwhile."""
    key = _prepared_key(d, table)
    if key[1] is None or key not in _PREPARED:
        _PREPARED[key] = prepared(d, table)
    path, files = _PREPARED[key]
    return (
        d.spark.readStream.schema(data.LAYOUTS[table]).option("maxFilesPerTrigger", files)
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)
    )


def payment_events(d):
    return data.stream_events(source(d, "events"))


def enriched(d):
    return E.enrich(payment_events(d))


def naive(df, *columns):
    return df.withColumns({c: P.ntz(c) for c in columns})


q("stream_enrich", lambda d: naive(materialize(enriched(d), "enrich"), "event_time").select(
    "TransID", "amount_category", "phone_standardized", "event_time"),
  f'SELECT "TransID", amount_category, phone AS phone_standardized, event_time FROM {EV}')

q("stream_rules", lambda d: materialize(E.rules(enriched(d)), "rules").select(
    "TransID", "anomaly_flag", "anomaly_type", "risk_score"), """
SELECT "TransID", a > 500000 OR a < 1 AS anomaly_flag,
  CASE WHEN a > 500000 THEN 'unusually_large' WHEN a < 1 THEN 'invalid_amount' END AS anomaly_type,
  CASE WHEN a > 500000 THEN 85.0::DOUBLE WHEN a < 1 THEN 100.0::DOUBLE ELSE 10.0::DOUBLE + a / 500000.0::DOUBLE * 30.0::DOUBLE END AS risk_score
FROM (SELECT "TransID", "TransAmount" AS a FROM stream_events) t""")


def _with_copies(d):
    """Every fifth event arrives three times, every seventh without an id."""
    number = F.substring("TransID", 4, 20).cast("bigint")
    copies = F.when(number % 5 == 0, F.lit(3)).otherwise(1)
    return (
        payment_events(d).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
        .withColumn("TransID", F.when(number % 7 != 0, F.col("TransID")))
    )


q("stream_dedupe", lambda d: naive(materialize(E.dedupe(_with_copies(d)), "dedupe"), "event_time").select("TransID", "event_time"), """
SELECT "TransID", event_time FROM stream_events WHERE CAST(substr("TransID", 4) AS BIGINT) % 7 <> 0
UNION ALL SELECT NULL, event_time FROM stream_events e,
  range(3) r(i) WHERE CAST(substr("TransID", 4) AS BIGINT) % 7 = 0
    AND (i = 0 OR CAST(substr("TransID", 4) AS BIGINT) % 5 = 0)""")


def _checked(d):
    return E.rules(enriched(d).drop("processed_at"))


def _velocity(d):
    path = shared_dir(d.spark, "velocity")
    velocity_batches(_checked(d), path, "phone_standardized", "event_time", "TransID", 3600, 2)
    return d.spark.read.parquet(f"{path}/out")


def _velocity_keyed(d):
    return materialize(velocity(_checked(d), "phone_standardized", "event_time", 3600, 2, slot_spans=240), "velocity")


VELOCITY = f"""(SELECT "TransID", phone AS phone_standardized, event_time, "TransAmount" AS a,
  count(*) OVER (PARTITION BY phone ORDER BY epoch_us(event_time)
    RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS n FROM {EV}) v"""
VELOCITY_SQL = f"""SELECT "TransID", phone_standardized, event_time, n AS recent_transaction_count,
  n > 2 AS velocity_flag FROM {VELOCITY}"""
for _key, _build in (("stream_velocity", _velocity), ("stream_velocity_keyed", _velocity_keyed)):
    q(_key, lambda d, build=_build: naive(build(d), "event_time").select(
        "TransID", "phone_standardized", "event_time", "recent_transaction_count", "velocity_flag"), VELOCITY_SQL)
q("stream_alerts", lambda d: E.alerts(_velocity(d)).select("TransID", "anomaly_flag", "velocity_flag"), f"""
SELECT "TransID", a > 500000 OR a < 1 AS anomaly_flag, n > 2 AS velocity_flag FROM {VELOCITY}
WHERE a > 500000 OR a < 1 OR n > 2""")

WINDOW_KEYS = ["window_start", "window_end", "key"]


def _windows(stream, purpose, **columns):
    final = latest(materialize(stream, purpose, "update"), WINDOW_KEYS)
    return naive(final, "window_start", "window_end").withColumns(
        {c: P.money_round(c) for c in ("total_amount", "avg_amount") if c in final.columns}
    )


q("stream_hourly", lambda d: _windows(E.hourly(enriched(d)), "hourly"), HOURLY_SQL)
SLIDING_STREAM_SQL = f"""SELECT window_start, window_start + INTERVAL 15 MINUTE AS window_end, amount_category AS key,
  count(*) AS transaction_count, {r2('sum("TransAmount")')} AS total_amount
FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) - to_minutes(5 * i) AS window_start FROM {EV}, range(3) r(i)) w
GROUP BY 1, 3"""
q("stream_15min", lambda d: _windows(E.sliding(enriched(d)), "sliding"), SLIDING_STREAM_SQL)


def _agg_sink(d):
    """Both aggregates in one sink, told apart by their type."""
    path = shared_dir(d.spark, "aggregates")
    for kind, build in (("hourly", E.hourly), ("15min", E.sliding)):
        messages = E.aggregate_messages(build(enriched(d)), kind)
        run_available(messages, lambda df, n, k=kind: write_batch(df, f"{path}/out/kind={k}", n), f"{path}/{kind}", "update")
    rows = E.newest_messages(d.spark.read.parquet(f"{path}/out"))
    kind = F.get_json_object("value", "$.aggregation_type")
    return rows.groupBy("key", kind.alias("aggregation_type")).agg(
        F.count("*").alias("messages"),
        F.sum(F.get_json_object("value", "$.transaction_count").cast("bigint")).alias("transactions"),
    )


q("stream_agg_sink", _agg_sink, f"""
SELECT key, 'hourly' AS aggregation_type, count(*) AS messages, CAST(sum(transaction_count) AS BIGINT) AS transactions
FROM ({HOURLY_SQL}) h GROUP BY 1
UNION ALL SELECT key, '15min', count(*), CAST(sum(transaction_count) AS BIGINT) FROM ({SLIDING_STREAM_SQL}) s GROUP BY 1""")

q("stream_minute_rate", lambda d: naive(
    latest(materialize(E.minute_rate(payment_events(d), "event_time"), "minutes", "update"), ["time"]), "time"), """
SELECT date_trunc('minute', event_time) AS time, count(*) AS raw_events FROM stream_events GROUP BY 1""")
q("stream_live_customers", lambda d: naive(
    latest(materialize(E.live_customers(payment_events(d), "event_time", "MSISDN"), "customers", "update"), ["time"]), "time"))


def _feed_stream(d):
    feed = data.raw_feed(source(d, "orders"))
    return feed.select("event_type", "transaction_id", "received_at", "phone_number", "amount", "transaction_time", "payload")


def _landed(d):
    path = shared_dir(d.spark, "landing")
    N.run_landing(_feed_stream(d), path, period="year")  # the feed spans years
    return path


q("stream_land", lambda d: d.spark.read.parquet(f"{_landed(d)}/raw").drop("batch"), """
SELECT event_type, transaction_id, received_at, phone_number, amount,
  try_strptime(transaction_time, '%Y%m%d%H%M%S') AS transaction_time, payload
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY received_at, payload) AS rn FROM raw_feed
      WHERE transaction_time <> 'not-a-time') f WHERE rn = 1 OR transaction_id IS NULL""")
q("stream_land_dead_letters", lambda d: d.spark.read.parquet(f"{_landed(d)}/dead_letters").groupBy(
    "failure_reason", "error_message").agg(F.count("*").alias("letters")), """
SELECT 'invalid_format' AS failure_reason, 'rule failed: unreadable_time' AS error_message, count(*) AS letters
FROM raw_feed WHERE transaction_time = 'not-a-time'""")


def _stk_stream(d):
    p = data.payments(source(d, "orders"))
    requests = data.stk_requests(p).withColumn("initiated_at", F.col("initiated_at").cast("timestamp"))
    calls = stk.stk_flatten(data.stk_messages(p), keep=("received_at",))
    return N.stk_events(requests, calls.withColumn("received_at", F.col("received_at").cast("timestamp")))


def _stk_state(d):
    path = shared_dir(d.spark, "stk")
    use_rocksdb(d.spark)
    N.run_stk(_stk_stream(d), path)
    state = N.settled_at(d.spark, path)
    return naive(N.expire(state, d.as_of.cast("timestamp")), "initiated_at", "completed_at")


q("stream_stk_match", _stk_state, f"""
SELECT r.checkout_request_id, r.phone_number, r.amount, account_reference, initiated_at,
  CASE WHEN called_at IS NULL THEN
    CASE WHEN initiated_at < (SELECT as_of FROM clock) - INTERVAL 2 MINUTE THEN 'expired' ELSE 'initiated' END
    WHEN code = 0 THEN 'completed' WHEN code = 1 THEN 'cancelled' WHEN code = 10 THEN 'expired' ELSE 'failed' END AS status,
  code AS result_code, descr AS result_desc, called_at AS completed_at
FROM stk_requests r LEFT JOIN {LAST_CALL} ON r.checkout_request_id = l.checkout_request_id""")


def _retry(d):
    key = F.col("payment_key")
    letters = data.payments(source(d, "orders")).select(
        F.col("transaction_id").alias("message_id"), (key % 5).alias("retry_count"),
        F.lit(3).cast("bigint").alias("max_retries"), (key % 3 != 0).alias("is_recoverable"),
    )
    path = shared_dir(d.spark, "retry")
    N.retry(letters, path)
    parts = [d.spark.read.parquet(f"{path}/{x}").withColumn("action", F.lit(x)) for x in ("retry", "incidents")]
    return parts[0].unionByName(parts[1]).drop("batch")


q("stream_retry", _retry, """
SELECT transaction_id AS message_id, 3::BIGINT AS max_retries, payment_key % 3 <> 0 AS is_recoverable,
  CASE WHEN payment_key % 3 <> 0 AND payment_key % 5 < 3 THEN payment_key % 5 + 1 ELSE payment_key % 5 END AS retry_count,
  CASE WHEN payment_key % 3 <> 0 AND payment_key % 5 < 3 THEN 'retry' ELSE 'incidents' END AS action FROM payments""")


def _lag(d):
    path = shared_dir(d.spark, "lag")
    with G.ProgressLog(d.spark) as log:
        run = run_available(enriched(d), lambda df, n: write_batch(df, f"{path}/out", n), f"{path}/checkpoint")
    return G.lag_report(d.spark, log.of(run.id)).groupBy("lag_alert").agg(
        F.count("*").alias("batches"), F.sum("input_rows").alias("input_rows"))


q("stream_lag", _lag, f"SELECT false AS lag_alert, {BATCHES}::BIGINT AS batches, count(*) AS input_rows FROM stream_events")


def _file_lag(d):
    """Backlog of a file stream over all rows of a table after each batch, from its checkpoint."""
    checkpoint = shared_dir(d.spark, "file-lag")
    run_available(source(d, "lineitem").select("l_orderkey"), lambda df, n: write_batch(df, f"{checkpoint}-out", n), checkpoint)
    lags = G.file_lag(d.spark, prepared_path(d, "lineitem"), checkpoint)
    read = F.sum("input_rows").over(Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0))  # one row per batch
    return lags.select("batch_id", (read + F.col("lag")).alias("arrived"), "lag_alert")


q("stream_file_lag", _file_lag, f"""
SELECT CAST(i AS BIGINT) AS batch_id, n AS arrived, n * ({BATCHES} - 1 - i) / {BATCHES} > {G.MAX_LAG} AS lag_alert
FROM (SELECT count(*) AS n FROM lineitem) t, range({BATCHES}) r(i)""")
