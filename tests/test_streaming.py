"""Streams fed file by file: late rows, restarts, replays, timeouts."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shillingflow.functions import payments as P
from shillingflow.operators import ingest, quality, risk
from shillingflow.schemas import DEAD_LETTER
from shillingflow.sources import files
from shillingflow.streaming import events as E
from shillingflow.streaming import lag, landing
from shillingflow.streaming.runner import latest, run_available, write_batch
from shillingflow.streaming.velocity import velocity, velocity_batches

START = dt.datetime(2024, 1, 1)
SCHEMA = "TransID string, MSISDN string, TransAmount double, event_time timestamp"


def put(spark, folder, name, rows):
    """One file per call; files are read one per batch, oldest first."""
    data = [(i, p, a, START + dt.timedelta(seconds=s)) for i, p, a, s in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").json(f"{folder}/{name}")


def stream(spark, folder):
    return (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").json(str(folder))
    )


def collect(spark, frame, path, mode="append"):
    run_available(frame, lambda df, n: write_batch(df, f"{path}/out", n), f"{path}/checkpoint", mode)
    return spark.read.parquet(f"{path}/out").collect()


def test_windows_drop_late_rows_and_continue_after_restart(spark, tmp_path):
    put(spark, tmp_path / "in", "a", [("1", "0712", 5.0, 0), ("2", "0712", 200000.0, 1800)])
    hourly = E.hourly(E.enrich(stream(spark, tmp_path / "in")))
    collect(spark, hourly, tmp_path)
    put(spark, tmp_path / "in", "b", [("3", "0712", 7.0, 4000), ("4", "0712", 1.0, 9000)])
    collect(spark, hourly, tmp_path)
    put(spark, tmp_path / "in", "c", [("late", "0712", 9.0, 10), ("5", "0712", 1.0, 20000)])
    rows = collect(spark, E.hourly(E.enrich(stream(spark, tmp_path / "in"))), tmp_path)
    got = {(r.window_start.hour, r.key): (r.transaction_count, r.total_amount) for r in rows}
    assert got[(0, "low")] == (1, 5.0) and got[(0, "high")] == (1, 200000.0) and got[(1, "low")] == (1, 7.0)
    assert len(rows) == len(got)


def test_dedupe_across_batches(spark, tmp_path):
    put(spark, tmp_path / "in", "a", [("1", "p", 1.0, 0), ("1", "p", 1.0, 5), (None, "p", 1.0, 0)])
    put(spark, tmp_path / "in", "b", [("1", "p", 1.0, 60), ("2", "p", 1.0, 61), (None, "p", 1.0, 0)])
    rows = collect(spark, E.dedupe(stream(spark, tmp_path / "in")), tmp_path)
    assert sorted(str(r.TransID) for r in rows) == ["1", "2", "None", "None"]


def test_dedupe_holds_every_id_once_and_goes_on_after_a_restart(spark, tmp_path):
    put(spark, tmp_path / "in", "a", [("hot", "p", 1.0, k) for k in range(500)] + [(str(k), "p", 1.0, k) for k in range(5)])
    frame = E.dedupe(stream(spark, tmp_path / "in"))
    write = lambda df, n: write_batch(df, f"{tmp_path}/out", n)
    first = run_available(frame, write, f"{tmp_path}/checkpoint")
    assert len(first.lastProgress["stateOperators"]) == 1 and first.recentProgress[0]["stateOperators"][0]["numRowsTotal"] == 6
    assert first.recentProgress[0]["stateOperators"][0]["customMetrics"]["numDroppedDuplicateRows"] == 0  # copies fell out before the shuffle
    put(spark, tmp_path / "in", "b", [("hot", "p", 1.0, 900), ("3", "p", 1.0, 901), ("9", "p", 1.0, 902)])
    run_available(E.dedupe(stream(spark, tmp_path / "in")), write, f"{tmp_path}/checkpoint")
    assert sorted(r.TransID for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["0", "1", "2", "3", "4", "9", "hot"]


def test_velocity_equals_batch_twin(spark, tmp_path):
    burst = [(str(i), "0712", 10.0, 55 + i * 3) for i in range(12)] + [("x", "0799", 10.0, 60), ("y", "0799", 10.0, 60)]
    put(spark, tmp_path / "in", "a", burst[:8])
    put(spark, tmp_path / "in", "b", burst[8:] + [("z", "0712", 10.0, 700)])
    keyed = E.enrich(stream(spark, tmp_path / "in")).drop("processed_at")
    rows = collect(spark, velocity(keyed, "phone_standardized", "event_time", 30, 5, slot_spans=2), tmp_path)
    batch = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(str(tmp_path / "in"))
    twin = risk.velocity(
        batch.withColumn("phone", P.standardize_phone("MSISDN")), "phone", "event_time", "TransID", 30, 5
    )
    want = {r.TransID: (r.recent_transaction_count, r.velocity_flag) for r in twin.collect()}
    assert {r.TransID: (r.recent_transaction_count, r.velocity_flag) for r in rows} == want
    assert len(rows) == len(burst) + 1 and any(r.velocity_flag for r in rows)
    for limit in (2, 10**6):
        path = f"{tmp_path}/batches{limit}"
        velocity_batches(keyed, path, "phone_standardized", "event_time", "TransID", 30, 5, hot_rows=limit)
        out = spark.read.parquet(f"{path}/out").collect()
        assert {r.TransID: (r.recent_transaction_count, r.velocity_flag) for r in out} == want
        assert len(out) == len(rows)


def test_alerts_include_velocity(spark):
    df = spark.createDataFrame([(False, True), (True, None), (False, False)], "anomaly_flag boolean, velocity_flag boolean")
    assert E.alerts(df).count() == 2


EVENT = "event_type string, transaction_id string, received_at timestamp, phone_number string, amount string, " \
        "transaction_time string, payload string"


def put_events(spark, folder, name, rows):
    data = [(t, i, START + dt.timedelta(seconds=s), "254712345678", "10", time, json.dumps({"id": i, "s": s}))
            for t, i, s, time in rows]
    spark.createDataFrame(data, EVENT).coalesce(1).write.json(f"{folder}/{name}")


def event_stream(spark, folder):
    return (
        spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").json(str(folder))
    )


def test_landing_keeps_first_and_survives_replay(spark, tmp_path):
    good = "20240101000000"
    put_events(spark, tmp_path / "in", "a", [
        ("c2b_transaction", "1", 1, good), ("c2b_confirmation", "1", 0, good), ("refund", "9", 0, good),
        ("c2b_confirmation", None, 0, good)])
    path = str(tmp_path / "table")
    landing.run_landing(event_stream(spark, tmp_path / "in"), path)
    put_events(spark, tmp_path / "in", "b", [
        ("c2b_confirmation", "1", 50, good), ("c2b_confirmation", "2", 50, "2024-01-01T00:00:00Z"),
        ("c2b_confirmation", "3", 50, "soon"), ("c2b_confirmation", None, 0, good)])
    landing.run_landing(event_stream(spark, tmp_path / "in"), path)
    rows = spark.read.parquet(f"{path}/raw").collect()
    assert sorted(str(r.transaction_id) for r in rows) == ["1", "2", "None", "None"]
    first = next(r for r in rows if r.transaction_id == "1")
    assert first.received_at == START and first.event_type == "c2b_confirmation"
    letters = {r.message_id: r.failure_reason for r in spark.read.parquet(f"{path}/dead_letters").collect()}
    assert letters == {"9": "validation_error", "3": "invalid_format"}
    # the same batch once more, as after a lost driver: nothing doubles, nothing vanishes
    again = spark.read.schema(EVENT).json(f"{tmp_path}/in/b")
    landing.land(again, path)(again, 1)
    assert spark.read.parquet(f"{path}/raw").count() == len(rows)


def test_requests_follow_their_last_callback(spark, tmp_path):
    schema = "checkout_request_id string, phone_number string, amount double, account_reference string, initiated_at timestamp"
    calls = "checkout_request_id string, result_code bigint, result_desc string, received_at timestamp"

    def at(s):
        return START + dt.timedelta(seconds=s)

    def add(kind, n, rows, layout):
        spark.createDataFrame(rows, layout).coalesce(1).write.json(f"{tmp_path}/{kind}/{n}")

    def read(kind, layout):
        return spark.readStream.schema(layout).option("maxFilesPerTrigger", 1).option(
            "recursiveFileLookup", "true").json(f"{tmp_path}/{kind}")

    add("req", 1, [(x, "p", 1.0, "r", at(0)) for x in "abc"], schema)
    add("call", 1, [("a", 1, "first no", at(30)), ("early", 0, "ok", at(-5))], calls)
    add("req", 2, [("z", "p", 1.0, "r", at(9000)), ("early", "p", 1.0, "r", at(1))], schema)
    add("call", 2, [("a", 0, "then yes", at(60)), ("c", 0, "very late", at(4000))], calls)
    add("req", 3, [("new", "p", 1.0, "r", at(20000))], schema)
    add("call", 3, [(None, 1, "no", at(20000)), ("stray", 1, "no", at(1))], calls)
    _, timed = landing.run_stk(landing.stk_events(read("req", schema), read("call", calls)), str(tmp_path))
    state = landing.settled_at(spark, str(tmp_path))
    before = {r.checkout_request_id: r.status for r in state.collect()}
    assert before == {"a": "completed", "b": "expired", "c": "completed", "z": "expired", "early": "completed", "new": "initiated"}
    assert {r.status for r in landing.expire(state, F.lit(at(20130))).filter("checkout_request_id = 'new'").collect()} == {"expired"}
    # timers ended what was pending: only the last request is still held
    assert timed.lastProgress["stateOperators"][0]["numRowsTotal"] == 1
    held = [p["stateOperators"][0]["numRowsTotal"] for p in timed.recentProgress if p["stateOperators"]]
    assert max(held) > held[-1]
    # hours later a callback still wins, after a restart
    add("call", 4, [("b", 0, "hours late", at(90000))], calls)
    landing.run_stk(landing.stk_events(read("req", schema), read("call", calls)), str(tmp_path))
    assert {r.checkout_request_id: r.status for r in landing.settled_at(spark, str(tmp_path)).collect()} == before | {"b": "completed", "new": "expired"}


def test_topic_schema_lands(spark, tmp_path):
    """JSON messages as the topic carries them, over three micro-batches: every one is a row or a letter."""
    def message(i, **other):
        event = {"event_type": "c2b_confirmation", "received_at": f"2024-01-01T00:00:{i:02d}Z", "source": "s", "transaction_id": f"T{i}",
                 "phone_number": "254712345678", "amount": "5", "account_reference": "a", "transaction_time": "20240101000000", "data": {"k": str(i)}}
        return json.dumps(event | other)

    sent = [[message(1), message(1, data={"k": "copy"}), "{broken", message(2, transaction_time="soon")],
            [message(1), message(3, phone_number="254009999999"), message(4, data=None)], [message(5, event_type="refund"), message(4)]]
    for n, values in enumerate(sent):
        spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream_ = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    path = str(tmp_path / "table")
    landing.run_landing(files.parse_events(stream_), path, regions=True)
    rows = {r.transaction_id: r for r in spark.read.parquet(f"{path}/raw").collect()}
    assert set(rows) == {"T1", "T4"} and rows["T1"].data in ({"k": "1"}, {"k": "copy"}) and rows["T4"].data is None
    letters = spark.read.parquet(f"{path}/dead_letters")
    assert {c for c in letters.columns if c != "batch"} == set(DEAD_LETTER.fieldNames())
    told = sorted((r.failure_reason, r.is_recoverable, r.original_message) for r in letters.collect())
    assert [(a, b) for a, b, _ in told] == [("invalid_format", False)] * 2 + [("region_mapping_failed", True), ("validation_error", False)]
    assert any(m == "{broken" for *_, m in told)
    again = spark.readStream.schema(letters.drop("batch").schema).option("recursiveFileLookup", "true").parquet(f"{path}/dead_letters")
    landing.retry(again, str(tmp_path / "retry"))
    assert [r.message_id for r in spark.read.parquet(f"{tmp_path}/retry/retry").collect()] == ["T3"]


def test_unreadable_callbacks_become_letters(spark):
    rows, rejects = ingest.parse_c2b(spark.createDataFrame(
        [("1", "ten", "254712345678"), ("2", "10", "254712345678")], "TransID string, TransAmount string, MSISDN string").selectExpr(
        "*", *[f"CAST(null AS string) AS {c}" for c in ("BusinessShortCode", "TransTime", "BillRefNumber", "AccountReference")]))
    letters = quality.callback_letters(rejects).collect()
    assert rows.count() == 1 and [(r.message_id, r.failure_reason) for r in letters] == [("1", "invalid_format")]


def test_a_wrong_stamp_does_not_switch_velocity_off(spark, tmp_path):
    far = int((dt.datetime(2099, 1, 1) - START).total_seconds())
    put(spark, tmp_path / "in", "a", [(str(i), "0712", 1.0, i) for i in range(5)] + [("far", "0799", 1.0, far)])
    put(spark, tmp_path / "in", "b", [("6", "0712", 1.0, 10)])
    path = str(tmp_path / "v")
    velocity_batches(stream(spark, tmp_path / "in"), path, "MSISDN", "event_time", "TransID", 60, 5)
    got = {r.TransID: (r.recent_transaction_count, r.velocity_flag) for r in spark.read.parquet(f"{path}/out").collect()}
    assert got["6"] == (6, True) and [r.TransID for r in spark.read.parquet(f"{path}/future").collect()] == ["far"]


def test_aggregate_messages_count_once(spark, tmp_path):
    put(spark, tmp_path / "in", "a", [("1", "0712", 5.0, 0)])
    put(spark, tmp_path / "in", "b", [("2", "0712", 5.0, 60)])
    frame = E.aggregate_messages(E.hourly(E.enrich(stream(spark, tmp_path / "in"))), "hourly")
    collect(spark, frame, tmp_path, "update")
    rows = E.newest_messages(spark.read.parquet(f"{tmp_path}/out")).collect()
    assert [json.loads(r.value)["transaction_count"] for r in rows] == [2]


def test_lag_rows():
    report = {"batchId": 4, "durationMs": {"triggerExecution": 1500}, "sources": [
        {"description": "topic", "numInputRows": 7, "inputRowsPerSecond": 3.5,
         "endOffset": {"t": {"0": 100, "1": 50}}, "latestOffset": {"t": {"0": 20000, "1": 60}}}]}
    assert lag.progress_rows([report]) == [(4, "topic", 7, 3.5, 19910, 1500)]


def test_messages_round_trip(spark):
    df = spark.createDataFrame([("c2b_confirmation", "1", "0712", "5")], "event_type string, transaction_id string, phone_number string, amount string")
    sent = files.to_messages(df, "phone_number")
    assert sent.first()["key"] == "0712"
    broken = spark.createDataFrame([("k", "{broken")], "key string, value string")
    back = files.parse_events(sent.unionByName(broken)).collect()
    assert back[0].transaction_id == "1" and back[0]["_corrupt"] is None and back[1]["_corrupt"] == "{broken"


def test_kafka_is_wired(spark):
    """No Kafka package here: the reader must get as far as looking for it."""
    with pytest.raises(Exception, match="(?i)kafka"):
        files.read_events(spark, "localhost:9092", "transactions")
    df = spark.createDataFrame([("k", "v")], "key string, value string").select(F.col("key"), "value")
    assert df.columns == ["key", "value"]


def test_pending_requests_meet_no_python(spark, tmp_path):
    """Millions of ids pass the timers, so their state is kept by the engine's own sessions."""
    schema = "checkout_request_id string, phone_number string, amount double, account_reference string, initiated_at timestamp"
    calls = "checkout_request_id string, result_code bigint, result_desc string, received_at timestamp"
    spark.createDataFrame([], schema).write.json(f"{tmp_path}/req")
    spark.createDataFrame([], calls).write.json(f"{tmp_path}/call")
    events = landing.stk_events(spark.readStream.schema(schema).json(f"{tmp_path}/req"), spark.readStream.schema(calls).json(f"{tmp_path}/call"))
    plan = landing.stk_expiries(events)._jdf.queryExecution().analyzed().toString()
    assert "Pandas" not in plan and "session_window" in plan


def test_velocity_takes_a_group_row_by_row():
    """A group of a few rows costs no frame: rows come and go one at a time, whole numbers and gaps unchanged."""
    from types import SimpleNamespace

    from pyspark.sql import Row
    from shillingflow.streaming.velocity import RecentCounts

    kept, timers = [None], []
    state = SimpleNamespace(get=lambda: kept[0], update=lambda v: kept.__setitem__(0, v))
    processor = RecentCounts(10, 100, 2)
    processor.init(SimpleNamespace(getValueState=lambda *a: state, registerTimer=timers.append))
    clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    event = Row("TransID", "k", "at_us", "slot", "carried")
    first = [event("a", None, 105, 1, False), event("x", 7, 98, 1, True), event("b", 2**60 + 1, 105, 1, False)]
    got = list(processor.handleInputRows(("p", 1), iter(first), clock))
    assert [r.asDict() for r in got] == [
        {"TransID": "a", "k": None, "recent_transaction_count": 3, "velocity_flag": True},
        {"TransID": "b", "k": 2**60 + 1, "recent_transaction_count": 3, "velocity_flag": True}]
    again = list(processor.handleInputRows(("p", 1), iter([event("c", 1, 109, 1, False)]), clock))
    assert [(r.TransID, r.recent_transaction_count, r.velocity_flag) for r in again] == [("c", 3, True)]
    assert len(timers) == 1 and list(processor.handleInputRows(("p", 1), iter([event("y", 1, 99, 1, True)]), clock)) == []
