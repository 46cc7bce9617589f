"""Files, warehouse layout, views and snapshots."""

import json

import pytest
from pyspark.sql import functions as F

from shillingflow.sources import files, warehouse
from shillingflow.sources.dataset import Dataset
from shillingflow.session import shared_dir

FOLDER = "/root/testdata/sf0.001"


def test_json_callbacks(spark, tmp_path):
    path = tmp_path / "callbacks.json"
    path.write_text(json.dumps([
        {"TransID": "A", "TransAmount": 1500.0, "MSISDN": "254712345678", "MiddleName": ""},
        {"TransID": "B", "TransAmount": "20.00", "MSISDN": "0712345678", "TransTime": "20260613120000"},
    ], indent=1))
    rows = files.json_callbacks(spark, str(path)).orderBy("TransID").collect()
    assert [(r.TransID, r.TransAmount, r.AccountReference) for r in rows] == [("A", "1500.0", None), ("B", "20.00", None)]


def test_warehouse_partitions_are_pruned(spark, tmp_path):
    tx = Dataset(spark, FOLDER).tx
    path = str(tmp_path / "tx")
    warehouse.warehouse_write(tx, path, "transaction_date", ["customer_phone_number"], "transaction_id")
    table = spark.read.parquet(path)
    assert table.count() == tx.count()
    day = tx.agg(F.max("transaction_date")).first()[0]
    from shillingflow.operators import dashboards

    last = dashboards.recent(table, F.lit(day).cast("timestamp_ntz"), 30, "DAYS")
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "transaction_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert last.count() == dashboards.recent(tx, F.lit(day).cast("timestamp_ntz"), 30, "DAYS").count()


def test_arrival_panels_read_only_their_days(spark, tmp_path):
    from shillingflow.operators import dashboards as D
    from shillingflow.operators import health as H

    d = Dataset(spark, FOLDER)
    raw_path, tx_path = str(tmp_path / "raw"), str(tmp_path / "tx")
    warehouse.save_raw(d.raw_feed, raw_path)
    warehouse.warehouse_write(d.tx, tx_path, "transaction_date", ["customer_phone_number"], "transaction_id")
    raw, tx = spark.read.parquet(raw_path), spark.read.parquet(tx_path)
    cases = {
        "received_date": [lambda r, t: D.raw_loaded(r, d.raw_as_of, 720), lambda r, t: D.ingest_rate(r, d.raw_as_of, 720),
                          lambda r, t: H.volume_check(r, d.raw_as_of, 720), lambda r, t: D.raw_vs_staged(r, t, d.raw_as_of, days=30)],
        "transaction_date": [lambda r, t: D.value_by_hour(None, t, d.as_of), lambda r, t: D.value_by_hour_as_written(t, d.as_of)],
    }
    for date, panels in cases.items():
        for panel in panels:
            stored, plain = panel(raw, tx), panel(d.raw_feed, d.tx)
            plan = stored._jdf.queryExecution().executedPlan().toString()
            assert any(date in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])
            assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))


def test_models_as_views_and_tables(spark, tmp_path):
    feed = Dataset(spark, FOLDER).raw_feed
    names = warehouse.model_views(feed)
    assert set(names) >= {"stg_raw_events", "stg_c2b_transactions", "mart_hourly_volumes"}
    built = spark.sql("SELECT sum(transaction_count) n, max(created_at) t FROM mart_hourly_volumes").first()
    assert built.n == spark.table("stg_c2b_transactions").count() and built.t is not None
    warehouse.save_models(feed, str(tmp_path))
    saved = spark.read.parquet(f"{tmp_path}/mart_hourly_volumes")
    assert saved.agg(F.sum("transaction_count")).first()[0] == built.n


def test_snapshot_is_verified(spark, tmp_path):
    tx = Dataset(spark, FOLDER).tx
    warehouse.snapshot(tx, str(tmp_path), "tx")
    row = warehouse.snapshot_verify(spark, str(tmp_path), "tx").first()
    assert row.intact and row.row_count == tx.count() == warehouse.restore(spark, str(tmp_path), "tx").count()
    tx.limit(1).write.mode("append").parquet(f"{tmp_path}/tx/data")
    assert not warehouse.snapshot_verify(spark, str(tmp_path), "tx").first().intact
    with pytest.raises(ValueError):
        warehouse.restore(spark, str(tmp_path), "tx")


def test_scans_read_only_needed_columns(spark):
    plan = Dataset(spark, FOLDER).heatmap._jdf.queryExecution().executedPlan().toString()
    assert "o_custkey" not in plan.split("ReadSchema: ")[1].splitlines()[0]


def test_time_ranges_reach_the_scan(spark):
    d = Dataset(spark, FOLDER)
    from shillingflow.operators import dashboards, health

    for df in (health.bench_select(d.payments, d.as_of), dashboards.value_mix(d.tx, d.as_of)):
        pushed = df._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1]
        assert "GreaterThanOrEqual(o_orderdate," in pushed.split("ReadSchema")[0]


def test_shared_dir_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_dir(spark, "x")
    assert path.startswith(base or spark.conf.get("spark.checkpoint.dir"))
