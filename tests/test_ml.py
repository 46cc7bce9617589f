"""Planted outliers, saved models and segments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shillingflow.operators.ml import iforest, segments, store, supervised
from shillingflow.operators.ml.features import FEATURES
from shillingflow.session import write_out


@pytest.fixture(scope="module")
def payments(spark):
    """3,000 ordinary payments and 15 far outside, all by their own customers at night."""
    i = F.col("id")
    planted = i % 200 == 7
    return write_out(spark.range(3000).select(
        F.concat(F.lit("T"), i.cast("string")).alias("transaction_id"),
        F.concat(F.lit("2547"), F.lpad((i % 60).cast("string"), 8, "0")).alias("phone_number"),
        F.when(planted, F.lit(400000) + i).otherwise(F.lit(900) + i * 37 % 200).cast("decimal(12,2)").alias("amount"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 20 as int), "
               "CASE WHEN id % 200 = 7 THEN 3 ELSE 10 + cast(id % 6 as int) END, 0, 0)").alias("transaction_time"),
        (F.lit(174000) + i % 5).cast("string").alias("business_shortcode"),
        F.lit("Nairobi").alias("region"),
    ), "test")


@pytest.fixture(scope="module")
def models(payments):
    return store.train_models(payments, rounds=5)


def test_planted_payments_rank_first(payments, models):
    features = store.stored_features(payments, models.profiles)
    scored = models.forest.predict(features)
    lowest = [r.transaction_id for r in scored.orderBy("fraud_score").limit(30).collect()]
    assert sum(int(t[1:]) % 200 == 7 for t in lowest) == 15
    flagged = scored.filter("fraud_prediction = -1").count()
    assert 20 <= flagged <= 40


def test_supervised_models_learn_the_labels(models):
    for trained in (models.random_forest, models.gradient_boosting):
        assert trained is not None and trained.train_accuracy > 0.98 and trained.test_accuracy > 0.97


def test_too_few_positives_skip_training(payments, models):
    rows = store.stored_features(payments, models.profiles).withColumn(
        "label", (F.col("transaction_id") == "T7").cast("double"))
    assert supervised.train(rows, supervised.random_forest()) is None


def test_models_survive_saving(spark, payments, models, tmp_path):
    store.save(models, spark, str(tmp_path))
    loaded = store.load(spark, str(tmp_path))
    one = payments.filter("transaction_id = 'T7'")
    features = store.stored_features(one, loaded.profiles)
    row = store.predict(loaded, features).first()
    assert row.risk_level == "HIGH" and row.total_votes == 3 and row.isolation_forest == "fraud"
    before = models.forest.predict(features).first().fraud_score
    assert abs(loaded.forest.predict(features).first().fraud_score - before) < 1e-12


def test_expected_path_and_tree():
    assert list(iforest.expected_path([1, 2])) == [0.0, 1.0]
    tree = iforest.grow_tree(np.random.default_rng(0).normal(size=(256, len(FEATURES))), 1)
    assert len(tree) <= 511 and tree["feature"].max() < len(FEATURES)


def test_segments_are_named_by_spend(spark):
    rows = [(str(g), f"c{g}-{i}", 10 * (g + 1), 1000.0 * 10 ** g + i, 100.0 * 10 ** g, 0.1)
            for g in range(5) for i in range(20)]
    metrics = spark.createDataFrame(
        rows, "g string, phone_number string, transaction_count bigint, total_amount double, avg_amount double, volatility double")
    got = segments.customer_segments(metrics).groupBy("segment_name").agg(F.avg("total_amount").alias("t")).collect()
    order = [r.segment_name for r in sorted(got, key=lambda r: -r.t)]
    assert order == segments.NAMES[: len(order)]


def test_paths_like_a_walk_through_each_tree():
    """Children lie side by side in flat arrays, a leaf is its own left child; gaps and infinities go where a comparison sends them."""
    import pandas as pd
    r = np.random.default_rng(5)
    points = np.column_stack([r.normal(size=400), r.integers(0, 2, 400), np.full(400, 7.0)])
    nodes = pd.concat([iforest.grow_tree(points[r.integers(0, 400, 64)], k).assign(tree=k) for k in range(7)] + [
        iforest.grow_tree(points[:1], 9).assign(tree=7)])
    rows = np.vstack([points, [[np.nan, 0, 7], [np.inf, np.nan, 7], [-np.inf, 1, np.nan]]])
    got = iforest._mean_path(rows, iforest._stack(nodes), 6)
    for row, mean in zip(rows, got):
        ends = []
        for _, tree in nodes.groupby("tree"):
            tree, at = tree.set_index("node"), 0
            while tree.loc[at, "feature"] >= 0:
                at = int(tree.loc[at, "left" if row[int(tree.loc[at, "feature"])] <= tree.loc[at, "cut"] else "right"])
            ends.append(tree.loc[at, "path"])
        assert mean == pytest.approx(np.mean(ends))
    arrays = iforest._stack(nodes)
    inner = arrays["child"] != np.arange(len(arrays["child"]))
    assert all(x.ndim == 1 for x in arrays.values()) and np.isfinite(arrays["cut"][inner]).all() and np.isinf(arrays["cut"][~inner]).all()
