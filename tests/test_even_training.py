"""Training rows lie in even parts, and a forest grown with kept places is the forest grown without."""

from pyspark.sql import functions as F

from shillingflow.operators.ml import store, supervised
from shillingflow.operators.ml.features import FEATURES
from shillingflow.plans import skew
from shillingflow.session import write_out


def payments(spark, n):
    """Half of the rows are one customer's."""
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("T"), i.cast("string")).alias("transaction_id"),
        F.when(i % 2 == 0, "254700000000").otherwise(F.concat(F.lit("2547"), F.lpad((i % 700).cast("string"), 8, "0"))).alias("phone_number"),
        (F.lit(900) + i * 37 % 200).cast("decimal(12,2)").alias("amount"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 20 as int), 1, 0, 0)").alias("transaction_time"),
        (F.lit(174000) + i % 5).cast("string").alias("business_shortcode"), F.lit("Nairobi").alias("region"))


def parts(rows):
    return sorted(r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect())


def test_features_are_dealt_evenly(spark, monkeypatch):
    monkeypatch.setattr(skew, "FEW_ROWS", 1000)
    rows = payments(spark, 8000).coalesce(1)
    sizes = parts(store.stored_features(rows))
    assert len(sizes) >= spark.sparkContext.defaultParallelism and sum(sizes) == 8000 and sizes[-1] <= 1.2 * sizes[0] + 10
    monkeypatch.setattr(skew, "FEW_ROWS", 8001)
    few = store.stored_features(rows)
    assert parts(few) == [8000]


def test_kept_places_grow_the_same_forest(spark, monkeypatch):
    seed = F.xxhash64("id")
    rows = write_out(spark.range(3000).select(
        F.col("id").cast("string").alias("transaction_id"), *[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50)).cast("double").alias(c) for k, c in enumerate(FEATURES)],
        (F.pmod(seed, F.lit(7)) == 0).cast("double").alias("label")), "test")
    said, kept, fit = [], [], type(supervised.random_forest()).fit
    monkeypatch.setattr(type(supervised.random_forest()), "fit", lambda self, learn: (kept.append(self.getCacheNodeIds()), fit(self, learn))[1])
    for most in (10_000, 10):
        monkeypatch.setattr(supervised, "PLACED", most)
        model = supervised.train(rows, supervised.random_forest()).model
        said.append(model.toDebugString.partition("\n")[2])
    assert kept == [True, False] and said[0] == said[1] and model.getNumTrees == 100
