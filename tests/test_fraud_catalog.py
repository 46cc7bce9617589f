"""The model queries train the same models as the operators do by default."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from shillingflow.catalog import fraud
from shillingflow.operators.ml import supervised
from shillingflow.session import write_out


def test_queries_fit_as_many_rounds_as_the_operators(spark, monkeypatch):
    i = F.col("id")
    payments = write_out(spark.range(600).select(
        F.concat(F.lit("T"), i.cast("string")).alias("transaction_id"),
        F.concat(F.lit("2547"), F.lpad((i % 20).cast("string"), 8, "0")).alias("phone_number"),
        (F.lit(900) + i * 37 % 200).cast("decimal(12,2)").alias("amount"),
        F.expr("timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(cast(id % 20 as int), cast(id % 6 as int), 0, 0)").alias("transaction_time"),
        (F.lit(174000) + i % 5).cast("string").alias("business_shortcode"),
        F.lit("Nairobi").alias("region"),
    ), "test")
    fitted = {}
    monkeypatch.setattr(supervised, "train", lambda labelled, estimator: fitted.update({type(estimator).__name__: estimator}))
    fraud.trained(SimpleNamespace(regional=payments), True)
    assert fitted["GBTClassifier"].getMaxIter() == supervised.gradient_boosting().getMaxIter() == 100
    assert fitted["RandomForestClassifier"].getNumTrees() == supervised.random_forest().getNumTrees() == 100
