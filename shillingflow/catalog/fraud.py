"""Model-based queries. Their results have no SQL form; tests check them against planted cases."""

from pyspark.sql import functions as F

from ..operators import analytics as A
from ..operators.ml import segments, store, supervised
from ..operators.ml.ensemble import MODELS
from ..session import shared_dir, write_out
from .base import query

COLUMNS = ["transaction_id", "phone_number", "amount", "transaction_time", "business_shortcode", "region"]


def rows(d):
    return d.regional.select(*COLUMNS)


def trained(d, with_supervised=False):
    """A training run of its own for every query: results depend on the data alone."""
    models = store.train_models(rows(d), with_supervised=with_supervised)
    return models, store.stored_features(rows(d), models.profiles)


def labelled(d):
    models, features = trained(d)
    return supervised.pseudo_label(models.forest.predict(features))


def accuracy(d, name, estimator):
    result = supervised.train(write_out(labelled(d), "labelled"), estimator)
    numbers = [] if result is None else [(name, result.train_accuracy, result.test_accuracy)]
    return d.spark.createDataFrame(numbers, "model string, train_accuracy double, test_accuracy double")


@query("isolation_forest")
def _(d):
    models, features = trained(d)
    return models.forest.predict(features).select("transaction_id", "fraud_score", "fraud_prediction")


@query("isolation_forest_share", """
SELECT count(*) AS rows, true AS near_contamination FROM payments""")
def _(d):
    """One row in a hundred is called unusual, within a tenth of a percent."""
    models, features = trained(d)
    share = F.avg((F.col("fraud_prediction") == -1).cast("double"))
    return models.forest.predict(features).agg(F.count("*").alias("rows"), (F.abs(share - 0.01) <= 0.001).alias("near_contamination"))


@query("pseudo_label")
def _(d):
    return labelled(d).groupBy("label").agg(F.count("*").alias("rows"))


@query("random_forest")
def _(d):
    return accuracy(d, "random_forest", supervised.random_forest())


@query("gradient_boosting")
def _(d):
    return accuracy(d, "gradient_boosting", supervised.gradient_boosting())


@query("fraud_predictions")
def _(d):
    models, features = trained(d, True)
    return store.predict(models, features).select(
        "transaction_id", "consensus_votes", "total_votes", "fraud_probability", "risk_level", "isolation_forest_score",
        *[f"{m}_{c}" for m in ("random_forest", "gradient_boosting") for c in ("probability", "confidence")]
    )


def recent_scored(d, days):
    """The last days against profiles saved by the training run."""
    models, _ = trained(d)
    recent = A.since(rows(d), d.as_of, days)
    return models.forest.predict(store.stored_features(recent, models.profiles))


def given_scored(d, days):
    """The last days with a prediction that is given: every large payment is unusual."""
    unusual = F.when(F.col("amount") > 200000, -1).otherwise(1)
    return A.since(rows(d), d.as_of, days).withColumn("fraud_prediction", unusual).withColumn("fraud_score", F.lit(-0.5))


@query("batch_fraud")
def _(d):
    return store.batch_fraud(recent_scored(d, 7))


@query("high_risk_customers")
def _(d):
    return store.high_risk_customers(recent_scored(d, 3650))


SINCE = "(SELECT * FROM payments WHERE transaction_time >= (SELECT as_of FROM clock) - INTERVAL {} DAY) p"


@query("batch_fraud_given", f"""
SELECT count(*) AS total_transactions, count(*) FILTER (amount > 200000) AS suspicious_transactions,
  round(coalesce(count(*) FILTER (amount > 200000) * 100.0::DOUBLE / nullif(count(*), 0), 0), 2) AS suspicious_percentage
FROM {SINCE.format(90)}""")
def _(d):
    return store.batch_fraud(given_scored(d, 90))


@query("high_risk_customers_given", f"""
SELECT phone_number, count(*) AS suspicious_count, CAST(sum(amount) AS DOUBLE) AS amount, -0.5::DOUBLE AS mean_score
FROM {SINCE.format(3650)} WHERE amount > 200000 GROUP BY 1 ORDER BY suspicious_count DESC, amount DESC, phone_number LIMIT 10""")
def _(d):
    return store.high_risk_customers(given_scored(d, 3650))


@query("model_save_load", """
SELECT * FROM (VALUES ('isolation_forest', 0::BIGINT), ('random_forest', 0::BIGINT), ('gradient_boosting', 0::BIGINT)) m(model, mismatches)""")
def _(d):
    """Rows for which a model that was saved and loaded again says something else."""
    models, features = trained(d, True)
    path = shared_dir(d.spark, "models")
    store.save(models, d.spark, path)
    votes = [f"{m}_pred" for m in MODELS]
    said = [store.predict(m, features).select("transaction_id", *votes) for m in (models, store.load(d.spark, path))]
    both = said[0].join(said[1].withColumnsRenamed({v: f"_{v}" for v in votes}), "transaction_id")
    counted = both.agg(*[F.count_if(~F.col(v).eqNullSafe(F.col(f"_{v}"))).alias(m) for m, v in zip(MODELS, votes)])
    return counted.unpivot([], MODELS, "model", "mismatches")


def segmented(d):
    metrics = write_out(A.customer_day_metrics(d.payments, d.as_of, days=3650), "metrics")
    return segments.customer_segments(metrics)


@query("customer_segments")
def _(d):
    return segmented(d).select("phone_number", "last_transaction_date", "segment_name", "customer_value_score")


@query("segment_stats")
def _(d):
    return A.segment_stats(segmented(d))


@query("analytics_report")
def _(d):
    return A.analytics_report(d.payments, d.regional, lambda: d.as_of, segmented(d))
