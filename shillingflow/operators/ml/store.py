"""Training run, saved models and scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...plans.skew import HOT_ROWS, evenly
from ...session import write_out
from . import iforest, supervised
from .ensemble import ensemble_vote
from .features import (
    amount_cuts, customer_profile, fill_means, fraud_features, merchant_profile,
)


@dataclass
class FraudModels:
    forest: iforest.Forest
    profiles: dict[str, DataFrame]
    random_forest: supervised.Trained | None = None
    gradient_boosting: supervised.Trained | None = None


def stored_profiles(payments: DataFrame) -> dict[str, DataFrame]:
    """Profiles the features need, written once so that several readers share them."""
    return {
        "customer": write_out(customer_profile(payments).select(
            "phone_number", "customer_avg_amount", "customer_std_amount", "customer_transaction_count"), "profiles"),
        "merchant": write_out(merchant_profile(payments).drop("merchant_unique_customers"), "profiles"),
        "cuts": write_out(amount_cuts(payments), "profiles"),
    }


def stored_features(payments: DataFrame, profiles: dict[str, DataFrame] | None = None,
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """Complete features as a table in even parts; filling the gaps needs a pass of its own."""
    return fill_means(write_out(evenly(fraud_features(payments, profiles, hot_rows), payments.count()), "features"))


def train_models(payments: DataFrame, rounds: int = 100, with_supervised: bool = True) -> FraudModels:
    """Isolation forest, then forest and boosting on its labels when there are enough of them."""
    profiles = stored_profiles(payments)
    features = stored_features(payments, profiles)
    models = FraudModels(iforest.fit(features), profiles)
    if with_supervised:
        labelled = write_out(supervised.pseudo_label(models.forest.predict(features)), "labelled")
        models.random_forest = supervised.train(labelled, supervised.random_forest())
        models.gradient_boosting = supervised.train(labelled, supervised.gradient_boosting(rounds=rounds))
    return models


def save(models: FraudModels, spark: SparkSession, path: str) -> None:
    nodes = spark.createDataFrame(models.forest.nodes[["tree", "node", "feature", "cut", "left", "right", "path"]])
    nodes.withColumn("offset", F.lit(models.forest.offset)).withColumn("sample", F.lit(models.forest.sample)).write.mode(
        "overwrite").parquet(f"{path}/isolation_forest")
    for name, df in models.profiles.items():
        df.write.mode("overwrite").parquet(f"{path}/profile_{name}")
    accuracies = []
    for name in ("random_forest", "gradient_boosting"):
        trained = getattr(models, name)
        if trained is not None:
            trained.model.write().overwrite().save(f"{path}/{name}")
            accuracies.append((name, trained.train_accuracy, trained.test_accuracy))
    spark.createDataFrame(accuracies, "model string, train double, test double").write.mode("overwrite").parquet(
        f"{path}/accuracy")


def load(spark: SparkSession, path: str) -> FraudModels:
    nodes = spark.read.parquet(f"{path}/isolation_forest").toPandas()
    forest = iforest.Forest(
        nodes.drop(columns=["offset", "sample"]), int(nodes["sample"].iloc[0]), float(nodes["offset"].iloc[0])
    )
    profiles = {n: spark.read.parquet(f"{path}/profile_{n}") for n in ("customer", "merchant", "cuts")}
    loaded = FraudModels(forest, profiles)
    readers = {"random_forest": RandomForestClassificationModel, "gradient_boosting": GBTClassificationModel}
    for row in spark.read.parquet(f"{path}/accuracy").collect():  # at most two rows
        model = readers[row["model"]].load(f"{path}/{row['model']}")
        setattr(loaded, row["model"], supervised.Trained(model, row["train"], row["test"]))
    return loaded


def predict(models: FraudModels, features: DataFrame) -> DataFrame:
    """Votes of the present models per row, with each model's score or probability and its confidence."""
    rows = models.forest.predict(features).withColumns({
        "isolation_forest_pred": (F.col("fraud_prediction") == -1).cast("bigint"),
        "isolation_forest_score": F.col("fraud_score"), "isolation_forest_confidence": F.abs("fraud_score"),
    })
    for name in ("random_forest", "gradient_boosting"):
        trained = getattr(models, name)
        if trained is None:
            rows = rows.withColumn(f"{name}_pred", F.lit(None).cast("bigint")).withColumns(
                {f"{name}_{c}": F.lit(None).cast("double") for c in ("probability", "confidence")})
            continue
        scored = trained.model.transform(supervised.assemble(rows))
        chance = vector_to_array("probability")[1]
        rows = scored.withColumns({
            f"{name}_pred": F.col("prediction").cast("bigint"), f"{name}_probability": chance, f"{name}_confidence": chance,
        }).drop("prediction", "rawPrediction", "probability", "features")
    return ensemble_vote(rows)


def batch_fraud(scored: DataFrame) -> DataFrame:
    """Totals of a scored batch."""
    hit = F.count_if(F.col("fraud_prediction") == -1)
    return scored.agg(
        F.count("*").alias("total_transactions"), hit.alias("suspicious_transactions"),
        F.round(F.coalesce(F.try_divide(hit * F.lit(100.0).cast("double"), F.count("*")), F.lit(0.0)), 2)
        .alias("suspicious_percentage"),
    )


def high_risk_customers(scored: DataFrame, limit: int = 10) -> DataFrame:
    return (
        scored.filter("fraud_prediction = -1").groupBy("phone_number")
        .agg(F.count("*").alias("suspicious_count"), F.sum("amount").cast("double").alias("amount"),
             F.round(F.avg("fraud_score"), 6).alias("mean_score"))
        .orderBy(F.desc("suspicious_count"), F.desc("amount"), "phone_number").limit(limit)
    )
