"""Forest and boosting on pseudo labels."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import FEATURES

SEED = 42
MIN_POSITIVES = 10
PLACED = 2_000_000  # rows whose places in all trees of a forest are kept while it grows, 4 bytes a tree


def pseudo_label(predicted: DataFrame) -> DataFrame:
    """Unusual rows become the positive class."""
    return predicted.withColumn("label", (F.col("fraud_prediction") == -1).cast("double"))


def assemble(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def split(rows: DataFrame, row_id: str = "transaction_id", seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """About 80/20 by hash of the id: repeatable without sorting the partitions."""
    slot = F.pmod(F.xxhash64(row_id, F.lit(seed)), F.lit(10))
    return rows.filter(slot < 8), rows.filter(slot >= 8)


@dataclass
class Trained:
    model: Any
    train_accuracy: float
    test_accuracy: float


def _accuracy(model, rows: DataFrame) -> float:
    hit = (F.col("prediction") == F.col("label")).cast("double")
    return model.transform(rows).agg(F.avg(hit)).first()[0]


def random_forest(seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=100, maxDepth=10, seed=seed)


def gradient_boosting(seed: int = SEED, rounds: int = 100) -> GBTClassifier:
    return GBTClassifier(maxIter=rounds, maxDepth=3, stepSize=0.1, seed=seed)


def train(labelled: DataFrame, estimator, row_id: str = "transaction_id") -> Trained | None:
    """``None`` when there are too few positive rows to learn from. Pass a stored table."""
    if labelled.filter("label = 1").limit(MIN_POSITIVES + 1).count() <= MIN_POSITIVES:
        return None
    learn, held_out = split(assemble(labelled), row_id)
    if isinstance(estimator, RandomForestClassifier) and labelled.count() <= PLACED:
        # the same trees; rows need not be led down from the root again at each level
        estimator = estimator.copy({estimator.cacheNodeIds: True, estimator.checkpointInterval: -1})
    model = estimator.fit(learn)
    return Trained(model, _accuracy(model, learn), _accuracy(model, held_out))
