"""Vote of the fraud models."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODELS = ["isolation_forest", "random_forest", "gradient_boosting"]


def ensemble_vote(predictions: DataFrame, models: list[str] = MODELS) -> DataFrame:
    """``<model>_pred`` columns hold 1 for fraud, 0 for normal and null for an absent model.

    No answer at all gives ``UNKNOWN``.
    """
    preds = [F.col(f"{m}_pred") for m in models]
    votes = reduce(add, [F.coalesce(p, F.lit(0)) for p in preds]).cast("bigint")
    total = reduce(add, [p.isNotNull().cast("int") for p in preds]).cast("bigint")
    majority = votes > total / 2
    risk = F.when(total == 0, "UNKNOWN").when(majority, "HIGH").when(votes > 0, "MEDIUM").otherwise("LOW")
    return predictions.withColumns({
        "consensus_votes": votes,
        "total_votes": total,
        "fraud_probability": F.try_divide(votes.cast("double"), total.cast("double")),
        "fraud_risk": F.when(total == 0, F.lit(None)).when(majority, "high").otherwise("low"),
        "risk_level": risk,
        **{m: F.when(p == 1, "fraud").when(p == 0, "normal") for m, p in zip(models, preds)},
    })
