"""Customer segments by k-means."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Clustering inputs, and names from the highest mean spend to the lowest.
INPUTS = ["transaction_count", "total_amount", "avg_amount", "volatility"]
NAMES = ["High Value", "Regular", "Occasional", "New", "Inactive"]


def customer_segments(metrics: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """Metrics with ``segment`` and ``segment_name``. Pass a stored table: the fit reads it often."""
    vectors = VectorAssembler(inputCols=INPUTS, outputCol="_raw").transform(metrics)
    scaled = StandardScaler(withMean=True, withStd=True, inputCol="_raw", outputCol="_scaled").fit(vectors).transform(vectors)
    model = KMeans(k=k, seed=seed, featuresCol="_scaled", predictionCol="_cluster").fit(scaled)
    spend = INPUTS.index("total_amount")
    order = sorted(range(len(model.clusterCenters())), key=lambda c: -model.clusterCenters()[c][spend])
    rank = F.create_map(*[F.lit(x) for r, c in enumerate(order) for x in (c, r)])
    names = F.array(*[F.lit(NAMES[i] if i < len(NAMES) else f"Segment {i}") for i in range(len(order))])
    ranked = model.transform(scaled).withColumn("segment", F.element_at(rank, F.col("_cluster")))
    return ranked.withColumn("segment_name", F.element_at(names, F.col("segment") + 1)).drop("_raw", "_scaled", "_cluster")
