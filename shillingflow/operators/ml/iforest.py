"""Isolation forest: trees grown from small samples, scores computed where the rows are."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ...plans.skew import exact_quantiles
from ...session import write_out
from .features import FEATURES

TREES, SAMPLE, CONTAMINATION, SEED = 100, 256, 0.01, 42
BLOCK = 1024  # rows scored together, so their places in all trees stay in the processor's cache
NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, path double"


def expected_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype="float64")
    big = np.maximum(n, 3)
    longer = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, longer, np.where(n == 2, 1.0, 0.0))


def grow_tree(points: np.ndarray, seed: int) -> pd.DataFrame:
    """Random splits until points are alone, equal, or the depth of a balanced tree is reached."""
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes: list[list] = []
    todo = [(points, 0, -1, "")]
    while todo:
        part, depth, parent, side = todo.pop()
        number = len(nodes)
        if parent >= 0:
            nodes[parent][3 if side == "left" else 4] = number
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or len(varying) == 0:
            nodes.append([number, -1, 0.0, number, number, float(depth + expected_path(len(part)))])
            continue
        feature = int(rng.choice(varying))
        # strictly below the maximum, so neither side is empty
        cut = float(min(rng.uniform(low[feature], high[feature]), np.nextafter(high[feature], low[feature])))
        goes_left = part[:, feature] <= cut
        nodes.append([number, feature, cut, -1, -1, 0.0])
        todo.append((part[goes_left], depth + 1, number, "left"))
        todo.append((part[~goes_left], depth + 1, number, "right"))
    return pd.DataFrame(nodes, columns=["node", "feature", "cut", "left", "right", "path"])


@dataclass
class Forest:
    """Nodes (at most ``TREES * 2 * SAMPLE`` rows), sample size and decision offset."""

    nodes: pd.DataFrame
    sample: int
    offset: float | None = None

    def score(self) -> Column:
        """Anomaly score of a row; lower is more unusual, as -1 is the extreme."""
        arrays = _stack(self.nodes)
        depth = int(np.ceil(np.log2(max(self.sample, 2))))
        scale = float(expected_path(self.sample))

        @F.pandas_udf("double")
        def path_score(*columns: pd.Series) -> pd.Series:
            rows = np.column_stack([c.to_numpy(dtype="float64") for c in columns])
            scores = np.empty(len(rows))
            for start in range(0, len(rows), BLOCK):
                scores[start:start + BLOCK] = _mean_path(rows[start:start + BLOCK], arrays, depth)
            return pd.Series(-np.power(2.0, -scores / scale))

        return path_score(*[F.col(c).cast("double") for c in FEATURES])

    def predict(self, rows: DataFrame) -> DataFrame:
        """Adds ``fraud_score`` and ``fraud_prediction`` (-1 unusual, 1 normal)."""
        return rows.withColumn("fraud_score", self.score()).withColumn(
            "fraud_prediction", F.when(F.col("fraud_score") < self.offset, -1).otherwise(1)
        )


def _stack(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """All trees in flat arrays. A node's children lie side by side from ``child`` on, the right one last; a leaf is
    its own left child, and no value lies right of it."""
    frame = nodes.sort_values(["tree", "node"])
    tree, node = frame["tree"].to_numpy("int64"), frame["node"].to_numpy("int64")
    width = int(node.max()) + 1
    place = np.zeros((int(tree.max()) + 1) * width, "int64")  # of a tree's node in the flat arrays
    feature, inner = frame["feature"].to_numpy("int64"), np.flatnonzero(frame["feature"].to_numpy("int64") >= 0)
    roots = np.flatnonzero(node == 0)
    place[tree[roots] * width] = np.arange(len(roots))
    pairs = len(roots) + 2 * np.arange(len(inner))
    for side, step in (("left", 0), ("right", 1)):
        place[tree[inner] * width + frame[side].to_numpy("int64")[inner]] = pairs + step
    at = place[tree * width + node]
    arrays = {name: np.empty(len(frame), kind) for name, kind in (("feature", "int64"), ("cut", "float64"), ("child", "int64"), ("path", "float64"))}
    arrays["feature"][at] = np.maximum(feature, 0)
    arrays["cut"][at] = np.where(feature >= 0, frame["cut"].to_numpy("float64"), np.inf)
    arrays["path"][at] = frame["path"].to_numpy("float64")
    arrays["child"][at] = at
    arrays["child"][at[inner]] = pairs
    return arrays | {"roots": place[np.arange(int(tree.max()) + 1) * width]}


def _mean_path(rows: np.ndarray, arrays: dict[str, np.ndarray], depth: int) -> np.ndarray:
    # what is no number goes right, as the greatest value does
    columns = np.ascontiguousarray(np.where(np.isnan(rows), np.inf, rows)).ravel()
    line = np.arange(len(rows))[:, None] * rows.shape[1]
    at = np.broadcast_to(arrays["roots"], (len(rows), len(arrays["roots"])))
    for _ in range(depth):  # places are in range, so nothing is wrapped; it only saves the check
        value = columns.take(arrays["feature"].take(at, mode="wrap") + line, mode="wrap")
        at = arrays["child"].take(at, mode="wrap") + (value > arrays["cut"].take(at, mode="wrap"))
    return arrays["path"].take(at, mode="wrap").mean(axis=1)


def draw_samples(features: DataFrame, row_id: str, trees: int, sample: int, seed: int) -> DataFrame:
    """``sample`` rows per tree out of a pool of ``trees * sample`` hashed rows.

    Sampling is how the method works; both sizes are its parameters, whatever the input. The pool is
    numbered once and a tree takes its slice, which wraps around where there are fewer rows.
    """
    wanted, slots = trees * sample, 1 << 30
    share = min(1.0, 4 * wanted / max(features.count(), 1))  # four times enough, so the sort stays small
    pool = (
        features.select(row_id, *FEATURES).withColumn("_order", F.xxhash64(row_id, F.lit(seed)))
        .filter(F.pmod("_order", F.lit(slots)) < int(np.ceil(share * slots)))
        .orderBy("_order", row_id).limit(wanted)
    )
    whole = Window.partitionBy()
    numbered = pool.withColumn("_at", F.row_number().over(Window.orderBy("_order", row_id)) - 1).withColumn("_n", F.count("*").over(whole))
    slices = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.pmod(F.col("_at") - t * sample, F.col("_n")) < sample)
    return numbered.withColumn("tree", F.explode(slices)).drop("_order", "_at", "_n")


def fit(features: DataFrame, row_id: str = "transaction_id", trees: int = TREES, sample: int = SAMPLE,
        contamination: float = CONTAMINATION, seed: int = SEED) -> Forest:
    """Grow the trees in parallel, then set the offset at the ``contamination`` quantile.

    ``features`` is read twice, so pass a stored table.
    """
    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        points = group.sort_values(row_id)[FEATURES].to_numpy(dtype="float64")
        return grow_tree(points, seed + tree).assign(tree=tree, size=len(points))

    grown = draw_samples(features, row_id, trees, sample, seed).groupBy("tree").applyInPandas(
        grow, NODE_SCHEMA + ", size int"
    ).toPandas()  # bounded: trees * 2 * sample nodes
    forest = Forest(grown.drop(columns="size"), int(grown["size"].max()))
    scored = write_out(features.select(forest.score().alias("score")), "scores")  # scored once, read twice
    forest.offset = float(exact_quantiles(scored, "score", {"cut": contamination}).first()["cut"])
    return forest
