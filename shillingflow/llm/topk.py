"""Exact top-k inner products by three phases with a uniform threshold.

A score is the sum of ``LISTS`` partial scores, one per group of components. First every block of
candidates gathers the head of each of its lists; the k-th best full score among those is a safe
lower bound. Shared evenly, it is the cutoff that goes out to all blocks: a candidate that stays
below it in every list stays below the bound in sum. Blocks then collect the entries that reach
the cutoff in some list, and only those are resolved exactly.

Queries and candidates meet block by block, packed as matrices; no row per pair is ever made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_out
from .common import groups_for, partitions

LISTS = 4
HEAD = 4  # entries gathered per block and list
CANDIDATES, QUERIES, FAN = 2048, 256, 256
LEAST = np.iinfo(np.int64).min


def whole_vectors(rows: DataFrame, scale: int = 64) -> DataFrame:
    """``vec_id`` and ``floor(scale * component)``; vectors that are null or hold null or non-finite
    components take no part, nor do rows without an id."""
    real = "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    return rows.filter(real).select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _pack(block: str):
    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id", kind="stable")
        width = max((len(v) for v in part["v"]), default=0)
        matrix = np.zeros((len(part), width), dtype=np.int64)
        for row, v in zip(matrix, part["v"]):
            row[: len(v)] = v
        top = int(np.abs(matrix).max(initial=0))
        kind = np.int16 if top < 1 << 15 else np.int64
        return pd.DataFrame({block: [int(part[block].iloc[0])], "ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
                             "matrix": [matrix.astype(kind).tobytes()], "width": [width], "top": [top]})
    return pack


def packed(vectors: DataFrame, block: str, per_block: int, count: int) -> DataFrame:
    n = groups_for(count, per_block)
    dealt = vectors.withColumn(block, F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
    return write_out(dealt.groupBy(block).applyInPandas(_pack(block), f"{block} int, ids binary, matrix binary, width int, top long"), block)


def _matrices(row) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Ids and matrices of both sides, and the parts of the width that make up the lists."""
    def unpack(ids, matrix, width, top):
        ids = np.frombuffer(ids, np.int64)
        return ids, np.frombuffer(matrix, np.int16 if top < 1 << 15 else np.int64).reshape(len(ids), width)

    qi, q = unpack(row.q_ids, row.q_matrix, row.q_width, row.q_top)
    ci, c = unpack(row.ids, row.matrix, row.width, row.top)
    width = min(q.shape[1], c.shape[1])  # components that only one side has count as 0
    reach = row.q_top * row.top * max(width, 1)
    kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64
    cuts = np.array_split(np.arange(width), LISTS)
    return qi, ci, cuts, q[:, :width].astype(kind), c[:, :width].astype(kind)


def _partials(row):
    """Partial scores: list, query, candidate. A query's own row scores lowest in every list."""
    qi, ci, cuts, q, c = _matrices(row)
    parts = np.stack([q[:, cut] @ c[:, cut].T for cut in cuts])
    return qi, ci, parts, qi[:, None] == ci[None, :]


def _heads(rows: Iterator[pd.DataFrame], k: int, head: int) -> Iterator[pd.DataFrame]:
    """Phase one in a block: full scores of the entries that head its lists."""
    for frame in rows:
        for row in frame.itertuples(index=False):
            qi, ci, parts, own = _partials(row)
            total = parts.sum(axis=0)
            size = min(head + 1, len(ci))  # the own row may head a list
            heads = np.argpartition(parts, len(ci) - size, axis=2)[:, :, len(ci) - size:]
            heads = np.sort(heads.transpose(1, 0, 2).reshape(len(qi), -1), axis=1)
            got = np.take_along_axis(total, heads, 1).astype(np.int64)
            got[np.take_along_axis(own, heads, 1)] = LEAST
            got[:, 1:][heads[:, 1:] == heads[:, :-1]] = LEAST  # an entry that heads several lists counts once
            yield pd.DataFrame({"qb": [row.qb], "part": [row.cb], "scores": [_best(got, k).tobytes()]})


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    full = np.full((len(scores), k), LEAST, dtype=np.int64)
    top = np.sort(scores, axis=1)[:, ::-1][:, :k]
    full[:, : top.shape[1]] = top
    return full


def _merge_heads(k: int):
    def merge(part: pd.DataFrame) -> pd.DataFrame:
        stack = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, k) for x in part["scores"]], axis=1)
        return pd.DataFrame({"qb": [int(part["qb"].iloc[0])], "part": [int(part["part"].iloc[0])], "scores": [_best(stack, k).tobytes()]})
    return merge


def _collect(rows: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Phases two and three in a block: entries at the cutoff in some list, resolved and held against the bound."""
    for frame in rows:
        for row in frame.itertuples(index=False):
            qi, ci, parts, own = _partials(row)
            bound = np.frombuffer(row.bound, np.int64)
            cutoff = np.where(bound == LEAST, -np.inf, np.floor_divide(bound, LISTS).astype(np.float64))
            reached = (parts.max(axis=0) >= cutoff[:, None]) & ~own
            at_q, at_c = np.nonzero(reached)
            score = parts[:, at_q, at_c].sum(axis=0).astype(np.int64)
            keep = score >= bound[at_q]
            at_q, at_c, score = at_q[keep], at_c[keep], score[keep]
            order = np.lexsort((ci[at_c], -score, at_q))  # ties to smaller ids; k of a block are enough
            at_q, at_c, score = at_q[order], at_c[order], score[order]
            first = np.searchsorted(at_q, at_q)
            near = np.arange(len(at_q)) - first < k
            yield pd.DataFrame({"query_id": qi[at_q[near]], "vec_id": ci[at_c[near]], "score": score[near]})


def top_k(rows: DataFrame, every: int = 20, k: int = 20, head: int = HEAD) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best candidates of each query, ties to smaller ids.

    Queries are the rows whose id is divisible by ``every``; a query's own id is no candidate. Shorter
    vectors are filled with zeros; rows of one id are each a candidate; an empty table gives no rows.
    """
    spark = rows.sparkSession
    vectors = write_out(whole_vectors(rows), "vectors")
    asked = vectors.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    sizes = vectors.agg(F.count(F.lit(1)).alias("n")).first().n, asked.count()
    shape = "query_id long, vec_id long, score long"
    if not sizes[1]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    cands = packed(vectors, "cb", CANDIDATES, sizes[0])
    asks = packed(asked, "qb", QUERIES, sizes[1])
    asks = asks.select("qb", *[F.col(c).alias(f"q_{c}") for c in ("ids", "matrix", "width", "top")])
    n_cb, n_qb = groups_for(sizes[0], CANDIDATES), groups_for(sizes[1], QUERIES)
    parts = max(partitions(spark), min(n_cb * n_qb, 4 * partitions(spark)))

    def met(left: DataFrame) -> DataFrame:
        """Each block of queries with each block of candidates: one row of two matrices."""
        every_cb = cands.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_qb - 1)))).repartition(parts, "qb", "cb")
        every_qb = left.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_cb - 1)))).repartition(parts, "qb", "cb")
        return every_cb.join(every_qb, ["qb", "cb"])

    heads = met(asks).mapInPandas(lambda it: _heads(it, k, head), "qb int, part int, scores binary")
    left = n_cb
    while True:  # blocks are merged FAN at a time, so no task reads more than that many lists of heads
        left = groups_for(left, FAN)
        heads = heads.withColumn("part", F.pmod("part", F.lit(left)).cast("int")).groupBy("qb", "part").applyInPandas(
            _merge_heads(k), "qb int, part int, scores binary")
        if left == 1:
            break

    def bounds(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in it:
            yield pd.DataFrame({"qb": f["qb"], "bound": [np.frombuffer(x, np.int64).reshape(-1, k)[:, k - 1].tobytes() for x in f["scores"]]})

    bound = write_out(heads.mapInPandas(bounds, "qb int, bound binary"), "bounds")
    found = met(asks.join(bound, "qb")).mapInPandas(lambda it: _collect(it, k), shape)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9(rows: DataFrame) -> DataFrame:
    return top_k(rows.select("vec_id", "embedding"))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""
