"""The queries of the operators, each over its whole table, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import codes, decontamination, huffman, minhash, mixing, packing, quality, quotes, repair, sharding, suffixes, topk, urls
from .common import table


def _over(name: str, op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: op(table(spark, folder, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": _over("documents", minhash.op1),
    "op2_squares_packing": _over("documents", packing.op2),
    "op3_kneser_ney": _over("documents", quality.op3),
    "op4_virtual_slots": _over("documents", sharding.op4),
    "op5_huffman_ids": _over("documents", huffman.op5),
    "op6_entropy_balance": _over("documents", mixing.op6),
    "op7_url_trees": _over("pages", urls.op7),
    "op8_suffix_merge": _over("documents", suffixes.op8),
    "op9_threshold_topk": _over("embeddings", topk.op9),
    "op10_quote_links": _over("conversations", quotes.op10),
    "op11_norm_sum_codes": _over("embeddings", codes.op11),
    "op12_aho_corasick": lambda spark, folder: decontamination.op12(table(spark, folder, "documents"), table(spark, folder, "benchmark")),
    "op13_lightest_repair": _over("conversations", repair.op13),
}
SQL: dict[str, str] = {
    "op9_threshold_topk": topk.OP9_SQL,
    "op11_norm_sum_codes": codes.OP11_SQL,
    "op12_aho_corasick": decontamination.OP12_SQL,
}
