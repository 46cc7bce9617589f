import zlib

import numpy as np

from shillingflow.llm import sharding
from shillingflow.session import shared_dir

from .helpers import no_docs, odd_docs, odd_rows


def test_sizes_are_near_equal_and_places_gapless(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sharding.op4(docs).toPandas()
    load = got.groupby("shard")["size"].sum()
    assert len(load) == 40 and load.max() - load.min() < 0.03 * load.mean()
    assert (got.groupby("shard")["slot"].agg(lambda x: sorted(x) == list(range(len(x))))).all()
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert all(got.apply(lambda r: (r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id])), axis=1))
    again = sharding.op4(docs.repartition(3)).toPandas()
    assert got.sort_values("doc_id").drop(columns="grown_shard").values.tolist() == again.sort_values("doc_id").drop(columns="grown_shard").values.tolist()


def test_edits_move_only_what_they_must():
    sizes = np.random.default_rng(1).integers(0, 1000, 512).astype(float)
    first = sharding.SlotMap.even(7, 512)
    second = first.rebalanced(sizes)
    loads = np.bincount(second.shard_of, weights=sizes)
    assert second.version == 2 and np.ptp(loads) < 0.01 * loads.mean()
    third = second.grown(sizes)
    moved = [(a, b) for a, b in zip(second.shard_of, third.shard_of) if a != b]
    assert third.shards == 8 and moved and all(b == 7 for _, b in moved)
    assert np.ptp(np.bincount(third.shard_of, weights=sizes)) < 0.1 * loads.mean()


def test_maps_are_versions_of_a_table(spark):
    path = shared_dir(spark, "test-maps")
    docs = odd_docs(spark).selectExpr("*", "length(text) AS size")
    _, used = sharding.shard_documents(docs, 3, maps=path)
    assert sharding.SlotMap.load(spark, path, used.version) == used
    assert sharding.SlotMap.load(spark, path, 1) == sharding.SlotMap.even(3)


def test_odd_rows(spark):
    got = sharding.op4(odd_docs(spark, clash=True)).collect()
    assert len(got) == len(odd_rows()) and {r.law for r in got} == {"bytes"} and all(0 <= r.shard < 40 and r.grown_shard is None for r in got)
    assert sharding.op4(no_docs(spark)).collect() == []
    clash = odd_docs(spark, clash=True)
    kept, _ = sharding.shard_documents(clash, 2, size="n_chars")
    assert set(clash.columns) <= set(kept.columns) and {r._part for r in kept.collect()} == {"mine"}


def test_rows_without_a_key_are_spread(spark):
    docs = spark.range(2000).selectExpr("CAST(null AS long) AS doc_id", "id AS other", "1L AS size")
    got, _ = sharding.shard_documents(docs, 4)
    assert got.groupBy("shard").count().selectExpr("max(count) - min(count) AS d").first().d < 100
