"""Crowded keys must give the same rows as the plain plans."""

from pyspark.sql import functions as F

from shillingflow.operators import dashboards, staging
from shillingflow.plans.skew import exact_quantiles, profile_join, top_rows, trailing_counts
from shillingflow.session import sizing


def skewed_tx(spark, n=4000):
    """One customer holds half of the rows, and a third of those share one instant."""
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("T"), i.cast("string")).alias("transaction_id"),
        F.when(i % 2 == 0, "hot").otherwise((i % 50).cast("string")).alias("customer_phone_number"),
        F.when(i % 3 == 0, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        .when(i % 41 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 37 % 20000)"))
        .alias("transaction_timestamp"),
        F.lit("2024-02-01").cast("timestamp_ntz").alias("loaded_at"),
        (i * 7919 % 1000).cast("double").alias("amount"),
    )


def test_sequence_splits_crowded_customer(spark):
    tx = skewed_tx(spark)
    plain = staging.with_sequence(tx)
    for limit in (5, 100, 900):
        split = staging.with_sequence(tx, hot_rows=limit)
        assert split.count() == tx.count()
        assert split.exceptAll(plain.select(split.columns)).isEmpty()


def test_sequence_splits_a_crowded_null_key(spark):
    tx = skewed_tx(spark).withColumn("customer_phone_number", F.expr("nullif(customer_phone_number, 'hot')"))
    plain = staging.with_sequence(tx)
    split = staging.with_sequence(tx, hot_rows=50)
    assert split.count() == tx.count() and split.exceptAll(plain.select(split.columns)).isEmpty()
    # no window task holds the null key: its rows are numbered in pieces
    plan = split._jdf.queryExecution().toString()
    assert "_piece0" in plan


def test_null_keys_are_spread_and_find_no_profile(spark):
    tx = skewed_tx(spark).withColumn("customer_phone_number", F.expr("nullif(customer_phone_number, 'hot')"))
    profile = tx.groupBy("customer_phone_number").agg(F.count("*").alias("n"))
    got = profile_join(tx, profile, ["customer_phone_number"], "n", "transaction_id", hot_rows=60)
    assert got.filter("customer_phone_number is null and n is not null").isEmpty() and got.count() == tx.count()


def test_profile_join_matches_plain_join(spark):
    tx = skewed_tx(spark)
    profile = tx.groupBy("customer_phone_number").agg(F.count("*").alias("n"), F.sum("amount").alias("total"))
    want = tx.join(profile, "customer_phone_number", "left").select(*tx.columns, "n", "total")
    got = profile_join(tx, profile, ["customer_phone_number"], "n", "transaction_id", hot_rows=60)
    assert got.count() == tx.count()
    assert got.exceptAll(want).isEmpty()


def test_trailing_counts_match_brute_force(spark):
    tx = skewed_tx(spark, 600).filter("transaction_timestamp is not null")
    got = {
        (r[0], r[1]): (r.rows_at, r.recent)
        for r in trailing_counts(tx, ["customer_phone_number"], "transaction_timestamp", 60, "recent").collect()
    }
    rows = [(r[1], r[2]) for r in tx.collect()]
    for phone, at in set(rows):
        near = [t for p, t in rows if p == phone and 0 <= (at - t).total_seconds() < 60]
        assert got[(phone, at)] == (near.count(at), len(near))
    assert len(got) == len(set(rows))


def test_quantiles_match_percentile(spark):
    tx = skewed_tx(spark).withColumn("v", F.expr("case when amount < 300 then -amount else amount * amount end"))
    probs = {"p0": 0.0, "p05": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    exact = exact_quantiles(tx, "v", probs, by=["customer_phone_number"])
    plain = tx.groupBy("customer_phone_number").agg(
        *[F.percentile("v", F.lit(p)).alias(n) for n, p in probs.items()]
    )
    got = {r[0]: [round(x, 6) for x in r[1:]] for r in exact.collect()}
    assert got == {r[0]: [round(x, 6) for x in r[1:]] for r in plain.collect()}
    whole = exact_quantiles(tx, "v", {"m": 0.5}).first().m
    assert round(whole, 6) == round(tx.agg(F.percentile("v", F.lit(0.5))).first()[0], 6)


def test_crowded_sequence_uses_pieces(spark):
    plan = staging.with_sequence(skewed_tx(spark), hot_rows=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "_piece2" in plan


def test_profile_join_shuffles_on_the_salt(spark):
    tx = skewed_tx(spark)
    profile = tx.groupBy("customer_phone_number").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = profile_join(tx, profile, ["customer_phone_number"], "n", "transaction_id", hot_rows=60)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sides = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_salt" in line]
    assert len(sides) == 2


def test_top_rows(spark):
    tx = skewed_tx(spark)
    want = [r.transaction_id for r in tx.orderBy(F.desc("amount"), "transaction_id").limit(700).collect()]
    assert [r.transaction_id for r in top_rows(tx, "amount", ["transaction_id"], 700).collect()] == want


def test_recent_rows_keep_their_number_in_the_whole_history(spark):
    tx = skewed_tx(spark).select(
        "transaction_id", "customer_phone_number", "transaction_timestamp", "loaded_at",
        F.lit(None).cast("string").alias("account_reference"), F.to_date("transaction_timestamp").alias("transaction_date"),
    )
    as_of = F.lit("2024-01-01 05:00:00").cast("timestamp_ntz")
    want = dashboards.recent(staging.with_sequence(tx), as_of, 2, "HOURS")
    for limit in (30, 10**6):
        got = dashboards.recent_sequenced(tx, as_of, 2, "HOURS", hot_rows=limit)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want.select(got.columns)).isEmpty()


def test_sizing_grows_with_the_data():
    small, large = sizing(1 << 20, 8), sizing(100 << 40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(large["spark.sql.shuffle.partitions"]) == 200_000
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 512 << 20
