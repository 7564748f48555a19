import numpy as np
from pyspark.sql import functions as F

from sentrylake.operators.skew import attach_by_key, exact_quantile, sample_std
from sentrylake.session import size_shuffles


def test_heavy_keys_are_split_and_no_row_is_lost(spark):
    # Half of the rows have one key, a sixth have none.
    rows = spark.range(6000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 != 0, F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
    )
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"))
    joined = attach_by_key(rows, sizes, ["key"], "n", spread="event_id", how="left", shares=10, min_split_rows=100)
    expected = {r.key: r.n for r in sizes.collect()}
    found = joined.collect()
    assert len(found) == 6000 and len({r.event_id for r in found}) == 6000
    assert all(r.n == expected[r.key] for r in found)
    assert expected["hot"] == 3000 and expected[None] == 1000


def test_split_plan_spreads_the_heavy_key(spark):
    rows = spark.range(4000).select(F.col("id").alias("event_id"), F.lit("hot").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach_by_key(rows, sizes, ["key"], "n", spread="event_id", shares=100, min_split_rows=10)
        tasks = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 1 and sum(t["count"] for t in tasks) == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_exact_quantile_narrows_to_the_exact_value(spark):
    rng = np.random.default_rng(7)
    data = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.exponential(50, 500)])
    df = spark.createDataFrame([(float(x),) for x in data], "v double")
    for q in (0.0, 0.1, 0.5, 0.617, 0.9, 0.999, 1.0):
        assert np.isclose(exact_quantile(df, "v", q, small=20, buckets=13), np.quantile(data, q), atol=1e-9)
        assert np.isclose(exact_quantile(df, "v", q), np.quantile(data, q), atol=1e-9)


def test_sample_std_does_not_cancel(spark):
    data = [10**9, 10**9 + 1, 10**9 + 2, 10**9 + 2]
    df = spark.createDataFrame([(x,) for x in data], "v bigint")
    whole = F.col("v").cast("decimal(20,0)")
    got = df.agg(sample_std(F.count("v"), F.sum(whole).cast("decimal(30,0)"), F.sum(whole * whole))).first()[0]
    assert np.isclose(got, np.std(data, ddof=1), atol=1e-12)
    assert df.limit(1).agg(sample_std(F.count("v"), F.sum(whole).cast("decimal(30,0)"), F.sum(whole * whole))).first()[0] is None


def test_shuffle_sizing(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 0) == spark.sparkContext.defaultParallelism
        assert size_shuffles(spark, 100 << 40) == 819_200
        assert spark.conf.get("spark.sql.shuffle.partitions") == "819200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
