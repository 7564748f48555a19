import pytest
from pyspark.sql import functions as F

from sentrylake.plans import fixtures
from sentrylake.session import scratch_path
from sentrylake.sources import keyed


def folders_read(rows):
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return plan.split("PartitionFilters: [", 1)[1].split("PushedFilters", 1)[0]


def test_lookup_by_id_opens_one_folder(spark, sf):
    ev = fixtures.events(spark, sf).drop("k", "seq")
    path = keyed.store_by_id(ev.where("user <> 'user_1'"), scratch_path(spark, "ids"))
    changed = ev.withColumn("status", F.lit("again"))
    keyed.store_by_id(changed, path)
    some = [r[0] for r in ev.select("event_id").limit(3).collect()]
    for event_id in some:
        found = keyed.read_keyed(spark, path, event_id=event_id)
        assert [(r.event_id, r.status) for r in found.collect()] == [(event_id, "again")]
        assert "key_folder" in folders_read(found) and "event_id" in found._jdf.queryExecution().executedPlan().toString()
    assert spark.read.parquet(path).count() == ev.count()
    assert keyed.read_keyed(spark, path, event_id="none").count() == 0


def test_lookup_by_user_with_days_and_nulls(spark, sf):
    ev = fixtures.events(spark, sf).drop("k", "seq").withColumn("user", F.nullif("user", F.lit("user_2")))
    ev = ev.withColumn("ts_ms", F.when(F.col("event_id") != "evt_000000000003", F.col("ts_ms")))
    path = keyed.store_by_user(ev.where("event_type = 'file_access'"), scratch_path(spark, "users"))
    for _ in range(2):  # bringing rows again changes nothing
        keyed.store_by_user(ev, path)
    assert spark.read.parquet(path).count() == ev.count()
    for user in (ev.where("user is not null").first()["user"], None):
        found = keyed.read_keyed(spark, path, user=user)
        want = ev.where(F.col("user").eqNullSafe(F.lit(user).cast("string")))
        assert sorted(r[0] for r in found.select("event_id").collect()) == sorted(r[0] for r in want.select("event_id").collect())
        assert "key_folder" in folders_read(found)


def test_other_columns_and_missing_tables_are_refused(spark, sf):
    path = keyed.store_by_user(fixtures.events(spark, sf).limit(20), scratch_path(spark, "users"))
    with pytest.raises(ValueError):
        keyed.read_keyed(spark, path, event_id="x")
    with pytest.raises(FileNotFoundError):
        keyed.read_keyed(spark, path + "-none", user="x")
