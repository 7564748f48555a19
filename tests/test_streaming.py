import datetime as dt
import random

from pyspark.sql import functions as F

from sentrylake.operators.baseline import accepted_events, baseline_anomaly_detector, baseline_snapshot
from sentrylake.plans import fixtures
from sentrylake.plans.catalog import _run_stream
from sentrylake.session import materialize, scratch_path
from sentrylake.sources import writers
from sentrylake.streaming import jobs


def arriving(spark, *batches):
    """A stream whose micro-batches are the given tables."""
    path = scratch_path(spark, "arriving")
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def halves(spark, sf):
    ev = fixtures.events(spark, sf)
    middle = ev.agg(F.percentile("ts_ms", F.lit(0.5))).first()[0]
    return ev.where(F.col("ts_ms") < middle), ev.where(F.col("ts_ms") >= middle)


def test_state_carries_over_micro_batches(spark, sf):
    streamed = _run_stream(jobs.baseline_stream(arriving(spark, *halves(spark, sf)), 20, 0.7))
    batch = baseline_anomaly_detector(fixtures.events(spark, sf), 20, 0.7)
    assert streamed.count() == batch.count() > 0
    assert streamed.select(batch.columns).exceptAll(batch).isEmpty()


def test_stream_goes_on_from_a_snapshot(spark, sf):
    first, second = halves(spark, sf)
    start = materialize(baseline_snapshot(accepted_events(first, 20, 0.7)), "snapshot")
    # Later micro-batches and users without a snapshot start from what the stream has learned.
    middle = second.agg(F.percentile("ts_ms", F.lit(0.5))).first()[0]
    parts = second.where(F.col("ts_ms") < middle), second.where(F.col("ts_ms") >= middle)
    streamed = _run_stream(jobs.baseline_stream(arriving(spark, *parts), 20, 0.7, start))
    batch = baseline_anomaly_detector(first.unionByName(second), 20, 0.7).join(second.select("event_id"), "event_id", "left_semi")
    assert streamed.count() == batch.count() > 0
    assert streamed.select(batch.columns).exceptAll(batch).isEmpty()


def test_share_of_a_user_in_several_frames(spark, sf):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        ev = fixtures.events(spark, sf).withColumn("user", F.lit("only"))
        batch = baseline_anomaly_detector(ev, 20, 0.6)
        streamed = _run_stream(jobs.baseline_stream(arriving(spark, ev.orderBy(F.rand(1))), 20, 0.6))
        scored = _run_stream(jobs.score_stream(arriving(spark, ev), 20, 0.6))
        assert streamed.count() == batch.count() > 0
        assert streamed.select(batch.columns).exceptAll(batch).isEmpty()
        assert scored.count() == ev.count() and scored.where("anomaly_score is not null").count() == batch.count()
    finally:
        spark.conf.set(name, before)


def test_job_writes_all_tables_once(spark, sf):
    first, second = halves(spark, sf)
    path = scratch_path(spark, "job")
    # The second half arrives twice; later copies replace earlier ones.
    stream = arriving(spark, first, second, second)
    job = jobs.event_pipeline_stream(stream, path, scratch_path(spark, "progress"), 20, 0.7, available_now=True)
    job.awaitTermination()
    assert spark.read.parquet(f"{path}/events").count() == 1000 + second.count()
    assert jobs.read_latest(spark, f"{path}/events", writers.EVENT_KEY).count() == 1000
    found = jobs.read_latest(spark, f"{path}/anomalies", writers.ANOMALY_KEY)
    expected = baseline_anomaly_detector(first.unionByName(second), 20, 0.7)
    assert expected.select("event_id").exceptAll(found.select("event_id")).isEmpty()
    chosen = spark.read.parquet(f"{path}/to_analyse")
    assert chosen.where("threat_score < 0.7 and not is_anomalous").isEmpty()
    assert spark.read.parquet(f"{path}/counters").agg(F.sum("processed")).first()[0] == 1000 + second.count()


def test_copies_in_different_micro_batches_are_dropped(spark, sf):
    first, _ = halves(spark, sf)
    rows = first.select("event_id", "ts")
    near = rows.where(F.col("ts") >= rows.agg(F.max("ts")).first()[0] - F.expr("interval 5 minutes"))
    assert _run_stream(jobs.stream_dedup(arriving(spark, near, near))).count() == near.count() > 0


def test_sliding_stream_agrees_on_counts(spark, sf):
    ev = fixtures.events(spark, sf)
    end = ev.limit(1).withColumns({"ts": F.lit("2025-01-01").cast("timestamp"), "user": F.lit("end")})
    rows = ["ts", "user", "source_ip", "event_type", "threat_score", "status"]
    streamed = _run_stream(jobs.sliding_feature_stream(arriving(spark, ev.select(rows), end.select(rows))))
    exact = jobs.sliding_features(ev)
    key = ["window_start_ms", "user", "total_events", "failed_events", "unusual_hour_events"]
    assert streamed.where("user <> 'end'").select(key).exceptAll(exact.select(key)).isEmpty()
    assert streamed.where("user <> 'end'").count() == exact.count()


def test_sliding_stream_sends_an_event_once_to_a_group_of_windows(spark):
    rng, rows = random.Random(7), []
    for _ in range(300):
        ts = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=rng.choice([0, 1, 5, 9, 30, 31, 80]), minutes=rng.randint(0, 300))
        ip, kind = rng.choice([None, "a", "b", "c"]), rng.choice([None, "x", "y"])
        rows.append((rng.choice(["u", "v", None]), ts, ip, kind, rng.choice([None, 0.25, 0.5]), rng.choice(["failed", "success", None])))
    events = spark.createDataFrame(rows, "user string, ts timestamp, source_ip string, event_type string, threat_score double, status string")
    for size, slide in ((24, 1), (6, 1), (24, 2), (1, 1)):
        exact = jobs.sliding_features(events, size, slide)
        got = jobs.sliding_feature_stream(events, f"{size} hours", f"{slide} hours").select(exact.columns)
        assert got.count() == exact.count() and got.exceptAll(exact).isEmpty()
    plan = jobs.sliding_feature_stream(events)._jdf.queryExecution().optimizedPlan().toString()
    expand = next(line for line in plan.splitlines() if "Expand" in line)
    assert expand.count("], [") + 1 <= 6


def test_sliding_features_take_more_tasks_for_more_events(spark, sf, monkeypatch):
    ev = fixtures.events(spark, sf)
    expected = jobs.sliding_features(ev)
    monkeypatch.setattr(jobs, "SLIDING_BYTES", 1000)
    got = jobs.sliding_features(ev)
    assert got.rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    assert got.count() == expected.count()
    assert got.drop("avg_threat_score").exceptAll(expected.drop("avg_threat_score")).isEmpty()


def test_late_events_are_set_aside(spark, sf):
    first, second = halves(spark, sf)
    out = scratch_path(spark, "late")
    jobs.late_data(arriving(spark, second, first), out, scratch_path(spark, "progress"), available_now=True).awaitTermination()
    late, on_time = (spark.read.parquet(f"{out}/{t}").count() for t in ("late", "on_time"))
    assert late == first.count() and on_time == second.count()


def test_sliding_windows_by_hand(spark):
    """Gaps longer and shorter than a window, one value in several panes, nulls, and windows of other sizes."""
    rng, rows = random.Random(6), []
    for i in range(400):
        hour = rng.choice([0, 1, 2, 5, 9, 30, 31, 80]) + rng.randint(0, 3)
        ts = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc) + dt.timedelta(hours=hour, minutes=rng.randint(0, 59))
        ip, kind = rng.choice([None, "a", "b", "c"]), rng.choice([None, "x", "y"])
        rows.append((rng.choice(["u", "v", None]), ts, ip, kind, rng.choice([None, 0.25, 0.5]), rng.choice(["failed", "success", None])))
    events = spark.createDataFrame(rows, "user string, ts timestamp, source_ip string, event_type string, threat_score double, status string")
    for size, slide in ((6, 1), (24, 2), (1, 1)):
        want = {}
        for user, ts, ip, kind, score, status in rows:
            pane = int(ts.timestamp()) // 3600 // slide
            for first in range(pane - size // slide + 1, pane + 1):
                want.setdefault((first * slide * 3_600_000, user), []).append((ip, kind, score, status == "failed", ts.hour <= 6))
        expected = {}
        for key, found in want.items():
            ips, kinds, scores, failed, unusual = zip(*found, strict=True)
            known = [x for x in scores if x is not None]
            mean = round(sum(known) / len(known), 9) if known else None
            expected[key] = (len(found), len(set(ips) - {None}), len(set(kinds) - {None}), mean, max(known, default=None), sum(failed), sum(unusual))
        got = jobs.sliding_features(events, size, slide).collect()
        assert len(got) == len(expected)
        for r in got:
            mean = None if r["avg_threat_score"] is None else round(r["avg_threat_score"], 9)
            found = (r["total_events"], r["unique_ips"], r["unique_event_types"], mean, r["max_threat_score"], r["failed_events"], r["unusual_hour_events"])
            assert expected[r["window_start_ms"], r["user"]] == found


def test_a_user_with_few_values_has_one_row_of_state(spark, sf, monkeypatch):
    """One read and one write of state for a user's micro-batch, entries only beyond; both give the detector's results."""
    calls = {"values": 0, "entries": 0}

    class Value:
        held = None

        def get(self):
            calls["values"] += 1
            return self.held

        def update(self, row):
            calls["values"] += 1
            self.held = row

    class Entries(dict):
        def getValue(self, key):
            calls["entries"] += 1
            return self.get(key)

        def updateValue(self, key, row):
            calls["entries"] += 1
            self[key] = row

    facts = fixtures.events(spark, sf).where("user = 'user_3'").withColumns({"hour": F.hour("ts"), "failed": F.col("status") == "failed"})
    rows = facts.orderBy("ts_ms", "event_id").select("user", F.to_json(F.struct("*")).alias("event")).collect()
    found = {}
    for few in (256, 2):
        monkeypatch.setattr(jobs, "FEW_VALUES", few)
        job = jobs._BaselineProcessor(20, 0.7, True)
        job.totals, job.counts = Value(), Entries()
        out = [r for at in range(0, len(rows), 10) for r in job.handleInputRows(("user_3",), iter(rows[at : at + 10]), None)]
        found[few] = sorted((r["event"], r["anomaly_score"]) for r in out)
        if few == 256:
            assert calls == {"values": 2 * -(-len(rows) // 10), "entries": 0}
    assert found[256] == found[2] and len(found[2]) > 0 and calls["entries"] > 0


def test_snapshot_of_many_values_comes_in_rows(spark, sf, monkeypatch):
    monkeypatch.setattr(jobs, "START_VALUES", 3)
    first, second = halves(spark, sf)
    start = materialize(baseline_snapshot(accepted_events(first, 20, 0.7)), "snapshot")
    assert jobs._packed(start).count() > start.select("user").distinct().count()
    streamed = _run_stream(jobs.baseline_stream(arriving(spark, second), 20, 0.7, start))
    batch = baseline_anomaly_detector(first.unionByName(second), 20, 0.7).join(second.select("event_id"), "event_id", "left_semi")
    assert streamed.count() == batch.count() > 0
    assert streamed.select(batch.columns).exceptAll(batch).isEmpty()
