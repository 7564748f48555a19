import json

import pytest

from pyspark.sql import functions as F

from sentrylake.session import scratch_path
from sentrylake.sources import parse, readers, writers
from tests.conftest import make_event

GOOD = {
    "event_id": "evt_00ff17aa2b3c", "timestamp": 1717243200123, "event_type": "auth_attempt", "source_ip": "10.20.0.7",
    "destination_ip": "10.9.8.7", "user": "pat", "status": "success", "threat_score": 0.31,
    "metadata": {"user_agent": "client/7", "geo_location": "north-pier", "port": 8022},
}


def parsed(spark, *payloads):
    texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    return parse.parse_event_json(spark.createDataFrame([(t,) for t in texts], "value string")).collect()


def test_good_payloads(spark):
    full, bare = parsed(spark, GOOD, {k: v for k, v in GOOD.items() if k not in ("status", "destination_ip", "metadata")})
    assert full.error is None and full.metadata.port == 8022 and full.ts_ms == 1717243200123
    assert bare.error is None and bare.status == "success" and bare.destination_ip is None


def test_bad_payloads_are_put_aside_with_a_reason(spark):
    rows = parsed(
        spark, "{not json", {**GOOD, "event_type": "login"}, {**GOOD, "status": "odd"}, {**GOOD, "user": None},
        {**GOOD, "timestamp": "1717243200123"}, {**GOOD, "status": None},
    )
    assert [r.error for r in rows] == [
        "malformed", "unknown event_type", "unknown status", "missing user", "malformed", None,
    ]
    assert rows[0].rejected_value == "{not json" and rows[0].event_id is None and rows[5].status == "success"


def test_details_follow_the_type(spark):
    dns = {**GOOD, "event_type": "dns_query", "dns_details": {"query_name": "x.example", "resolved_ips": ["1.2.3.4"]}, "auth_details": {"auth_type": "mfa"}}
    (row,) = parse.parse_typed_details(spark.createDataFrame([(json.dumps(dns),)], "value string")).collect()
    assert row.dns_details.resolved_ips == ["1.2.3.4"] and row.auth_details is None


def test_serialized_payload_leaves_out_what_is_empty(spark, events_of):
    ev = events_of([make_event(0, geo=""), make_event(1)]).withColumn("port", F.lit(0))
    plain, placed = [json.loads(r[0]) for r in ev.orderBy("ts").select(parse.serialize_event_json(ev.columns)).collect()]
    assert "metadata" not in plain and "destination_ip" not in plain
    assert placed["metadata"] == {"geo_location": "harbour"}
    tagged = ev.withColumn("extra", F.create_map(F.lit("team"), F.lit("blue")))
    custom = [json.loads(r[0]) for r in tagged.orderBy("ts").select(parse.serialize_event_json(tagged.columns, "extra")).collect()]
    assert custom[0]["metadata"] == {"team": "blue"}
    assert custom[1]["metadata"] == {"geo_location": "harbour", "team": "blue"}


def test_validation_rules(spark, events_of):
    good = events_of([make_event(0)]).withColumn("event_id", F.lit("evt_a1b2c3d4e5f6"))
    odd = good.withColumns({"event_id": F.lit("bad_id"), "ts_ms": F.lit(5).cast("bigint"), "threat_score": F.lit(1.5)})
    octets = good.withColumn("source_ip", F.lit("999.999.999.999"))
    rows = parse.validate_events(good.unionByName(odd).unionByName(octets)).collect()
    assert [r.is_valid for r in rows] == [True, False, True]
    assert rows[1].problems == ["event_id format", "timestamp range", "threat_score range"]


def test_bounded_read_offsets(spark):
    marks = spark.createDataFrame([(0, 10, 500), (1, 0, 20)], "partition int, low bigint, high bigint")
    assert json.loads(readers.bounded_read(marks, "earliest", 100, "t")) == {"t": {"0": 60, "1": 20}}
    assert json.loads(readers.bounded_read(marks, "latest", 100, "t")) == {"t": {"0": 500, "1": 20}}
    assert json.loads(readers.bounded_read(marks, "earliest", 1, "t")) == {"t": {"0": 11, "1": 1}}
    assert readers.bounded_read(marks.limit(0)) is None


def test_upsert_keeps_the_last_of_many_copies(spark, events_of):
    copies = events_of([make_event(0)]).crossJoin(spark.range(5000).withColumnRenamed("id", "arrival"))
    rows = copies.withColumn("threat_score", F.col("arrival") / 5000).unionByName(
        events_of([make_event(1)]).withColumn("arrival", F.lit(0).cast("bigint"))
    )
    path = writers.upsert_events(rows, scratch_path(spark, "upsert"), "arrival")
    stored = spark.read.parquet(path).orderBy("ts").collect()
    assert [r.threat_score for r in stored] == [4999 / 5000, 0.1]
    assert [str(r.event_date) for r in stored] == ["2024-01-01", "2024-01-02"]
    plan = writers.latest_per_key(rows, writers.EVENT_KEY, "arrival")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_missing_results_are_empty(spark):
    nowhere = scratch_path(spark, "nowhere")
    assert readers.read_batch_anomalies(spark, nowhere).count() == 0
    assert readers.read_anomaly_report(spark, nowhere).count() == 0


def test_type_and_day_filters_prune_partitions(spark, events_of):
    path = writers.upsert_events(events_of([make_event(i) for i in range(5)]), scratch_path(spark, "pruned"), "ts_ms")
    found = spark.read.parquet(path).where("event_type = 'auth_attempt' and event_date >= '2024-01-03'")
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_type" in plan


def test_latest_starts_at_the_end(spark):
    path = scratch_path(spark, "topic")
    records = [(f"k{i}", json.dumps({**GOOD, "event_id": f"evt_{i:012d}"}), "t", i % 2, i // 2, None) for i in range(5)]
    spark.createDataFrame(records, "key string, value string, topic string, partition int, offset bigint, timestamp timestamp").write.parquet(path)
    topic = readers.Topic(name="t", format="parquet", path=path)
    for most in (None, 2):
        assert readers.read_events_batch(spark, topic, "latest", max_events=most).count() == 0
    assert readers.read_events_batch(spark, topic, "earliest").count() == 5
    assert readers.read_events_batch(spark, topic, "earliest", max_events=2).count() == 2


def test_writes_merge_into_the_stored_table(spark, events_of):
    path = scratch_path(spark, "merged")
    first = events_of([make_event(i, score=0.1) for i in range(6)])
    writers.upsert_events(first, path, "ts_ms")
    # One known key, one new event of a known day, one new day; the other days stay.
    again = events_of([make_event(2, score=0.9), make_event(3, user="bob", score=0.5), make_event(40, score=0.2)])
    writers.upsert_events(again, path, "ts_ms")
    stored = {(r.user, r.ts_ms): r.threat_score for r in spark.read.parquet(path).collect()}
    assert len(stored) == 8 and stored["alice", make_event(2)[2]] == 0.9 and stored["alice", make_event(0)[2]] == 0.1
    cut_off = make_event(3)[2]
    assert writers.delete_expired(spark, path, cut_off + 1) == 5
    assert sorted(r.ts_ms for r in spark.read.parquet(path).collect()) == [make_event(i)[2] for i in (4, 5, 40)]
    assert writers.delete_expired(spark, path, cut_off + 1) == 0


def test_merges_keep_stored_rows_without_type_or_time(spark, events_of):
    def of(i, kind="auth_attempt", timed=True, score=0.1):
        row = list(make_event(i, kind=kind, score=score))
        return tuple(row if timed else [row[0], None, None, *row[3:]])

    first = [of(0), of(1, kind=None), of(2, kind=""), of(3, timed=False), of(4, kind=None, timed=False)]
    # Known keys with a null come again, beside a new event of each of their folders.
    again = [of(1, kind=None, score=0.9), of(3, timed=False, score=0.8), of(4, kind=None, timed=False, score=0.7)]
    again += [of(5, timed=False), of(6, kind=None, timed=False), ("evt_other", *of(2, kind="")[1:])]
    for write, want in ((writers.upsert_events, 8), (writers.write_anomalies, 8)):
        path = scratch_path(spark, "nulls")
        write(events_of(first), path, "threat_score")
        write(events_of(again), path, "threat_score")
        rows = spark.read.parquet(path).collect()
        stored = {r.event_id: r.threat_score for r in rows}
        assert len(rows) == len(stored) == want
        assert [stored[of(i)[0]] for i in range(7)] == [0.1, 0.9, 0.1, 0.8, 0.7, 0.1, 0.1]


def test_merge_keeps_columns_and_refuses_other_types(spark, events_of):
    path = scratch_path(spark, "columns")
    first = events_of([make_event(i) for i in range(6)]).withColumn("note", F.lit("kept"))
    writers.upsert_events(first, path)
    writers.upsert_events(events_of([make_event(i, score=0.9) for i in range(4, 8)]).withColumn("extra", F.lit(1)), path)
    rows = {r["event_id"]: (r["note"], r["extra"], r["threat_score"]) for r in writers.read_stored(spark, path).collect()}
    assert len(rows) == 8 and sorted(rows.values(), key=repr) == sorted([("kept", None, 0.1)] * 4 + [(None, 1, 0.9)] * 4, key=repr)
    with pytest.raises(ValueError, match="threat_score"):
        writers.upsert_events(events_of([make_event(9)]).withColumn("threat_score", F.lit("high")), path)
    assert writers.read_stored(spark, path).count() == 8


@pytest.mark.parametrize("broken_at", ["before", "half way"])
def test_broken_off_changes_are_taken_up_again(spark, events_of, monkeypatch, broken_at):
    path, real = scratch_path(spark, "broken"), writers._write
    writers.upsert_events(events_of([make_event(i) for i in range(6)]), path, "ts_ms")

    def broken(rows, at, *partitions, **options):
        if broken_at == "half way":
            files, folder = writers._files(spark, at)
            for status in files.globStatus(writers._files(spark, f"{at}/event_type=*/event_date=2024-01-0[56]")[1]):
                files.delete(status.getPath(), True)
        raise RuntimeError("lost")

    monkeypatch.setattr(writers, "_write", broken)
    with pytest.raises(RuntimeError):
        writers.upsert_events(events_of([make_event(i, score=0.9) for i in range(4, 8)]), path, "ts_ms")
    monkeypatch.setattr(writers, "_write", real)
    rows = {r["event_id"]: r["threat_score"] for r in writers.read_stored(spark, path).collect()}
    assert sorted(rows.values()) == [0.1] * 4 + [0.9] * 4
    cut_off = make_event(3)[2]
    monkeypatch.setattr(writers, "remove_path", lambda spark, at: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        writers.delete_expired(spark, path, cut_off)
    monkeypatch.undo()
    assert writers.read_stored(spark, path).count() == 5
    assert writers.delete_expired(spark, path, cut_off) == 0


def test_folders_follow_the_table(spark, monkeypatch):
    monkeypatch.setattr(writers, "FOLDER_ROWS", 10)
    path = scratch_path(spark, "folders")
    rows = spark.range(2000).selectExpr("cast(id as string) AS event_id", "id AS confidence")
    for low, high, folders in ((0, 100, 16), (50, 400, 64), (390, 2000, 256), (7, 8, 256)):
        writers.write_analyses(rows.where(f"confidence >= {low} AND confidence < {high}").withColumn("round", F.lit(low)), path)
        stored = writers.read_stored(spark, path)
        assert stored.count() == stored.select("event_id").distinct().count() == max(high, stored.count())
        assert stored.agg(F.max("key_folder")).first()[0] < folders
    assert {r["round"]: r["count"] for r in stored.groupBy("round").count().collect()} == {0: 49, 50: 340, 390: 1610, 7: 1}
    assert stored.select("key_folder").distinct().count() > 200


def test_time_map_bounds_the_read(spark, monkeypatch):
    monkeypatch.setattr(readers, "ZONE_RECORDS", 10)
    path, times = scratch_path(spark, "topic"), scratch_path(spark, "times")
    topic = readers.Topic(format="parquet", path=path)
    start = 1_717_200_000_000

    def put(rows):
        payload = lambda i, ms: json.dumps({**GOOD, "event_id": f"evt_{i:012d}", "timestamp": ms})
        table = [(str(i), payload(i, ms), "security-events", i % 2, i // 2, None) for i, ms in rows]
        spark.createDataFrame(table, readers.RECORD_SCHEMA).write.mode("append").parquet(path)

    def found(low, high):
        rows = readers.read_time_range(spark, topic, low, high, times)
        return sorted(r["event_id"] for r in rows.collect()), rows

    # One event a minute, and one that came very late.
    put([(i, start + 60_000 * i) for i in range(400)])
    ids, rows = found("2024-06-01T01:00:00", "2024-06-01T01:30:00")
    assert ids == [f"evt_{i:012d}" for i in range(60, 91)]
    read = readers.read_records(spark, topic, *readers.offsets_between(spark.read.parquet(times), topic.name, start + 3_600_000, start + 5_400_000)).count()
    assert 31 <= read <= 60
    plan = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(offset" in plan.split("PushedFilters", 1)[1].split("\n")[0]
    put([(i, start + 60_000 * (i if i != 450 else 70)) for i in range(400, 500)])
    ids, _ = found("2024-06-01T01:00:00", "2024-06-01T01:30:00")
    assert ids == [f"evt_{i:012d}" for i in [*range(60, 91), 450]]
    assert found("2024-06-01T07:00:00", None)[0] == [f"evt_{i:012d}" for i in range(420, 500) if i != 450]
    assert found("2030-06-01T07:00:00", None)[0] == []
    zones = spark.read.parquet(times)
    assert zones.agg(F.sum(F.col("high") - F.col("low"))).first()[0] == 500
