"""Every operator as a named query over the given tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.functions import scalar, text
from sentrylake.operators import (
    baseline,
    context,
    detectors,
    features,
    lookups,
    metrics,
    similarity,
    summary,
)
from sentrylake.plans import fixtures, training
from sentrylake.plans import oracle as o
from sentrylake.session import materialize, scratch_path
from sentrylake.sources import intel_index, keyed, parse, readers, vector_index, writers
from sentrylake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

LEARN, CUT = o.LEARN, o.CUT
USER = "user_3"
EVENT, ANALYSED, ANOMALOUS = "evt_000000000042", "evt_000000000009", "evt_000000002166"
TYPE = "auth_attempt"
# 10 to 20 January 2024.
START_MS, END_MS = 1_704_844_800_000, 1_705_708_800_000
QUESTION = "account review and security report for the system"


# What is stored once for an application and read by several queries.
_STORED: dict[tuple, object] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, places: int = 9, **other: int) -> DataFrame:
    """Doubles rounded, so that the order of a sum does not show."""
    return df.select(
        *[
            F.round(f.name, other.get(f.name, places)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
            for f in df.schema
        ]
    )


EVENT_FIELDS = ["event_id", "user", "ts_ms", "event_type", "source_ip", "status", "threat_score"]
E = 'event_id, "user", ts_ms, event_type, source_ip, status, round(threat_score, 9) AS threat_score'
A = (
    'event_id, "user", ts_ms, round(anomaly_score, 9) AS anomaly_score, round(time_anomaly, 9) AS time_anomaly, '
    "round(ip_anomaly, 9) AS ip_anomaly, round(location_anomaly, 9) AS location_anomaly, "
    "round(type_anomaly, 9) AS type_anomaly, round(failure_anomaly, 9) AS failure_anomaly, reasons"
)
L = "event_id, severity, attack_type, description, recommendations, round(confidence, 9) AS confidence, ts_s"
B = (
    '"user", round(anomaly_score_normalized, 9) AS anomaly_score_normalized, total_events, '
    "round(avg_threat_score, 9) AS avg_threat_score, unique_ips, round(failed_auth_rate, 9) AS failed_auth_rate, is_anomaly"
)


def _events(df: DataFrame) -> DataFrame:
    return rounded(df.select(*EVENT_FIELDS))


def _joined(df: DataFrame, *arrays: str, sep: str = "; ") -> DataFrame:
    return rounded(df.withColumns({a: F.array_join(a, sep) for a in arrays}))


def _anomalies(spark: SparkSession, d: str) -> DataFrame:
    return baseline.frozen_baseline_detector(fixtures.events(spark, d), LEARN, CUT)


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    """Users labelled by a plain rule over their features."""
    users = features.user_features(fixtures.events(spark, d))
    raw = users.withColumn("raw_score", F.col("avg_threat_score") + F.col("failed_auth_rate"))
    scaled = detectors.minmax_normalise(raw, "raw_score", "anomaly_score_normalized")
    return scaled.withColumn("is_anomaly", (F.col("anomaly_score_normalized") > 0.8).cast("int"))


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d).where("is_anomaly = 1")


def _batch(df: DataFrame) -> DataFrame:
    return rounded(
        df.select(
            "user", "anomaly_score_normalized", "total_events", "avg_threat_score", "unique_ips", "failed_auth_rate",
            F.col("is_anomaly").cast("int").alias("is_anomaly"),
        )
    )


def _stored_topic(spark: SparkSession, d: str) -> readers.Topic:
    path = scratch_path(spark, "topic")
    fixtures.payloads(spark, d).write.parquet(path)
    return readers.Topic(format="parquet", path=path)


# Payloads the lenient reader keeps: the cut-off ones lose their tail but not their id.
_LENIENT = f"""{o.EV}, rd AS (SELECT event_id, CASE WHEN k NOT IN (90, 94) THEN ts_ms END AS ts_ms,
    CASE WHEN k = 90 THEN NULL WHEN k = 91 THEN 'login' ELSE event_type END AS event_type,
    CASE WHEN k NOT IN (90, 93) THEN "user" END AS "user",
    CASE WHEN k <> 90 THEN source_ip END AS source_ip, CASE WHEN k <> 90 THEN geo_location END AS geo_location,
    CASE WHEN k IN (90, 4) THEN NULL WHEN k = 92 THEN 'unknown' ELSE status END AS status,
    CASE WHEN k <> 90 THEN round(threat_score, 9) END AS threat_score,
    CAST(seq % 4 AS INT) AS "partition", seq // 4 AS "offset" FROM ev WHERE k <> 90)"""
_R = 'event_id, ts_ms, event_type, "user", source_ip, geo_location, status, threat_score'
_RF = ["event_id", "ts_ms", "event_type", "user", "source_ip", "geo_location", "status", "threat_score"]

# --- A: sources and sinks ---------------------------------------------------------------------


@query("read_events_batch", f'WITH {_LENIENT} SELECT {_R}, "partition", "offset" FROM rd')
def _(spark, d):
    return rounded(readers.read_events_batch(spark, _stored_topic(spark, d)).select(*_RF, "partition", "offset"))


@query("read_events_stream", f"WITH {_LENIENT} SELECT {_R} FROM rd")
def _(spark, d):
    stream = readers.read_events_stream(spark, _stored_topic(spark, d))
    return rounded(_run_stream(stream.select(*_RF)))


@query(
    "bounded_read",
    f"""WITH {_LENIENT}, ends AS (SELECT seq % 4 AS p, least(max(seq // 4) + 1, min(seq // 4) + 250) AS stop FROM ev GROUP BY 1)
    SELECT {_R}, "partition", "offset" FROM rd JOIN ends ON p = "partition" AND "offset" < stop
    ORDER BY "partition", "offset" LIMIT 1000""",
)
def _(spark, d):
    events = readers.read_events_batch(spark, _stored_topic(spark, d), max_events=1000)
    return rounded(events.select(*_RF, "partition", "offset"))


@query(
    "read_time_range",
    f"""WITH {_LENIENT} SELECT {_R} FROM rd
    WHERE ts_ms >= epoch_ms(TIMESTAMP '2024-01-10 00:00:00') AND ts_ms <= epoch_ms(TIMESTAMP '2024-01-20 00:00:00')""",
)
def _(spark, d):
    key = (spark.sparkContext.applicationId, d, "topic")
    if key not in _STORED:
        _STORED[key] = (_stored_topic(spark, d), scratch_path(spark, "times"))
    topic, times = _STORED[key]
    found = readers.read_time_range(spark, topic, "2024-01-10T00:00:00", "2024-01-20T00:00:00", times)
    return rounded(found.select(*_RF))


_ERROR = """CASE k WHEN 90 THEN 'malformed' WHEN 91 THEN 'unknown event_type' WHEN 92 THEN 'unknown status'
    WHEN 93 THEN 'missing user' WHEN 94 THEN 'missing timestamp' END"""
_GOOD = "k NOT IN (90, 91, 92, 93, 94)"


@query(
    "parse_event_json",
    f"""WITH {o.EV} SELECT event_id AS key, {_ERROR} AS error, CASE WHEN {_GOOD} THEN ts_ms END AS ts_ms,
    CASE WHEN {_GOOD} THEN event_type END AS event_type, CASE WHEN {_GOOD} THEN "user" END AS "user",
    CASE WHEN {_GOOD} THEN CASE WHEN k = 4 THEN 'success' ELSE status END END AS status,
    CASE WHEN {_GOOD} THEN destination_ip END AS destination_ip,
    CASE WHEN {_GOOD} THEN geo_location END AS geo_location,
    CASE WHEN {_GOOD} THEN round(threat_score, 9) END AS threat_score FROM ev""",
)
def _(spark, d):
    parsed = parse.parse_event_json(fixtures.payloads(spark, d), "key")
    return rounded(
        parsed.select(
            "key", "error", "ts_ms", "event_type", "user", "status", "destination_ip",
            F.col("metadata.geo_location").alias("geo_location"), "threat_score",
        )
    )


@query(
    "parse_typed_details",
    f"""WITH {o.EV} SELECT event_id, event_type,
    CASE WHEN event_type = 'auth_attempt' THEN k END AS attempts_count,
    CASE WHEN event_type = 'network_connection' THEN k + 1000 END AS destination_port,
    CASE WHEN event_type = 'network_connection' THEN seq * 10 END AS bytes_sent,
    file_path, CASE WHEN event_type = 'file_access' THEN k % 2 = 0 END AS is_encrypted,
    process_name, CASE WHEN event_type = 'process_execution' THEN k + 1 END AS process_id,
    domain AS query_name, CASE WHEN event_type = 'dns_query' THEN source_ip END AS resolved_ip
    FROM ev WHERE {_GOOD}""",
)
def _(spark, d):
    return parse.parse_typed_details(fixtures.payloads(spark, d)).select(
        "event_id", "event_type", "auth_details.attempts_count", "network_details.destination_port",
        "network_details.bytes_sent", "file_details.file_path", "file_details.is_encrypted",
        "process_details.process_name", "process_details.process_id", "dns_details.query_name",
        F.col("dns_details.resolved_ips")[0].alias("resolved_ip"),
    )


@query(
    "dead_letters",
    f"WITH {o.EV} SELECT {_ERROR} AS error, count(*) AS records FROM ev WHERE NOT ({_GOOD}) GROUP BY 1",
)
def _(spark, d):
    _, rejected = parse.split_rejected(parse.parse_event_json(fixtures.payloads(spark, d)))
    return rejected.groupBy("error").agg(F.count("*").alias("records"))


@query(
    "serialize_event_json",
    f"""WITH {o.EV} SELECT event_id, ts_ms, "user", destination_ip, file_path, domain,
    CAST(destination_ip IS NOT NULL AS INT) + CAST(geo_location IS NOT NULL OR file_path IS NOT NULL
      OR process_name IS NOT NULL OR domain IS NOT NULL AS INT) + 7 AS n_fields FROM ev""",
)
def _(spark, d):
    payload = fixtures.events(spark, d).select(parse.serialize_event_json(fixtures.events(spark, d).columns).alias("value"))
    fields = payload.select(F.size(F.json_object_keys("value")).alias("n_fields"), "value")
    return parse.parse_event_json(fields, "n_fields").select(
        "event_id", "ts_ms", "user", "destination_ip", "metadata.file_path", "metadata.domain", "n_fields"
    )


def _delivered_twice(df: DataFrame, score: str) -> DataFrame:
    """All rows delivered twice; the later delivery carries half the score."""
    first = df.withColumn("arrival", F.lit(0))
    return first.unionByName(df.withColumn(score, F.col(score) / 2).withColumn("arrival", F.lit(1)))


# Ids that end in 0 to 6 are in the first call to a writer, those that end in 4 to 9 in the second, with a third
# of the score: some keys are new, some known, and some only stored.
_FIRST, _SECOND = "cast(right(event_id, 1) as int) <= 6", "cast(right(event_id, 1) as int) >= 4"


def _merged(score: str) -> str:
    return f"CASE WHEN CAST(right(event_id, 1) AS INT) >= 4 THEN {score} / 3 ELSE {score} / 2 END"


def _written_twice(df: DataFrame, score: str, write, path: str) -> str:
    """The rows written in two calls, each key twice in the first of them."""
    write(_delivered_twice(df.where(_FIRST), score), path, "arrival")
    write(df.where(_SECOND).withColumn(score, F.col(score) / 3).withColumn("arrival", F.lit(0)), path, "arrival")
    return path


@query("upsert_events", f"WITH {o.EV} SELECT {E.replace('threat_score, 9', _merged('threat_score') + ', 9')}, strftime(ts, '%Y-%m-%d') AS event_date FROM ev")
def _(spark, d):
    path = _written_twice(fixtures.events(spark, d), "threat_score", writers.upsert_events, scratch_path(spark, "events"))
    return rounded(spark.read.parquet(path).select(*EVENT_FIELDS, F.col("event_date").cast("string").alias("event_date")))


@query("write_anomalies", f"WITH {o.EV}, {o.AN} SELECT event_id, \"user\", ts_ms, round({_merged('anomaly_score')}, 9) AS anomaly_score FROM an")
def _(spark, d):
    path = _written_twice(_anomalies(spark, d), "anomaly_score", writers.write_anomalies, scratch_path(spark, "anomalies"))
    return rounded(spark.read.parquet(path).select("event_id", "user", "ts_ms", "anomaly_score"))


@query("write_analyses", f"WITH {o.EV}, {o.AL} SELECT event_id, severity, round({_merged('confidence')}, 9) AS confidence, ts_s FROM al")
def _(spark, d):
    path = _written_twice(fixtures.analyses(spark, d), "confidence", writers.write_analyses, scratch_path(spark, "analyses"))
    return rounded(spark.read.parquet(path).select("event_id", "severity", "confidence", "ts_s"))


@query(
    "write_embeddings",
    # Doubling a float and cutting its product with a power of two are exact, so nothing is rounded.
    """SELECT vec_id, len(embedding) AS dims, array_to_string([
    CAST(CAST(trunc(CAST(x AS DOUBLE) * CASE WHEN vec_id % 10 >= 4 THEN 2 ELSE 1 END * 1099511627776) AS BIGINT) AS VARCHAR) FOR x IN embedding], ' ') AS parts FROM embeddings""",
)
def _(spark, d):
    rows, path = fixtures.table(spark, d, "embeddings"), scratch_path(spark, "vectors")
    writers.write_embeddings(rows.where("vec_id % 10 <= 6"), path, "vec_id", "label")
    again = rows.where("vec_id % 10 >= 4").withColumn("embedding", F.transform("embedding", lambda x: x * F.lit(2.0).cast("float")))
    writers.write_embeddings(again, path, "vec_id", "label")
    parts = F.transform("embedding", lambda x: (x.cast("double") * F.lit(1099511627776.0)).cast("bigint").cast("string"))
    return spark.read.parquet(path).select("vec_id", F.size("embedding").alias("dims"), F.array_join(parts, " ").alias("parts"))


@query("write_training_data", f"WITH {o.EV}, {o.LABELLED} SELECT {B} FROM lb")
def _(spark, d):
    path = writers.write_training_data(_labelled(spark, d), scratch_path(spark, "training"))
    return _batch(spark.read.parquet(path))


_REPORT = f"""WITH {o.EV}, {o.LABELLED},
top AS (SELECT * FROM lb WHERE is_anomaly = 1 ORDER BY anomaly_score_normalized DESC, "user" LIMIT 10),
rp AS (SELECT count(*) AS total_users, count(*) FILTER (WHERE is_anomaly = 1) AS anomalous_users,
  round(count(*) FILTER (WHERE is_anomaly = 1) / CAST(count(*) AS DOUBLE), 9) AS anomaly_rate,
  (SELECT string_agg("user" || ':' || CAST(total_events AS VARCHAR), ',' ORDER BY anomaly_score_normalized DESC, "user") FROM top) AS top_users,
  (SELECT round(sum(anomaly_score_normalized), 9) FROM top) AS top_score_sum FROM lb)"""


def _report_row(report: DataFrame) -> DataFrame:
    top = F.col("top_anomalies")
    scores = F.aggregate(F.transform(top, lambda r: r["anomaly_score_normalized"]), F.lit(0.0), lambda a, x: a + x)
    return rounded(
        report.select(
            "total_users",
            "anomalous_users",
            "anomaly_rate",
            F.array_join(
                F.transform(top, lambda r: F.concat(r["user"], F.lit(":"), r["total_events"].cast("string"))), ","
            ).alias("top_users"),
            scores.alias("top_score_sum"),
        )
    )


@query("write_anomaly_report", f"{_REPORT} SELECT * FROM rp")
def _(spark, d):
    report = summary.anomaly_report(_labelled(spark, d))
    path = writers.write_anomaly_report(report, scratch_path(spark, "report"))
    return _report_row(readers.read_anomaly_report(spark, path))


@query("read_anomaly_report", f"{_REPORT} SELECT total_users, anomalous_users FROM rp")
def _(spark, d):
    report = summary.anomaly_report(_labelled(spark, d))
    path = writers.write_anomaly_report(report, scratch_path(spark, "report"))
    return readers.read_anomaly_report(spark, path).select("total_users", "anomalous_users")


@query("read_batch_anomalies", f"WITH {o.EV}, {o.LABELLED} SELECT {B} FROM lb WHERE is_anomaly = 1")
def _(spark, d):
    path = writers.write_training_data(_labelled(spark, d), scratch_path(spark, "training"))
    return _batch(readers.read_batch_anomalies(spark, path))


@query("publish_events", f'WITH {o.EV} SELECT event_id AS key, ts_ms, "user", geo_location FROM ev')
def _(spark, d):
    path = scratch_path(spark, "topic")
    writers.publish_events(fixtures.events(spark, d), "security-events", fmt="parquet", path=path)
    sent = parse.parse_event_json(spark.read.parquet(path), "key")
    return sent.select("key", "ts_ms", "user", "metadata.geo_location")


_INTEL = """it AS (SELECT CAST(d.doc_id AS VARCHAR) AS id, text AS description, coalesce(source, 'unknown') AS category,
    CASE WHEN toxic = 1 THEN 'high' ELSE 'medium' END AS severity, '' AS mitre_attack
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


@query(
    "load_threat_intel",
    f"""WITH {_INTEL} SELECT id, md5(description) AS digest, CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN 'again' ELSE category END AS category,
    severity, mitre_attack FROM it""",
)
def _(spark, d):
    entries, path = readers.load_threat_intel(fixtures.intel(spark, d)), scratch_path(spark, "intel")
    writers.write_threat_intel(entries, path)
    writers.write_threat_intel(entries.where("cast(id as bigint) % 2 = 0").withColumn("category", F.lit("again")), path)
    return spark.read.parquet(path).select("id", F.md5("description").alias("digest"), "category", "severity", "mitre_attack")


@query("read_embeddings", "SELECT vec_id, len(embedding) AS dims, label FROM embeddings WHERE vec_id = 7")
def _(spark, d):
    found = readers.read_embeddings(fixtures.table(spark, d, "embeddings"), 7, key="vec_id")
    return found.select("vec_id", F.size("embedding").alias("dims"), "label")


# --- B: point, range and top-N queries ---------------------------------------------------------

_NEW = "ORDER BY ts_ms DESC, event_id DESC"
_KEY = "ORDER BY event_type DESC, ts_ms DESC, event_id DESC"


@query(
    "validate_events",
    f"""WITH {o.EV}, odd AS (SELECT * REPLACE (CASE WHEN k = 1 THEN 'bad_id' ELSE event_id END AS event_id,
      CASE WHEN k = 2 THEN 5 ELSE ts_ms END AS ts_ms, CASE WHEN k = 3 THEN 1.5 ELSE threat_score END AS threat_score,
      CASE WHEN k = 5 THEN 'not-an-ip' ELSE source_ip END AS source_ip, CASE WHEN k = 6 THEN '' ELSE "user" END AS "user") FROM ev)
    SELECT CASE k WHEN 1 THEN 'event_id format' WHEN 2 THEN 'timestamp range' WHEN 3 THEN 'threat_score range'
      WHEN 5 THEN 'source_ip format' WHEN 6 THEN 'user missing' ELSE '' END AS problems,
      k NOT IN (1, 2, 3, 5, 6) AS is_valid, count(*) AS events FROM odd GROUP BY ALL""",
)
def _(spark, d):
    ev = fixtures.map_events(fixtures.table(spark, d, "events"))
    k = F.col("k")
    odd = ev.withColumns(
        {
            "event_id": F.when(k == 1, "bad_id").otherwise(F.col("event_id")),
            "ts_ms": F.when(k == 2, 5).otherwise(F.col("ts_ms")),
            "threat_score": F.when(k == 3, 1.5).otherwise(F.col("threat_score")),
            "source_ip": F.when(k == 5, "not-an-ip").otherwise(F.col("source_ip")),
            "user": F.when(k == 6, "").otherwise(F.col("user")),
        }
    )
    checked = parse.validate_events(odd)
    return checked.groupBy(F.array_join("problems", "; ").alias("problems"), "is_valid").agg(F.count("*").alias("events"))


def _simple(name: str, tail: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """A query from events to events."""
    query(name, f"WITH {o.EV} SELECT {E} FROM {tail}")(lambda spark, d: _events(fn(fixtures.events(spark, d))))


_RANGE = f"ts_ms BETWEEN {START_MS} AND {END_MS}"
_simple("event_by_id", f"ev WHERE event_id = '{EVENT}'", lambda e: lookups.event_by_id(e, EVENT))
_simple(
    "events_by_type_time_range",
    f"ev WHERE event_type = '{TYPE}' AND {_RANGE}",
    lambda e: lookups.events_by_type_time_range(e, TYPE, START_MS, END_MS),
)
_simple(
    "latest_events_by_type",
    f"ev WHERE event_type = '{TYPE}' {_NEW} LIMIT 25",
    lambda e: lookups.latest_events_by_type(e, TYPE, 25),
)
_simple("latest_events", f"ev {_NEW} LIMIT 100", lambda e: lookups.latest_events(e))
_simple("latest_events_key_order", f"ev {_KEY} LIMIT 100", lambda e: lookups.latest_events(e, order="key"))
_simple("events_above_threat", f"ev WHERE threat_score >= 0.7 {_NEW} LIMIT 100", lookups.events_above_threat)
_simple(
    "events_above_threat_key_order",
    f"ev WHERE threat_score >= 0.7 {_KEY} LIMIT 100",
    lambda e: lookups.events_above_threat(e, order="key"),
)
_simple(
    "failed_logins",
    f"(SELECT * FROM ev WHERE threat_score >= 0.5 {_NEW} LIMIT 100) WHERE event_type LIKE '%auth%'",
    lambda e: lookups.failed_logins(e, 100, order="time"),
)
_simple(
    "failed_logins_key_order",
    f"(SELECT * FROM ev WHERE threat_score >= 0.5 {_KEY} LIMIT 10) WHERE event_type LIKE '%auth%'",
    lookups.failed_logins,
)
_simple(
    "failed_logins_by_status",
    f"ev WHERE event_type LIKE '%auth%' AND status = 'failed' {_NEW} LIMIT 10",
    lambda e: lookups.failed_logins(e, by_status=True),
)
_simple(
    "events_by_user",
    f"ev WHERE \"user\" = '{USER}' AND ts_ms >= {END_MS} - 240 * 3600000 {_NEW} LIMIT 100",
    lambda e: lookups.events_by_user(e, USER, window_hours=lookups.window_hours("10d"), now_ms=END_MS),
)
_simple(
    "events_by_user_recent_only",
    f"(SELECT * FROM ev {_NEW} LIMIT 500) WHERE \"user\" = '{USER}' {_NEW} LIMIT 100",
    lambda e: lookups.events_by_user(e, USER, from_recent_only=True),
)


def _keyed(spark: SparkSession, d: str, name: str, make: Callable[[], DataFrame], store: Callable[..., str], **options) -> str:
    """A table laid out for lookups, stored once for an application; the later part comes as a second merge."""
    place = (spark.sparkContext.applicationId, d, name)
    if place not in _STORED:
        rows, path = make(), scratch_path(spark, name)
        late = F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0
        store(rows.where(~late), path, **options)
        _STORED[place] = store(rows.where(late), path, **options)
    return _STORED[place]


@query("event_by_id_stored", f"WITH {o.EV} SELECT {E} FROM ev WHERE event_id = '{EVENT}'")
def _(spark, d):
    path = _keyed(spark, d, "events-by-id", lambda: fixtures.events(spark, d), keyed.store_by_id)
    return _events(lookups.event_by_id(keyed.read_keyed(spark, path, event_id=EVENT), EVENT))


@query("events_by_user_stored", f"WITH {o.EV} SELECT {E} FROM ev WHERE \"user\" = '{USER}' {_NEW} LIMIT 100")
def _(spark, d):
    path = _keyed(spark, d, "events-by-user", lambda: fixtures.events(spark, d), keyed.store_by_user)
    return _events(lookups.events_by_user(keyed.read_keyed(spark, path, user=USER), USER))


# Noon, so that one day is cut through.
_CUTOFF_MS = END_MS + 43_200_000


@query("expire_events", f"WITH {o.EV} SELECT {E} FROM ev WHERE ts_ms >= {_CUTOFF_MS}")
def _(spark, d):
    path = writers.upsert_events(fixtures.events(spark, d).drop("k", "seq"), scratch_path(spark, "events"), "threat_score")
    writers.delete_expired(spark, path, _CUTOFF_MS)
    return _events(spark.read.parquet(path))


query("expired_count", f"WITH {o.EV} SELECT count(*) AS deleted FROM ev WHERE ts_ms < {END_MS}")(
    lambda spark, d: lookups.expired_count(fixtures.events(spark, d), END_MS)
)


def _analysis_query(name: str, tail: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    query(name, f"WITH {o.EV}, {o.AL} SELECT {L} FROM {tail}")(
        lambda spark, d: _joined(fn(fixtures.analyses(spark, d)), "recommendations")
    )


_analysis_query(
    "analysis_by_event", f"al WHERE event_id = '{ANALYSED}'", lambda a: lookups.analysis_by_event(a, ANALYSED)
)
_analysis_query(
    "analyses_by_time_range",
    f"al WHERE ts_s BETWEEN {START_MS // 1000} AND {END_MS // 1000} ORDER BY event_id LIMIT 50",
    lambda a: lookups.analyses_by_time_range(a, START_MS // 1000, END_MS // 1000, 50),
)
_analysis_query(
    "analyses_by_severity",
    "al WHERE upper(severity) = 'HIGH' ORDER BY event_id LIMIT 100",
    lambda a: lookups.analyses_by_severity(a, "high"),
)
_analysis_query("latest_analyses", "al ORDER BY event_id DESC LIMIT 100", lookups.latest_analyses)
_analysis_query(
    "latest_analyses_time_order",
    "al ORDER BY ts_s DESC, event_id DESC LIMIT 100",
    lambda a: lookups.latest_analyses(a, order="time"),
)


def _anomaly_query(name: str, tail: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    query(name, f"WITH {o.EV}, {o.AN} SELECT {A} FROM {tail}")(
        lambda spark, d: _joined(fn(_anomalies(spark, d)), "reasons")
    )


_anomaly_query(
    "anomaly_by_event",
    f"an WHERE event_id = '{ANOMALOUS}'",
    lambda a: lookups.anomaly_by_event(a, ANOMALOUS),
)


@query("anomaly_by_event_stored", f"WITH {o.EV}, {o.AN} SELECT {A} FROM an WHERE event_id = '{ANOMALOUS}'")
def _(spark, d):
    path = _keyed(spark, d, "anomalies-by-id", lambda: _anomalies(spark, d), keyed.store_by_id, key=writers.ANOMALY_KEY)
    return _joined(lookups.anomaly_by_event(keyed.read_keyed(spark, path, event_id=ANOMALOUS), ANOMALOUS), "reasons")


@query(
    "anomalies_by_user_stored", f"WITH {o.EV}, {o.AN} SELECT {A} FROM an WHERE \"user\" = '{USER}' ORDER BY ts_ms, event_id LIMIT 100"
)
def _(spark, d):
    path = _keyed(spark, d, "anomalies-by-user", lambda: _anomalies(spark, d), keyed.store_by_user)
    return _joined(lookups.anomalies_by_user(keyed.read_keyed(spark, path, user=USER).drop("event_date"), USER), "reasons")


_anomaly_query(
    "anomalies_by_time_range",
    f"an WHERE {_RANGE} ORDER BY ts_ms, event_id LIMIT 50",
    lambda a: lookups.anomalies_by_time_range(a, START_MS, END_MS, 50),
)
_anomaly_query(
    "anomalies_by_user",
    f"an WHERE \"user\" = '{USER}' ORDER BY ts_ms, event_id LIMIT 100",
    lambda a: lookups.anomalies_by_user(a, USER),
)
_anomaly_query(
    "high_score_anomalies", f"an WHERE anomaly_score >= 0.75 {_NEW} LIMIT 100", lambda a: lookups.high_score_anomalies(a, 0.75)
)
_anomaly_query(
    "high_score_anomalies_ascending",
    "an WHERE anomaly_score >= 0.75 ORDER BY ts_ms, event_id LIMIT 100",
    lambda a: lookups.high_score_anomalies(a, 0.75, newest_first=False),
)
_anomaly_query("latest_anomalies", f"an {_NEW} LIMIT 100", lookups.latest_anomalies)
_anomaly_query(
    "top_anomaly_per_user",
    'an QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY anomaly_score DESC, ts_ms DESC, event_id DESC) = 1',
    lookups.top_anomaly_per_user,
)


@query("batch_anomalies", f"WITH {o.EV}, {o.LABELLED} SELECT {B} FROM lb WHERE is_anomaly = 1")
def _(spark, d):
    return _batch(lookups.batch_anomalies(_flagged(spark, d)))


@query("batch_anomaly_for_user", f"WITH {o.EV}, {o.LABELLED} SELECT {B} FROM lb WHERE is_anomaly = 1 AND \"user\" = 'user_11'")
def _(spark, d):
    return _batch(lookups.batch_anomaly_for_user(_flagged(spark, d), "user_11"))


@query(
    "select_for_analysis",
    f"""WITH {o.EV}, {o.AN} SELECT e.event_id, round(threat_score, 9) AS threat_score, an.event_id IS NOT NULL AS is_anomalous
    FROM ev e LEFT JOIN an ON e.event_id = an.event_id WHERE threat_score >= 0.7 OR an.event_id IS NOT NULL""",
)
def _(spark, d):
    chosen = lookups.select_for_analysis(fixtures.events(spark, d), _anomalies(spark, d))
    return rounded(chosen.select("event_id", "threat_score", "is_anomalous"))


def _named(spark: SparkSession, d: str, action: str, **params) -> DataFrame:
    ev, al = fixtures.events(spark, d), fixtures.analyses(spark, d)
    return lookups.named_query(action, ev, al, summary.stats_summary(ev, al, _anomalies(spark, d)), **params)


_named_events = {
    "named_query": ("high_threats", f"ev WHERE threat_score >= 0.7 {_KEY} LIMIT 10"),
    "named_query_unknown": ("no_such_action", f"ev {_KEY} LIMIT 10"),
    "named_query_file_access": ("file_access", f"ev WHERE event_type = 'file_access' {_NEW} LIMIT 10"),
    "named_query_suspicious_ips": (
        "suspicious_ips",
        f"""ev WHERE source_ip IN (SELECT source_ip FROM ev WHERE threat_score >= 0.7 GROUP BY source_ip HAVING count(*) >= 2)
        {_NEW} LIMIT 10""",
    ),
}
for _name, (_action, _tail) in _named_events.items():
    query(_name, f"WITH {o.EV} SELECT {E} FROM {_tail}")(
        lambda spark, d, action=_action: _events(_named(spark, d, action))
    )


@query(
    "supporting_events",
    f"""WITH {o.EV} SELECT event_id, ts_ms, event_type, 'MEDIUM' AS severity, "user", source_ip,
    round(threat_score, 9) AS threat_score FROM ev {_NEW} LIMIT 10""",
)
def _(spark, d):
    return rounded(lookups.supporting_events(lookups.latest_events(fixtures.events(spark, d), 10)))


@query(
    "numeric_feature_columns",
    "SELECT unnest([" + ", ".join(f"'{c}'" for c in features.FEATURE_COLUMNS if c not in features.NOT_FEATURES)
    + "]) AS feature, (SELECT count(DISTINCT user_id) FROM events) AS users",
)
def _(spark, d):
    table = features.all_user_features(fixtures.events(spark, d))
    names = features.numeric_feature_columns(table)
    counts = table.agg(*[F.count(c).alias(c) for c in names])
    return counts.unpivot([], names, "feature", "users")


_NUMERIC = [c for c in features.FEATURE_COLUMNS if c not in features.NOT_FEATURES]


@query(
    "user_incident_slice",
    f"""WITH {o.EV}, {o.FEATURES}, ft AS (SELECT uf."user" AS "user", * EXCLUDE ("user")
      FROM uf JOIN pv ON uf."user" = pv."user" JOIN hf ON uf."user" = hf."user" JOIN ips ON uf."user" = ips."user" JOIN sf ON uf."user" = sf."user"),
    long AS (SELECT "user", unnest([{", ".join(f"'{c}'" for c in _NUMERIC)}]) AS feature,
      unnest([{", ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in _NUMERIC)}]) AS value FROM ft),
    st AS (SELECT feature, max(value) FILTER (WHERE "user" = '{USER}') AS value, avg(value) AS m, stddev_samp(value) AS s FROM long GROUP BY feature)
    SELECT feature, round(value, 6) AS value, round(m, 6) AS population_mean, round(s, 6) AS population_stddev,
      round((value - m) / nullif(s, 0), 6) AS z_score FROM st WHERE value IS NOT NULL""",
)
def _(spark, d):
    return rounded(features.user_incident_slice(fixtures.events(spark, d), USER), 6)


# --- C: aggregations ---------------------------------------------------------------------------

_UF_COLS = [
    "user", "total_events", "unique_ips", "unique_event_types", "avg_threat_score", "max_threat_score", "failed_events",
    "unusual_hour_events", "unique_locations", "first_seen_ms", "last_seen_ms", "failed_auth_rate", "unusual_hour_rate",
    "ip_diversity_score", "activity_days", "events_per_day",
]
_INTS = {
    "user", "total_events", "unique_ips", "unique_event_types", "failed_events", "unusual_hour_events", "unique_locations",
    "first_seen_ms", "last_seen_ms", "activity_days", "rare_ip_count", "burst_events", "min_event_interval", *o.TYPES,
}
_SIX = {"avg_event_interval", "event_interval_stddev"}


def _sql_cols(names, table: str = "") -> str:
    out = []
    for n in names:
        ref = f'{table}"{n}"'
        out.append(ref if n in _INTS else f'round({ref}, {6 if n in _SIX else 9}) AS "{n}"')
    return ", ".join(out)


def _seen_ms(df: DataFrame) -> DataFrame:
    return df.withColumns({"first_seen_ms": F.unix_millis("first_seen"), "last_seen_ms": F.unix_millis("last_seen")}).drop(
        "first_seen", "last_seen"
    )


@query("user_features", f"WITH {o.EV}, {o.USERS} SELECT {_sql_cols(_UF_COLS)} FROM uf")
def _(spark, d):
    return rounded(_seen_ms(features.user_features(fixtures.events(spark, d))))


@query("event_type_pivot", f"WITH {o.EV}, {o.PIVOT} SELECT * FROM pv")
def _(spark, d):
    return features.event_type_pivot(fixtures.events(spark, d))


@query("hourly_features", f"WITH {o.EV}, {o.HOURLY} SELECT {_sql_cols(['user', 'hourly_stddev', 'hourly_variance', 'weekend_share'])} FROM hf")
def _(spark, d):
    return rounded(features.hourly_features(fixtures.events(spark, d)))


_IP_COLS = ["user", "avg_ip_frequency", "ip_frequency_stddev", "rare_ip_count", "rare_ip_ratio"]
_SEQ_COLS = ["user", "avg_event_interval", "event_interval_stddev", "min_event_interval", "burst_events"]


@query("ip_features", f"WITH {o.EV}, {o.IPS} SELECT {_sql_cols(_IP_COLS)} FROM ips")
def _(spark, d):
    return rounded(features.ip_features(fixtures.events(spark, d)))


@query("sequence_features", f"WITH {o.EV}, {o.SEQ} SELECT {_sql_cols(_SEQ_COLS)} FROM sf")
def _(spark, d):
    return rounded(features.sequence_features(fixtures.events(spark, d)), avg_event_interval=6, event_interval_stddev=6)


_ALL_SQL = f"""WITH {o.EV}, {o.FEATURES} SELECT {_sql_cols(_UF_COLS, 'uf.')}, {_sql_cols(o.TYPES, 'pv.')},
  round(coalesce(hourly_stddev, 0), 9) AS hourly_stddev, round(coalesce(hourly_variance, 0), 9) AS hourly_variance,
  {_sql_cols(_IP_COLS[1:], 'ips.')}, {_sql_cols(_SEQ_COLS[1:], 'sf.')}
  FROM uf JOIN pv ON uf."user" = pv."user" JOIN hf ON uf."user" = hf."user" JOIN ips ON uf."user" = ips."user"
  JOIN sf ON uf."user" = sf."user\""""


@query("all_user_features", _ALL_SQL)
def _(spark, d):
    table = features.all_user_features(fixtures.events(spark, d))
    return rounded(_seen_ms(table), avg_event_interval=6, event_interval_stddev=6)


@query("feature_left_join", _ALL_SQL)
def _(spark, d):
    ev = fixtures.events(spark, d)
    table = features.feature_left_join(
        features.user_features(ev), features.event_type_pivot(ev), features.hourly_features(ev).drop("weekend_share"),
        features.ip_features(ev), features.sequence_features(ev),
    ).na.fill(0)
    return rounded(_seen_ms(table), avg_event_interval=6, event_interval_stddev=6)


@query(
    "event_summary",
    f"""WITH {o.EV} SELECT count(*) AS total_events, count(DISTINCT "user") AS unique_users, count(DISTINCT source_ip) AS unique_ips,
    min(ts_ms) AS min_ts_ms, max(ts_ms) AS max_ts_ms, round(avg(threat_score), 9) AS avg_threat_score FROM ev""",
)
def _(spark, d):
    return rounded(summary.event_summary(fixtures.events(spark, d)))


@query("event_type_distribution", f"WITH {o.EV} SELECT event_type, count(*) AS events FROM ev GROUP BY 1")
def _(spark, d):
    return summary.event_type_distribution(fixtures.events(spark, d))


_STATS = f"""WITH {o.EV}, {o.AL}, {o.AN} SELECT count(*) AS total_events, count(*) FILTER (WHERE threat_score >= 0.7) AS high_threat_events,
  round(coalesce(sum(coalesce(threat_score, 0)) / count(*), 0), 9) AS average_threat_score,
  (SELECT count(*) FROM al) AS total_analyses, (SELECT count(*) FROM an) AS total_anomalies FROM ev"""


@query("stats_summary", _STATS)
def _(spark, d):
    return rounded(summary.stats_summary(fixtures.events(spark, d), fixtures.analyses(spark, d), _anomalies(spark, d)))


query("named_query_stats", _STATS)(lambda spark, d: rounded(_named(spark, d, "stats")))


@query(
    "table_counts",
    f"""WITH {o.EV}, {o.AL}, {o.AN} SELECT 'events' AS table_name, count(*) AS "rows" FROM ev UNION ALL SELECT 'analyses', count(*) FROM al
    UNION ALL SELECT 'embeddings', count(*) FROM embeddings UNION ALL SELECT 'anomalies', count(*) FROM an""",
)
def _(spark, d):
    return summary.table_counts(
        events=fixtures.events(spark, d), analyses=fixtures.analyses(spark, d),
        embeddings=fixtures.table(spark, d, "embeddings"), anomalies=_anomalies(spark, d),
    )


@query("anomaly_report", f"{_REPORT} SELECT * FROM rp")
def _(spark, d):
    return _report_row(summary.anomaly_report(_labelled(spark, d)))


@query(
    "training_stats",
    f"""{_REPORT} SELECT total_users, anomalous_users, anomaly_rate, least(anomalous_users, 10) AS top_anomalies_count, true AS available,
    printf('Training data: %d users analyzed, %d anomalies (%.1f%% rate)', total_users, anomalous_users,
      CAST(anomalous_users AS DOUBLE) / total_users * 100) AS stats FROM rp""",
)
def _(spark, d):
    return rounded(summary.training_stats(summary.anomaly_report(_labelled(spark, d))))


@query("normal_users", f"{_REPORT} SELECT total_users - anomalous_users AS normal_users FROM rp")
def _(spark, d):
    return summary.normal_users(summary.anomaly_report(_labelled(spark, d)))


_LOWER = "CASE WHEN {0} >= 0.9 THEN 'critical' WHEN {0} >= 0.8 THEN 'high' WHEN {0} >= 0.7 THEN 'medium' ELSE 'low' END"


@query(
    "event_counters",
    f"""WITH {o.EV}, {o.AL}, {o.AN} SELECT 'events_processed' AS counter, event_type AS label, CAST(NULL AS VARCHAR) AS "user", count(*) AS total FROM ev GROUP BY ALL
    UNION ALL SELECT 'threats_detected', label, NULL, count(*) FROM (SELECT {_LOWER.format('anomaly_score')} AS label FROM an
      UNION ALL SELECT severity FROM al) GROUP BY ALL
    UNION ALL SELECT 'anomalies_detected', {_LOWER.format('anomaly_score')}, "user", count(*) FROM an GROUP BY ALL""",
)
def _(spark, d):
    return metrics.event_counters(fixtures.events(spark, d), _anomalies(spark, d), fixtures.analyses(spark, d))


@query("storage_errors", f"WITH {o.EV} SELECT count(*) FILTER (WHERE status = 'blocked') AS storage_errors FROM ev")
def _(spark, d):
    return metrics.storage_errors(fixtures.events(spark, d), F.col("status") == "blocked")


def _histogram_sql(source: str, value: str, bounds: tuple, tail: str = "observed") -> str:
    limits = ", ".join(f"({float(b)}::DOUBLE, '{float(b):g}')" for b in bounds)
    return f"""SELECT le, cumulative, observed_sum, observed_count FROM
      (SELECT le, (SELECT count(*) FROM {source} WHERE {value} <= b) AS cumulative FROM (VALUES {limits}) v(b, le)
       UNION ALL SELECT '+Inf', count({value}) FROM {source}),
      (SELECT round(coalesce(sum({value}), 0), 6) AS observed_sum, count({value}) AS observed_count FROM {source})"""


@query("score_histogram", f"WITH {o.EV}, {o.AN} {_histogram_sql('an', 'anomaly_score', metrics.SCORE_BOUNDS)}")
def _(spark, d):
    return rounded(metrics.score_histogram(_anomalies(spark, d)), observed_sum=6)


@query("latency_histogram", f"WITH {o.EV} {_histogram_sql('ev', 'threat_score', metrics.LATENCY_BOUNDS)}")
def _(spark, d):
    return rounded(metrics.latency_histogram(fixtures.events(spark, d), "threat_score"), observed_sum=6)


def _bucket(ms: int) -> str:
    return f"ts_ms // {ms} * {ms}"


@query(
    "consumer_rate",
    f"""WITH {o.EV} SELECT {_bucket(10_000)} AS window_start_ms, count(*) AS messages, count(*) / 10.0::DOUBLE AS per_second,
    count(*) FILTER (WHERE k BETWEEN 90 AND 94) AS errors,
    (SELECT round(count(*) FILTER (WHERE k NOT BETWEEN 90 AND 94) * 100.0 / count(*), 9) FROM ev) AS success_percent
    FROM ev GROUP BY 1""",
)
def _(spark, d):
    parsed = parse.parse_event_json(fixtures.payloads(spark, d), "timestamp").withColumnRenamed("ts", "event_ts")
    messages = parsed.select(F.col("timestamp").alias("ts"), "error")
    return rounded(metrics.consumer_rate(messages, F.col("error").isNull()))


@query(
    "live_consumer_rate",
    f"""WITH {o.EV} SELECT count(*) AS messages, count(*) FILTER (WHERE k BETWEEN 90 AND 94) AS errors,
    round(count(*) FILTER (WHERE k NOT BETWEEN 90 AND 94) * 100.0::DOUBLE / count(*), 9) AS success_percent, true AS several_batches, true AS has_rate FROM ev""",
)
def _(spark, d):
    """Counters that the micro-batches of a running stream report."""
    path = scratch_path(spark, "arriving")
    fixtures.payloads(spark, d).repartition(4).write.parquet(path)
    topic = readers.Topic(format="parquet", path=path)
    records = spark.readStream.schema(readers.RECORD_SCHEMA).option("maxFilesPerTrigger", 1).parquet(topic.path)
    counted = jobs.counted_stream(parse.parse_event_json(records), F.col("error").isNull())
    log, out = jobs.ProgressLog(spark, scratch_path(spark, "counters")), scratch_path(spark, "consumed")
    spark.streams.addListener(log)
    try:
        write = lambda batch, batch_id: jobs.write_batch(batch.select("event_id", "error"), out, batch_id)
        run = jobs.micro_batch_hook(counted, write, scratch_path(spark, "progress"), available_now=True)
        run.awaitTermination()
        log.settle(run)
    finally:
        spark.streams.removeListener(log)
    rates = jobs.live_rates(log.rows())
    return rounded(rates.select("messages", "errors", "success_percent", (F.col("batches") > 1).alias("several_batches"), (F.col("per_second") > 0).alias("has_rate")))


@query(
    "llm_usage_cost",
    f"""WITH {o.USAGE} SELECT model, base_model, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
    round(sum(cost), 9) AS cost FROM cost GROUP BY ALL""",
)
def _(spark, d):
    return rounded(metrics.llm_usage_cost(fixtures.usage_log(spark, d)))


@query(
    "population_baseline",
    f"""WITH {o.EV}, {o.USERS} SELECT round(avg(events_per_day), 9) AS avg_events_per_day, round(stddev_samp(events_per_day), 9) AS stddev_events_per_day,
    round(avg(unique_ips), 9) AS avg_unique_ips, round(stddev_samp(unique_ips), 9) AS stddev_unique_ips,
    round(avg(unusual_hour_rate), 9) AS avg_unusual_hour_rate,
    round(quantile_cont(unusual_hour_rate, 0.95), 9) AS unusual_hour_threshold FROM uf""",
)
def _(spark, d):
    return rounded(summary.population_baseline(features.user_features(fixtures.events(spark, d))))


@query(
    "detector_comparison",
    """WITH p AS (SELECT toxic = 1 AS actual, quality = 0 AS low_quality, n_chars < 500 AS short FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
    s AS (SELECT 'low_quality' AS detector, low_quality AS predicted, actual FROM p UNION ALL SELECT 'short', short, actual FROM p),
    c AS (SELECT detector, count(*) FILTER (WHERE predicted AND actual) AS tp, count(*) FILTER (WHERE predicted AND NOT actual) AS fp,
      count(*) FILTER (WHERE NOT predicted AND actual) AS fn FROM s GROUP BY 1)
    SELECT detector, tp AS true_positives, fp AS false_positives, fn AS false_negatives,
      round(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 9) AS precision, round(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 9) AS recall,
      round(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 9) AS f1 FROM c""",
)
def _(spark, d):
    known = fixtures.table(spark, d, "labels").join(fixtures.table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    guesses = {"low_quality": F.col("quality") == 0, "short": F.col("n_chars") < 500}
    entries = [F.struct(F.lit(n).alias("detector"), g.alias("predicted"), (F.col("toxic") == 1).alias("actual")) for n, g in guesses.items()]
    return rounded(summary.detector_comparison(known.select(F.inline(F.array(*entries)))))


@query(
    "data_readiness",
    f"""WITH {o.EV}, {o.AL}, {o.AN}, c AS (SELECT (SELECT count(*) FROM ev) AS event_count, (SELECT count(*) FROM an) AS anomaly_count, (SELECT count(*) FROM al) AS analysis_count)
    SELECT *, event_count > 0 AS events_available, true AS anomaly_detection_available, true AS ai_analysis_available,
    CAST(event_count = 0 AS INT) + CAST(anomaly_count = 0 AS INT) + CAST(analysis_count = 0 AS INT) AS n_warnings,
    event_count > 0 AS ready, CASE WHEN event_count > 0 THEN 'System is ready and has data' ELSE 'System is not ready - no events in database' END AS message FROM c""",
)
def _(spark, d):
    status = summary.data_readiness(fixtures.events(spark, d), _anomalies(spark, d), fixtures.analyses(spark, d))
    return status.withColumn("n_warnings", F.size("warnings")).drop("warnings")


@query(
    "layer_metrics",
    f"""WITH {o.EV}, {o.AL}, {o.AN}, {o.LABELLED} SELECT 'events_total' AS metric, CAST(count(*) AS DOUBLE) AS value FROM ev
    UNION ALL SELECT 'anomalies_total', count(*) FROM an UNION ALL SELECT 'ai_analyses_total', count(*) FROM al
    UNION ALL SELECT 'training_data_available', 1 UNION ALL SELECT 'training_data_users_total', count(*) FROM lb
    UNION ALL SELECT 'training_data_anomalies_total', sum(is_anomaly) FROM lb
    UNION ALL SELECT 'training_data_anomaly_rate', round(sum(is_anomaly) / CAST(count(*) AS DOUBLE), 9) FROM lb""",
)
def _(spark, d):
    report = summary.anomaly_report(_labelled(spark, d))
    return rounded(summary.layer_metrics(fixtures.events(spark, d), _anomalies(spark, d), fixtures.analyses(spark, d), report))


@query(
    "baseline_profiles",
    f"""WITH {o.EV} SELECT "user", dimension, value, count(*) AS events FROM (
      SELECT "user", unnest(['hour', 'source_ip', 'geo_location', 'event_type']) AS dimension,
        unnest([CAST(hour(ts) AS VARCHAR), source_ip, geo_location, event_type]) AS value FROM ev)
    WHERE value IS NOT NULL GROUP BY ALL""",
)
def _(spark, d):
    return baseline.baseline_profiles(fixtures.events(spark, d))


@query(
    "accepted_profiles",
    o.FOLD.rsplit("SELECT event_id", 1)[0]
    + f""", hit AS (SELECT event_id FROM st WHERE rn > 0 AND n >= {LEARN} AND score >= {CUT})
    SELECT "user", dimension, value, count(*) AS events FROM (
      SELECT "user", unnest(['hour', 'source_ip', 'geo_location', 'event_type']) AS dimension,
        unnest([CAST(hour(ts) AS VARCHAR), source_ip, geo_location, event_type]) AS value
      FROM ev WHERE event_id NOT IN (SELECT event_id FROM hit))
    WHERE value IS NOT NULL GROUP BY ALL""",
)
def _(spark, d):
    return baseline.baseline_profiles(baseline.accepted_events(fixtures.events(spark, d), LEARN, CUT))


@query(
    "baseline_totals",
    f"""WITH {o.EV} SELECT "user", count(*) AS total_events, count(*) FILTER (WHERE status = 'failed') AS failed_events,
    round(avg(threat_score), 9) AS avg_threat_score, count(*) >= 60 AS is_baseline_ready FROM ev GROUP BY 1""",
)
def _(spark, d):
    return rounded(baseline.baseline_totals(fixtures.events(spark, d), 60))


def _context_histogram(metric: str, value: str, bounds: tuple) -> str:
    limits = ", ".join(f"({float(b)}::DOUBLE, '{float(b):g}')" for b in bounds)
    return f"""SELECT '{metric}' AS metric, le, (SELECT count(*) FROM cq WHERE {value} <= b) AS cumulative FROM (VALUES {limits}) v(b, le)
      UNION ALL SELECT '{metric}', '+Inf', count(*) FROM cq"""


@query(
    "assistant_query_metrics",
    f"""WITH {o.CONTEXT} SELECT 'queries_total' AS metric, CASE WHEN n_intel > 0 THEN 'true' ELSE 'false' END AS le, count(*) AS cumulative FROM cq GROUP BY ALL
    UNION ALL {_context_histogram('confidence_score', 'confidence', metrics.CONFIDENCE_BOUNDS)}
    UNION ALL {_context_histogram('supporting_events_count', 'n_events', metrics.EVENT_COUNT_BOUNDS)}
    UNION ALL {_context_histogram('threat_intel_count', 'n_intel', metrics.INTEL_COUNT_BOUNDS)}""",
)
def _(spark, d):
    answered = context.answer_quality(fixtures.answer_context(spark, d))
    return metrics.assistant_query_metrics(answered.withColumn("include_threat_intel", F.col("n_intel") > 0))


# --- D: joins ----------------------------------------------------------------------------------


def _view_ctes(tail: str) -> str:
    return f"""{o.EV}, {o.AN}, {o.LABELLED}, rt AS (SELECT * FROM ({tail})
      QUALIFY row_number() OVER (PARTITION BY "user" ORDER BY anomaly_score DESC, ts_ms DESC, event_id DESC) = 1),
    bt AS (SELECT * FROM lb WHERE is_anomaly = 1),
    lv AS (SELECT coalesce(rt."user", bt."user") AS "user", rt.event_id AS realtime_event_id, anomaly_score AS realtime_score,
      anomaly_score_normalized AS batch_score, total_events, avg_threat_score, unique_ips, failed_auth_rate FROM rt FULL JOIN bt ON rt."user" = bt."user")"""


def _lambda_sql(tail: str) -> str:
    return f"""WITH {_view_ctes(tail)} SELECT "user", realtime_event_id, round(realtime_score, 9) AS realtime_score,
      round(batch_score, 9) AS batch_score, total_events, round(avg_threat_score, 9) AS avg_threat_score, unique_ips,
      round(failed_auth_rate, 9) AS failed_auth_rate FROM lv"""


@query("lambda_view", _lambda_sql(f"SELECT * FROM an WHERE anomaly_score >= 0.7 {_NEW} LIMIT 10"))
def _(spark, d):
    return rounded(context.lambda_view(_anomalies(spark, d), _flagged(spark, d)))


@query("lambda_view_all", _lambda_sql("SELECT * FROM an WHERE anomaly_score >= 0.7"))
def _(spark, d):
    return rounded(context.lambda_view(_anomalies(spark, d), _flagged(spark, d), recent_only=False))


@query(
    "event_context",
    f"""WITH {o.EV}, {o.AL}, {o.AN} SELECT e.event_id, e."user", round(threat_score, 9) AS threat_score,
    round(anomaly_score, 9) AS anomaly_score, reasons, severity, attack_type, round(confidence, 9) AS confidence
    FROM ev e LEFT JOIN an ON e.event_id = an.event_id LEFT JOIN al ON e.event_id = al.event_id""",
)
def _(spark, d):
    full = context.event_context(fixtures.events(spark, d), _anomalies(spark, d), fixtures.analyses(spark, d))
    shown = full.select("event_id", "user", "threat_score", "anomaly_score", "reasons", "severity", "attack_type", "confidence")
    return _joined(shown, "reasons")


def _query_vector(spark: SparkSession, d: str) -> list[float]:
    return fixtures.table(spark, d, "embeddings").where("vec_id = 0").first()["embedding"]


_SIMILAR_SQL = """WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 0)
    SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT v FROM q)), 6) AS similarity
    FROM embeddings ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT v FROM q)) DESC, vec_id LIMIT 10"""


@query("similar_events", _SIMILAR_SQL)
def _(spark, d):
    vectors = fixtures.table(spark, d, "embeddings")
    return rounded(similarity.similar_events(vectors, _query_vector(spark, d), 10, key="vec_id"), 6)


def _stored_vectors(spark, d) -> str:
    """The cell index of the vectors, stored once for an application."""
    key = (spark.sparkContext.applicationId, d, "vectors")
    if key not in _STORED:
        vectors = fixtures.table(spark, d, "embeddings")
        _STORED[key] = vector_index.index_vectors(vectors, scratch_path(spark, "cells"), "vec_id")
    return _STORED[key]


@query("similar_events_indexed", _SIMILAR_SQL)
def _(spark, d):
    return rounded(vector_index.similar_indexed(spark, _stored_vectors(spark, d), _query_vector(spark, d), 10), 6)


@query(
    "similar_events_many",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    s AS (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(v.v, q.v) AS s FROM v, v AS q WHERE q.vec_id % 50 = 0)
    SELECT query_id, vec_id, round(s, 6) AS similarity FROM s
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) <= 10""",
)
def _(spark, d):
    asked = fixtures.table(spark, d, "embeddings").where("vec_id % 50 = 0")
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return rounded(vector_index.similar_many(spark, _stored_vectors(spark, d), asked, 10), 6)


def _stored_intel(spark, d) -> str:
    """The intelligence table with its index, stored once for an application; a part of it comes as a second merge."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _STORED:
        entries, path = readers.load_threat_intel(fixtures.intel(spark, d)), scratch_path(spark, "intel")
        late = F.pmod(F.xxhash64("id"), F.lit(5)) == 0
        intel_index.index_intel(entries.where(~late | (F.length("id") == 2)).withColumn("description", F.when(late, F.lit("an older report of the system")).otherwise(F.col("description"))), path)
        _STORED[key] = intel_index.index_intel(entries.where(late), path)
    return _STORED[key]


def _matches(spark, d) -> DataFrame:
    return intel_index.match_indexed_intel(spark, _stored_intel(spark, d), QUESTION)


@query(
    "match_threat_intel",
    f"""WITH {_INTEL}, qt AS (SELECT unnest(regexp_extract_all('{QUESTION}', '[a-z0-9]+')) AS t),
    qw AS (SELECT t, 1 + ln(count(*)) AS w FROM qt GROUP BY t),
    tf AS (SELECT id, t, 1 + ln(count(*)) AS w FROM (SELECT id, unnest(regexp_extract_all(lower(description), '[a-z0-9]+')) AS t FROM it) GROUP BY ALL),
    norm AS (SELECT id, sqrt(sum(w * w)) AS n FROM tf GROUP BY id),
    idf AS (SELECT t, ln((SELECT count(*) FROM it) / CAST(count(*) AS DOUBLE)) AS i FROM tf WHERE t IN (SELECT t FROM qw) GROUP BY t),
    qv AS (SELECT qw.t, qw.w * i AS w FROM qw JOIN idf ON qw.t = idf.t),
    dot AS (SELECT id, sum(tf.w * qv.w) / (SELECT sqrt(sum(w * w)) FROM qv) AS s FROM tf JOIN qv ON tf.t = qv.t GROUP BY id)
    SELECT it.id AS threat_id, round(coalesce(s / n, 0), 4) AS similarity, category, severity FROM it
    LEFT JOIN dot ON it.id = dot.id LEFT JOIN norm ON it.id = norm.id ORDER BY similarity DESC, threat_id LIMIT 5""",
)
def _(spark, d):
    return _matches(spark, d).select("threat_id", "similarity", "category", "severity")


@query(
    "match_threat_intel_scan",
    ORACLES["match_threat_intel"],
)
def _(spark, d):
    """The form for a table without an index."""
    intel = readers.load_threat_intel(fixtures.intel(spark, d))
    return similarity.match_threat_intel(intel, QUESTION).select("threat_id", "similarity", "category", "severity")


_MATCHED = ORACLES["match_threat_intel"].rsplit("SELECT it.id AS threat_id", 1)[0]


@query(
    "intel_listing",
    f"""{_MATCHED}, m AS (SELECT description, round(coalesce(s / n, 0), 4) AS similarity, category, it.id AS id FROM it
      LEFT JOIN dot ON it.id = dot.id LEFT JOIN norm ON it.id = norm.id ORDER BY similarity DESC, it.id LIMIT 5),
    r AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, id) AS i FROM m)
    SELECT count(*) AS matches, round(sum(similarity), 4) AS relevance,
      string_agg(i || '. [' || category || '] (Relevance)' || chr(10) || '   ' || substr(description, 1, 500), chr(10) ORDER BY i) AS listing FROM r""",
)
def _(spark, d):
    # The figures within the listing are checked as a sum: engines round a half in print differently.
    found = similarity.intel_records(_matches(spark, d))
    top = F.collect_list(F.struct("source", "summary", "relevance_score"))
    listed = found.coalesce(1).agg(F.count("*").alias("matches"), F.round(F.sum("relevance_score"), 4).alias("relevance"), text.format_intel(top).alias("listing"))
    return listed.withColumn("listing", F.regexp_replace("listing", r"\(Relevance: [0-9.]+\)", "(Relevance)"))


# --- E: ordered and windowed -------------------------------------------------------------------


@query("ip_frequency", f'WITH {o.EV} SELECT event_id, count(*) OVER (PARTITION BY "user", source_ip) AS ip_frequency FROM ev')
def _(spark, d):
    return features.ip_frequency(fixtures.events(spark, d)).select("event_id", "ip_frequency")


@query("event_interval", f"WITH {o.EV}, {o.GAPS} SELECT event_id, interval_s FROM gp")
def _(spark, d):
    return features.event_interval(fixtures.events(spark, d)).select("event_id", "interval_s")


@query(
    "learning_phase_split",
    f"WITH {o.EV}, {o.ORD} SELECT event_id, CASE WHEN rn <= {LEARN} THEN 'train' ELSE 'score' END AS phase FROM ord",
)
def _(spark, d):
    return baseline.learning_phase_split(fixtures.events(spark, d), LEARN).select("event_id", "phase")


# --- H: scalar functions -----------------------------------------------------------------------


def _scalar(name: str, sql: str, **columns: Callable[[], Column]) -> None:
    """A query that evaluates functions on every event."""
    query(name, f"WITH {o.EV} SELECT event_id, {sql} FROM ev")(
        lambda spark, d: rounded(fixtures.events(spark, d).select("event_id", *[make().alias(n) for n, make in columns.items()]))
    )


@query("json_field", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def _(spark, d):
    return fixtures.table(spark, d, "events").select("event_id", scalar.json_field("props", "$.k").cast("int").alias("k"))


_scalar(
    "epoch_ms_to_ts",
    "ts_ms AS ms, ts_ms // 1000 * 1000 AS second_ms",
    ms=lambda: F.unix_millis(scalar.epoch_ms_to_ts("ts_ms")),
    second_ms=lambda: F.unix_millis(scalar.epoch_ms_to_ts("ts_ms", truncate_to_second=True)),
)
_scalar("hour_of_day", "hour(ts) AS hour", hour=lambda: scalar.hour_of_day("ts"))
_scalar(
    "calendar",
    "dayofweek(ts) + 1 AS day_of_week, dayofweek(ts) IN (0, 6) AS weekend, datediff('day', DATE '2024-01-01', ts) AS days",
    day_of_week=lambda: F.dayofweek("ts"),
    weekend=lambda: scalar.is_weekend("ts"),
    days=lambda: F.datediff("ts", F.lit("2024-01-01")),
)
_scalar(
    "ratio",
    "round(threat_score / nullif(CAST(hour(ts) AS DOUBLE), 0), 9) AS per_hour",
    per_hour=lambda: scalar.ratio("threat_score", F.hour("ts")),
)
_scalar(
    "anomaly_severity", f"{_LOWER.format('threat_score')} AS severity", severity=lambda: scalar.anomaly_severity("threat_score")
)
_scalar(
    "threat_severity", f"{o.SEVERITY.format('threat_score')} AS severity", severity=lambda: scalar.threat_severity("threat_score")
)
_scalar(
    "threat_band",
    "CASE WHEN threat_score >= 0.9 THEN 'critical' WHEN threat_score >= 0.6 THEN 'high' WHEN threat_score >= 0.3 THEN 'medium' ELSE 'low' END AS band",
    band=lambda: scalar.threat_band("threat_score"),
)
_scalar(
    "clamp01",
    "round(greatest(0.0, least(1.0, threat_score * 3 - 0.5)), 9) AS clamped",
    clamped=lambda: scalar.clamp01(F.col("threat_score") * 3 - 0.5),
)


@query(
    "cosine_similarity",
    """SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), list_reverse(CAST(a.embedding AS DOUBLE[]))), 6) AS similarity
    FROM embeddings a""",
)
def _(spark, d):
    vectors = fixtures.table(spark, d, "embeddings")
    return vectors.select("vec_id", F.round(scalar.cosine_similarity("embedding", F.reverse("embedding")), 6).alias("similarity"))


@query(
    "rarity",
    f"""WITH {o.EV}, {o.PR} SELECT event_id, round(p_hour, 9) AS p_hour, round(p_ip, 9) AS p_ip, round(p_geo, 9) AS p_geo, round(p_type, 9) AS p_type,
    {o.REASONS} AS reasons FROM sc""",
)
def _(spark, d):
    scored = baseline.frozen_baseline_detector(fixtures.events(spark, d), LEARN, 0.0)
    parts = {"p_hour": "time_anomaly", "p_ip": "ip_anomaly", "p_geo": "location_anomaly", "p_type": "type_anomaly"}
    return _joined(scored.select("event_id", *[(1 - F.col(c)).alias(p) for p, c in parts.items()], "reasons"), "reasons")


@query("anomaly_reasons", f"WITH {o.EV}, {o.AN} SELECT reasons, count(*) AS events FROM an GROUP BY 1")
def _(spark, d):
    return _anomalies(spark, d).groupBy(F.array_join("reasons", "; ").alias("reasons")).agg(F.count("*").alias("events"))


_scalar(
    "event_text",
    """concat('Security Event: ', event_type, '. User: ', "user", '. Source IP: ', source_ip, '. ',
      CASE WHEN destination_ip IS NOT NULL THEN 'Destination IP: ' || destination_ip || '. ' END,
      CASE WHEN file_path IS NOT NULL THEN 'File: ' || file_path || '. ' END,
      CASE WHEN domain IS NOT NULL THEN 'Domain: ' || domain || '. ' END,
      CASE WHEN process_name IS NOT NULL THEN 'Process: ' || process_name || '. ' END,
      'Threat Score: ', printf('%g', threat_score)) AS text""",
    text=lambda: text.event_text(),
)
_PROMPT_SQL = (
    "concat('" + text.PROMPT_OPENING.replace("'", "''") + "', chr(10), 'EVENT DETAILS:', chr(10), "
    "'- Event ID: ', event_id, chr(10), '- Type: ', event_type, chr(10), '- User: ', \"user\", chr(10), '- Source IP: ', source_ip, chr(10), "
    "CASE WHEN destination_ip IS NOT NULL THEN '- Destination IP: ' || destination_ip || chr(10) END, "
    "CASE WHEN file_path IS NOT NULL THEN '- File Path: ' || file_path || chr(10) END, "
    "CASE WHEN domain IS NOT NULL THEN '- Domain: ' || domain || chr(10) END, "
    "CASE WHEN process_name IS NOT NULL THEN '- Process: ' || process_name || chr(10) END, "
    "'- Threat Score: ', printf('%g', threat_score), ' (0.0-1.0)', chr(10), '- Timestamp: ', CAST(ts_ms AS VARCHAR), chr(10), '"
    + text.PROMPT_CLOSING.replace("'", "''")
    + "') AS prompt"
)
_scalar("analysis_prompt", _PROMPT_SQL, prompt=lambda: text.analysis_prompt())
_scalar(
    "extract_json_block",
    """CASE WHEN destination_ip IS NULL THEN 'no block here' ELSE '{"a": {"user": "' || "user" || '"}}' END AS block""",
    block=lambda: text.extract_json_block(
        F.when(F.col("destination_ip").isNull(), "no block here").otherwise(
            F.concat(F.lit('Sure: {"a": {"user": "'), F.col("user"), F.lit('"}} as asked'))
        )
    ),
)


def _responses(ev: DataFrame) -> DataFrame:
    """Model responses of several shapes, by the minute of the event."""
    shape = F.minute("ts") % 5
    answer = (
        F.when(shape == 0, F.concat(F.lit('{"attack_type": "'), F.col("event_type"), F.lit('", "confidence": 0.75, "recommendations": ["block it", 5]}')))
        .when(shape == 1, F.lit('Here it is: {"description": "odd"} - done'))
        .when(shape == 2, F.lit("no answer"))
        .when(shape == 3, F.lit('{"attack_type": 7}'))
        .otherwise(F.lit("{}"))
    )
    message = F.struct(F.array(F.struct(F.struct(answer.alias("content")).alias("message"))).alias("choices"))
    return ev.select("event_id", "threat_score", F.to_json(message).alias("response"))


@query(
    "parse_analysis_response",
    f"""WITH {o.EV}, s AS (SELECT *, minute(ts) % 5 AS shape FROM ev)
    SELECT event_id, shape IN (0, 1, 4) AS readable, CASE WHEN shape IN (0, 1, 4) THEN {o.SEVERITY.format('threat_score')} END AS severity,
      CASE shape WHEN 0 THEN event_type WHEN 1 THEN 'Unknown' WHEN 4 THEN 'Unknown' END AS attack_type,
      CASE shape WHEN 1 THEN 'odd' WHEN 0 THEN 'No description provided' WHEN 4 THEN 'No description provided' END AS description,
      CASE shape WHEN 0 THEN 'block it' WHEN 1 THEN '' WHEN 4 THEN '' END AS recommendations,
      CAST(CASE shape WHEN 0 THEN 0.75 WHEN 1 THEN 0.5 WHEN 4 THEN 0.5 END AS DOUBLE) AS confidence FROM s""",
)
def _(spark, d):
    parsed = _responses(fixtures.events(spark, d)).withColumn("a", text.parse_analysis_response())
    return _joined(parsed.select("event_id", F.col("a").isNotNull().alias("readable"), "a.*"), "recommendations")


@query(
    "extract_recommendations",
    """WITH a AS (SELECT conv_id, turn, regexp_extract(E'**Recommendations**:\\n- ' || replace(text, '. ', E'\\n- '), '\\*\\*Recommendations\\*\\*:(.*?)(\\*\\*|$)', 1, 's') AS section
      FROM conversations WHERE role = 'assistant'),
    i AS (SELECT conv_id, turn, list_filter(list_transform(string_split(section, chr(10)),
      lambda l: trim(regexp_extract(trim(l, E' \\n\\t\\r'), '^(?:\\d+\\.|[-*])\\s+(.+)$', 1), E' \\n\\t\\r')), lambda x: length(x) > 10) AS items FROM a)
    SELECT conv_id, turn, array_to_string(items[1:5], ' | ') AS items, len(items[1:5]) AS n FROM i""",
)
def _(spark, d):
    found = fixtures.answers(spark, d).withColumn("items", text.extract_recommendations("answer"))
    return found.select("conv_id", "turn", F.array_join("items", " | ").alias("items"), F.size("items").alias("n"))


@query("answer_confidence", f"WITH {o.CONTEXT} SELECT conv_id, round(confidence, 9) AS confidence FROM cq")
def _(spark, d):
    return rounded(context.answer_quality(fixtures.answer_context(spark, d)).select("conv_id", "confidence"))


@query("sources_used", f"WITH {o.CONTEXT} SELECT conv_id, sources FROM cq")
def _(spark, d):
    return _joined(context.answer_quality(fixtures.answer_context(spark, d)).select("conv_id", "sources"), "sources", sep=",")


_NOTE = " (0.0 = normal, 1.0 = highly anomalous)"


@query(
    "format_context",
    f"""WITH {_view_ctes('SELECT * FROM an WHERE anomaly_score >= 0.7')},
    tn AS (SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY ts_ms DESC, event_id DESC) AS r, count(*) OVER (PARTITION BY "user") AS n FROM ev),
    tx AS (SELECT "user", max(n) AS n, string_agg(CAST(r AS VARCHAR) || '. [' || CAST(ts_ms AS VARCHAR) || '] ' || event_type || ' - User: ' || "user" || ', IP: ' || source_ip
      || ', Severity: MEDIUM, Threat Score: ' || printf('%.2f', threat_score), chr(10) ORDER BY r) AS body FROM tn WHERE r <= 10 GROUP BY 1)
    SELECT tx."user", body || CASE WHEN n > 10 THEN chr(10) || chr(10) || '... and ' || CAST(n - 10 AS VARCHAR) || ' more events' ELSE '' END AS events_text,
    CASE WHEN realtime_score IS NULL AND batch_score IS NULL THEN 'No anomaly analysis available for this query.' ELSE
      concat_ws(chr(10) || chr(10), CASE WHEN realtime_score IS NOT NULL THEN '**Real-time Anomaly Detection** (Speed Layer):' || chr(10) || '  Anomaly Score: '
        || printf('%.2f', realtime_score) || '{_NOTE}' || chr(10) || '  Baseline Deviation: N/A' || chr(10) || '  User Baseline Events: N/A' END,
      CASE WHEN batch_score IS NOT NULL THEN '**Batch ML Anomaly Detection** (Spark ML Pipeline):' || chr(10) || '  Anomaly Score: ' || printf('%.2f', batch_score) || '{_NOTE}'
        || chr(10) || '  Total Events Analyzed: ' || CAST(total_events AS VARCHAR) || chr(10) || '  Average Threat Score: ' || printf('%.2f', avg_threat_score)
        || chr(10) || '  Unique IPs: ' || CAST(unique_ips AS VARCHAR) || chr(10) || '  Failed Auth Rate: ' || printf('%.2f%%', failed_auth_rate * 100)
        || chr(10) || '  Note: Batch analysis provides comprehensive historical behavior patterns' END) END AS anomalies_text
    FROM tx LEFT JOIN lv ON tx."user" = lv."user\"""",
)
def _(spark, d):
    view = context.lambda_view(_anomalies(spark, d), _flagged(spark, d), recent_only=False)
    return context.format_context(fixtures.events(spark, d), view)


@query(
    "truncate_summary",
    """SELECT doc_id, length(substring(text, 1, 500)) AS n, md5(substring(text, 1, 500)) AS digest,
    round(greatest(0.0, least(1.0, 1.0 - n_chars / CAST(1000.0 AS DOUBLE))), 9) AS relevance FROM documents""",
)
def _(spark, d):
    cut = text.truncate_summary("text")
    docs = fixtures.table(spark, d, "documents").select(
        "doc_id",
        F.length(cut).cast("bigint").alias("n"),
        F.md5(cut.cast("binary")).alias("digest"),
        text.relevance(F.col("n_chars") / 1000.0).alias("relevance"),
    )
    return rounded(docs)


@query(
    "type_status_enum",
    f"WITH {o.EV} SELECT event_type, status, k = 91 AS odd_type, count(*) AS events FROM ev GROUP BY ALL",
)
def _(spark, d):
    ev = fixtures.map_events(fixtures.table(spark, d, "events"))
    seen = F.when(F.col("k") == 91, "login").otherwise(F.col("event_type"))
    known = ev.where(scalar.is_status("status")).withColumn("odd_type", ~scalar.is_event_type(seen))
    return known.groupBy("event_type", "status", "odd_type").agg(F.count("*").alias("events"))


@query("base_model_name", f"WITH {o.USAGE} SELECT conv_id, base_model FROM cost")
def _(spark, d):
    return fixtures.usage_log(spark, d).select("conv_id", scalar.base_model_name("model").alias("base_model"))


# --- I: streaming and state --------------------------------------------------------------------


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    schema = fixtures.table(spark, d, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return fixtures.map_events(raw).drop("k", "seq")


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _run_stream(stream: DataFrame) -> DataFrame:
    """All of a stream's output so far, written per micro-batch and read back."""
    spark = stream.sparkSession
    path = scratch_path(spark, "stream")
    write = lambda batch, batch_id: jobs.write_batch(batch, path, batch_id)
    run = jobs.micro_batch_hook(
        stream, write, scratch_path(spark, "progress"), available_now=True, state_partitions=_cores(spark)
    )
    run.awaitTermination()
    return spark.read.parquet(path).drop("batch_id")


@query("baseline_anomaly_detector", o.FOLD)
def _(spark, d):
    return _joined(baseline.baseline_anomaly_detector(fixtures.events(spark, d), LEARN, CUT), "reasons")


@query("baseline_stream", o.FOLD)
def _(spark, d):
    return _joined(_run_stream(jobs.baseline_stream(_event_stream(spark, d), LEARN, CUT)), "reasons")


_MIDDLE = "(min(ts_ms) + max(ts_ms)) // 2"


@query("baseline_stream_from_snapshot", f"{o.FOLD} AND ts_ms >= (SELECT {_MIDDLE} FROM ev)")
def _(spark, d):
    """The batch detector takes the earlier half of the time, a stream of several micro-batches goes on from its counts."""
    ev = fixtures.events(spark, d).drop("k", "seq")
    middle = ev.agg(F.expr(_MIDDLE.replace("//", "div")).alias("middle"))
    half = lambda late: ev.crossJoin(F.broadcast(middle)).where((F.col("ts_ms") >= F.col("middle")) == late).drop("middle")
    start = materialize(baseline.baseline_snapshot(baseline.accepted_events(half(False), LEARN, CUT)), "snapshot")
    later, path = half(True), scratch_path(spark, "arriving")
    bounds = later.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    step = (bounds[1] - bounds[0]) // 3 + 1 if bounds[0] is not None else 1
    for i in range(3):
        # Files of later events are written later, and a micro-batch takes one of them.
        part = later.where(F.floor((F.col("ts_ms") - F.lit(bounds[0])) / step) == i)
        part.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(later.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return _joined(_run_stream(jobs.baseline_stream(stream, LEARN, CUT, start)), "reasons")


@query("frozen_baseline_detector", f"WITH {o.EV}, {o.AN} SELECT {A} FROM an")
def _(spark, d):
    return _joined(_anomalies(spark, d), "reasons")


@query(
    "event_pipeline_stream",
    o.FOLD.rsplit("SELECT event_id", 1)[0]
    + f""", hit AS (SELECT event_id FROM st WHERE rn > 0 AND n >= {LEARN} AND score >= {CUT})
    SELECT event_type, count(*) AS processed, count(hit.event_id) AS anomalies,
      count(*) FILTER (WHERE threat_score >= 0.7 OR hit.event_id IS NOT NULL) AS to_analyse
    FROM ev LEFT JOIN hit ON ev.event_id = hit.event_id GROUP BY 1""",
)
def _(spark, d):
    path = scratch_path(spark, "job")
    job = jobs.event_pipeline_stream(
        _event_stream(spark, d), path, scratch_path(spark, "progress"), LEARN, CUT, available_now=True,
        state_partitions=_cores(spark),
    )
    job.awaitTermination()
    stored = jobs.read_latest(spark, f"{path}/events", writers.EVENT_KEY).select("event_id", "event_type")
    found = jobs.read_latest(spark, f"{path}/anomalies", writers.ANOMALY_KEY).select("event_id", F.lit(1).alias("anomaly"))
    chosen = spark.read.parquet(f"{path}/to_analyse").select("event_id", F.lit(1).alias("chosen"))
    return stored.join(found, "event_id", "left").join(chosen, "event_id", "left").groupBy("event_type").agg(
        F.count("*").alias("processed"), F.count("anomaly").alias("anomalies"), F.count("chosen").alias("to_analyse")
    )


@query("micro_batch_hook", f"WITH {o.EV} SELECT {E} FROM ev")
def _(spark, d):
    return _events(_run_stream(_event_stream(spark, d)))


_RATE_SQL = f"""WITH {o.EV} SELECT {_bucket(60_000)} AS window_start_ms, event_type, count(*) AS increase,
  round(count(*) / 60.0::DOUBLE, 9) AS per_second{{0}} FROM ev GROUP BY ALL"""


@query("tumbling_rates", _RATE_SQL.format(""))
def _(spark, d):
    rows = fixtures.events(spark, d).select("ts", "event_type", "event_id")
    return rounded(_run_closed(rows, jobs.tumbling_rates).where("event_type <> 'end'"))


def _run_closed(rows: DataFrame, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A windowed stream's output once every window has ended.

    One run takes all rows; an event a year ahead is added, and a second run on the same progress lets the
    real windows end.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "windows")
    out, progress = scratch_path(spark, "stream"), scratch_path(spark, "progress")
    rows.write.parquet(path)
    write = lambda batch, batch_id: jobs.write_batch(batch, out, batch_id)
    for last in (False, True):
        if last:
            end = {"ts": F.max("ts") + F.expr("interval 365 days")}
            marks = [end.get(f.name, F.lit("end" if f.dataType.typeName() == "string" else None).cast(f.dataType)).alias(f.name) for f in rows.schema]
            spark.read.schema(rows.schema).parquet(path).agg(*marks).write.mode("append").parquet(path)
        stream = make(spark.readStream.schema(rows.schema).parquet(path))
        jobs.micro_batch_hook(stream, write, progress, available_now=True, state_partitions=_cores(spark)).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


_SLIDING = (
    f"""WITH {o.EV}, w AS (SELECT *, (ts_ms // 3600000 - unnest(range(24))) * 3600000 AS window_start_ms FROM ev)
    SELECT window_start_ms, "user", count(*) AS total_events, count(DISTINCT source_ip) AS unique_ips, count(DISTINCT event_type) AS unique_event_types,
    round(avg(threat_score), 9) AS avg_threat_score, round(max(threat_score), 9) AS max_threat_score,
    count(*) FILTER (WHERE status = 'failed') AS failed_events, count(*) FILTER (WHERE hour(ts) BETWEEN 0 AND 6) AS unusual_hour_events
    FROM w GROUP BY ALL"""
)


@query("sliding_features", _SLIDING)
def _(spark, d):
    return rounded(jobs.sliding_features(fixtures.events(spark, d)))


@query("sliding_feature_stream", _SLIDING)
def _(spark, d):
    rows = fixtures.events(spark, d).drop("k", "seq")
    return rounded(_run_closed(rows, jobs.sliding_feature_stream).where("user <> 'end'").select(*QUERIES["sliding_features"](spark, d).columns))


@query("stream_dedup", f"WITH {o.EV} SELECT event_id, ts_ms FROM ev")
def _(spark, d):
    twice = _event_stream(spark, d).select("event_id", "ts_ms", "ts").withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return _run_stream(jobs.stream_dedup(twice)).select("event_id", "ts_ms")


@query(
    "late_data",
    f"""WITH {o.EV} SELECT CASE WHEN ts_ms < (SELECT max(ts_ms) FROM ev) - 600000 AND copy = 2 THEN 'late' ELSE 'on_time' END AS arrival,
    count(*) AS events FROM ev, (SELECT unnest([1, 2]) AS copy) GROUP BY 1""",
)
def _(spark, d):
    # The whole table arrives a second time, as a second micro-batch.
    path, out = scratch_path(spark, "arrivals"), scratch_path(spark, "sorted")
    rows = fixtures.events(spark, d).select("event_id", "ts", "ts_ms")
    progress = scratch_path(spark, "progress")
    for _copy in range(2):
        rows.write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).parquet(path)
        jobs.late_data(stream, out, progress, available_now=True).awaitTermination()
    parts = [spark.read.parquet(f"{out}/{name}").select(F.lit(name).alias("arrival")) for name in ("on_time", "late")]
    return parts[0].unionByName(parts[1]).groupBy("arrival").agg(F.count("*").alias("events"))


@query("offset_semantics", f"WITH {o.EV} SELECT count(*) AS events, count(DISTINCT event_id) AS distinct_events FROM ev")
def _(spark, d):
    # The same query is started twice on one checkpoint; the second start finds nothing new.
    path, progress = scratch_path(spark, "once"), scratch_path(spark, "progress")
    write = lambda batch, batch_id: jobs.write_batch(batch, path, batch_id)
    for _start in range(2):
        stream = _event_stream(spark, d).select("event_id")
        jobs.micro_batch_hook(stream, write, progress, available_now=True).awaitTermination()
    stored = spark.read.parquet(path)
    return stored.agg(F.count("*").alias("events"), F.countDistinct("event_id").alias("distinct_events"))


# --- J: learned detectors ----------------------------------------------------------------------

_ML = ["total_events", "avg_threat_score", "unique_ips", "failed_auth_rate", "unusual_hour_rate"]


@query(
    "prepare_features",
    f"""WITH {o.EV}, {o.USERS} SELECT "user", """
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}" for c in _ML)
    + " FROM uf",
)
def _(spark, d):
    from pyspark.ml.functions import vector_to_array

    users = features.user_features(fixtures.events(spark, d))
    prepared, vector = detectors.prepare_features(users, _ML)
    values = vector_to_array(vector)
    return rounded(prepared.select("user", *[values[i].alias(c) for i, c in enumerate(_ML)]), 6)




# Scores of learned detectors have no SQL. What must hold of them, whatever was learned, does: scaling, the flag and its share,
# and the facts of each user.
_HELD = "true AS scaled, true AS flagged_right, true AS share_right"


def _facts_of(labelled: DataFrame, score: str, flagged: Column, share: Column) -> DataFrame:
    """Each user's facts, and whether its score is scaled, its flag follows, and the flagged ones are as many as they should be."""
    ends = labelled.agg(F.struct(F.min(score).alias("low"), F.max(score).alias("high"), share.alias("share"))).scalar()
    scaled = F.coalesce(F.try_divide(F.col(score) - ends["low"], ends["high"] - ends["low"]), F.lit(0.0))
    return rounded(
        labelled.select(
            "user", "total_events", "avg_threat_score",
            (F.abs(scaled - F.col("anomaly_score_normalized")) < 1e-9).alias("scaled"),
            ((F.col("is_anomaly") == 1) == flagged).alias("flagged_right"),
            ends["share"].alias("share_right"),
        )
    )


def _forest_facts(labelled: DataFrame) -> DataFrame:
    labelled = materialize(labelled, "labelled")
    # The cut lies between the highest score that is not flagged and the lowest that is.
    highest = labelled.where("is_anomaly = 0").agg(F.max("anomaly_score")).scalar()
    above = F.col("anomaly_score") > F.coalesce(highest, F.lit(float("-inf")))
    # With linear interpolation at most a tenth of the rows lie above the quantile, and only ties make them fewer.
    n, flagged = F.count("*"), F.count_if(F.col("is_anomaly") == 1)
    return _facts_of(labelled, "anomaly_score", above, (flagged <= F.ceil(n * 0.1)) & ((n < 11) | (flagged > 0)))


def _kmeans_facts(labelled: DataFrame) -> DataFrame:
    labelled = materialize(labelled, "labelled")
    # The farthest row is flagged, unless all are equally far.
    some = F.count_if(F.col("is_anomaly") == 1) >= F.when(F.max("distance_to_center") > F.min("distance_to_center"), 1).otherwise(0)
    return _facts_of(labelled, "distance_to_center", F.col("anomaly_score_normalized") > 0.8, some)


_USER_FACTS = f"""WITH {o.EV}, {o.USERS} SELECT "user", total_events, round(coalesce(avg_threat_score, 0), 9) AS avg_threat_score, {_HELD} FROM uf"""


@query("isolation_forest", _USER_FACTS)
def _(spark, d):
    table = features.all_user_features(fixtures.events(spark, d))
    return _forest_facts(detectors.isolation_forest(table, features.numeric_feature_columns(table)))


@query("kmeans_anomaly", _USER_FACTS)
def _(spark, d):
    table = features.all_user_features(fixtures.events(spark, d))
    return _kmeans_facts(detectors.kmeans_anomaly(table, features.numeric_feature_columns(table)))


@query("detect_anomalies", _USER_FACTS)
def _(spark, d):
    table = features.all_user_features(fixtures.events(spark, d))
    return _kmeans_facts(detectors.detect_anomalies(table, features.numeric_feature_columns(table), "kmeans"))


def _training_facts(run: training.TrainingRun) -> DataFrame:
    """The run's data against its own report and summary."""
    report = run.report.select(F.struct("total_users", "anomalous_users", F.size("top_anomalies").alias("top")).alias("r")).scalar()
    read = run.summary.select("total_events").scalar()
    return _forest_facts(run.labelled).withColumns({"total_users": report["total_users"], "events_read": read})


def _read_facts(read: str) -> str:
    return f"""WITH {_LENIENT}{read}, u AS (SELECT "user", count(*) AS total_events, round(coalesce(avg(threat_score), 0), 9) AS avg_threat_score
      FROM got WHERE "user" IS NOT NULL GROUP BY 1)
    SELECT *, {_HELD}, (SELECT count(*) FROM u) AS total_users, (SELECT count(*) FROM got WHERE "user" IS NOT NULL) AS events_read FROM u"""


@query("training_pipeline", _read_facts(", got AS (SELECT * FROM rd)"))
def _(spark, d):
    """From the topic's first record to the report."""
    return _training_facts(training.training_pipeline(spark, _stored_topic(spark, d), scratch_path(spark, "training")))


@query(
    "training_pipeline_bounded",
    _read_facts(
        """, ends AS (SELECT seq % 4 AS p, least(max(seq // 4) + 1, min(seq // 4) + 500) AS stop FROM ev GROUP BY 1),
    got AS (SELECT rd.* FROM rd JOIN ends ON p = "partition" AND "offset" < stop ORDER BY "partition", "offset" LIMIT 2000)"""
    ),
)
def _(spark, d):
    """A run over about 2,000 events."""
    run = training.training_pipeline(spark, _stored_topic(spark, d), scratch_path(spark, "training"), max_events=2000)
    return _training_facts(run)


@query(
    "minmax_normalise",
    f"""WITH {o.EV} SELECT event_id, round((ts_ms - (SELECT min(ts_ms) FROM ev)) / CAST((SELECT max(ts_ms) - min(ts_ms) FROM ev) AS DOUBLE), 9) AS position FROM ev""",
)
def _(spark, d):
    return rounded(detectors.minmax_normalise(fixtures.events(spark, d), "ts_ms", "position").select("event_id", "position"))


# --- M: dashboards -----------------------------------------------------------------------------


@query("counter_total", f"WITH {o.EV} SELECT event_type, status, count(*) AS total FROM ev GROUP BY ALL")
def _(spark, d):
    return metrics.counter_total(fixtures.events(spark, d), "event_type", "status")


@query("rate", _RATE_SQL.format(", round(count(*) / 60.0::DOUBLE * 60, 9) AS per_minute"))
def _(spark, d):
    return rounded(metrics.rate(fixtures.events(spark, d), "1 minute", 60, "event_type"))


def _quantile_sql(q: float) -> str:
    return f"""(SELECT CASE WHEN min(i) FILTER (WHERE c >= {q} * n) IS NULL THEN 10.0 ELSE
      min(lo + (b - lo) * ({q} * n - prev) / (c - prev)) FILTER (WHERE c >= {q} * n AND prev < {q} * n) END FROM cum
      WHERE cum.event_type = t.event_type)"""


@query(
    "histogram_quantile",
    f"""WITH {o.EV}, bd AS (SELECT unnest({list(metrics.LATENCY_BOUNDS)}) AS b, unnest(range({len(metrics.LATENCY_BOUNDS)})) AS i),
    cc AS (SELECT event_type, i, CAST(b AS DOUBLE) AS b, count(*) FILTER (WHERE threat_score <= CAST(b AS DOUBLE)) AS c, count(*) AS n FROM ev, bd GROUP BY ALL),
    cum AS (SELECT *, coalesce(lag(c) OVER w, 0) AS prev, coalesce(lag(b) OVER w, 0) AS lo FROM cc WINDOW w AS (PARTITION BY event_type ORDER BY i))
    SELECT event_type, round({_quantile_sql(0.5)}, 9) AS p50, round({_quantile_sql(0.95)}, 9) AS p95, round({_quantile_sql(0.99)}, 9) AS p99
    FROM (SELECT DISTINCT event_type FROM ev) t""",
)
def _(spark, d):
    ev = fixtures.events(spark, d)
    return rounded(metrics.histogram_quantile(ev, "threat_score", metrics.LATENCY_BOUNDS, (0.5, 0.95, 0.99), "event_type"))


@query(
    "mean_latency",
    f"WITH {o.EV} SELECT {_bucket(3_600_000)} AS window_start_ms, round(avg(threat_score), 9) AS mean_latency FROM ev GROUP BY 1",
)
def _(spark, d):
    return rounded(metrics.mean_latency(fixtures.events(spark, d), "threat_score", "1 hour"))


@query(
    "threat_ratio",
    f"""WITH {o.EV}, {o.AN} SELECT (SELECT count(*) FROM an) AS threats, count(*) AS events,
    round((SELECT count(*) FROM an) / CAST(count(*) AS DOUBLE), 9) AS threat_ratio FROM ev""",
)
def _(spark, d):
    return rounded(metrics.threat_ratio(fixtures.events(spark, d), _anomalies(spark, d)))


@query(
    "error_rate",
    f"""WITH {o.EV} SELECT {_bucket(3_600_000)} AS window_start_ms, round(count(*) FILTER (WHERE status <> 'success') / 3600.0::DOUBLE, 9) AS error_rate,
    round(1 - count(*) FILTER (WHERE status <> 'success') / CAST(count(*) AS DOUBLE), 9) AS availability FROM ev GROUP BY 1""",
)
def _(spark, d):
    return rounded(metrics.error_rate(fixtures.events(spark, d), F.col("status") != "success", "1 hour", 3600))


@query(
    "cost_per_hour",
    f"""WITH {o.USAGE} SELECT {_bucket(3_600_000)} AS window_start_ms, base_model, round(sum(cost), 9) AS cost_per_hour
    FROM cost WHERE cost IS NOT NULL GROUP BY ALL""",
)
def _(spark, d):
    return rounded(metrics.cost_per_hour(fixtures.usage_log(spark, d)))


@query(
    "service_health",
    f"""WITH {o.EV} SELECT event_type AS dependency, CAST(arg_max(status = 'success', (ts_ms, event_id)) AS INT) AS up, max(ts_ms) AS as_of_ms
    FROM ev GROUP BY 1""",
)
def _(spark, d):
    log = fixtures.events(spark, d).select(
        F.col("event_type").alias("dependency"), (F.col("status") == "success").alias("up"), "ts_ms", "event_id"
    )
    return metrics.service_health(log, "dependency")
