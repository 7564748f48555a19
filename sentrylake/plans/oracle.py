"""Common table expressions for checking the queries with plain SQL on the same tables."""

from __future__ import annotations

EV = """ev AS (
  SELECT 'evt_' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id, ts, epoch_us(ts) // 1000 AS ts_ms,
    CASE event_type WHEN 'signup' THEN 'auth_attempt' WHEN 'click' THEN 'network_connection'
      WHEN 'view' THEN 'file_access' WHEN 'purchase' THEN 'process_execution' WHEN 'error' THEN 'dns_query' END AS event_type,
    CASE WHEN k < 80 THEN '192.168.1.' || CAST(user_id % 250 + 1 AS VARCHAR)
      WHEN k < 97 THEN '192.168.1.' || CAST((user_id * 7 + k % 2) % 250 + 1 AS VARCHAR)
      ELSE '192.168.2.' || CAST(k AS VARCHAR) END AS source_ip,
    CASE WHEN k % 4 <> 0 THEN '10.0.0.' || CAST(k + 1 AS VARCHAR) END AS destination_ip,
    'user_' || CAST(user_id AS VARCHAR) AS "user",
    CASE WHEN k % 50 < 3 THEN 'failed' WHEN k % 50 = 3 THEN 'blocked' ELSE 'success' END AS status,
    least(value / CAST(200.0 AS DOUBLE), CAST(1.0 AS DOUBLE)) AS threat_score,
    CASE WHEN k % 10 < 8 THEN 'primary' || CAST(user_id % 8 AS VARCHAR)
      WHEN k % 10 = 8 THEN 'alt' || CAST(k % 8 AS VARCHAR) END AS geo_location,
    CASE WHEN event_type = 'view' THEN '/srv/share/' || CAST(k AS VARCHAR) END AS file_path,
    CASE WHEN event_type = 'purchase' THEN 'proc' || CAST(k % 20 AS VARCHAR) END AS process_name,
    CASE WHEN event_type = 'error' THEN 'host' || CAST(k AS VARCHAR) || '.example' END AS domain,
    k, event_id AS seq
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""

SEVERITY = """CASE WHEN {0} >= 0.9 THEN 'CRITICAL' WHEN {0} >= 0.8 THEN 'HIGH' WHEN {0} >= 0.7 THEN 'MEDIUM' ELSE 'LOW' END"""

AL = f"""al AS (
  SELECT event_id, {SEVERITY.format('threat_score')} AS severity, 'suspicious ' || event_type AS attack_type,
    'seen from ' || source_ip AS description, 'review ' || "user" || '; block ' || source_ip AS recommendations,
    threat_score AS confidence, ts_ms // 1000 AS ts_s
  FROM ev WHERE threat_score >= 0.7)"""

# First N = 20 events per user are learned; later ones are scored against them.
LEARN = 20
CUT = 0.7

REASONS = """array_to_string(list_filter([
    CASE WHEN score >= 0.9 THEN 'CRITICAL: Highly anomalous behavior detected'
         WHEN score >= 0.7 THEN 'HIGH: Significant deviation from normal behavior' END,
    CASE WHEN p_hour < 0.05 THEN 'Unusual login time (' || lpad(CAST(hr AS VARCHAR), 2, '0') || ':00)' END,
    CASE WHEN p_ip < 0.05 THEN 'New or unusual source IP: ' || source_ip END,
    CASE WHEN p_geo < 0.05 THEN 'New or unusual location: ' || geo_location END,
    CASE WHEN p_type < 0.05 THEN 'Unusual event type: ' || event_type END,
    CASE WHEN failure > 0 THEN 'User typically has low failure rate' END], lambda x: x IS NOT NULL), '; ')"""

WEIGHTED = """(1 - p_hour) * CAST(0.25 AS DOUBLE) + (1 - p_ip) * CAST(0.30 AS DOUBLE) + (1 - p_geo) * CAST(0.20 AS DOUBLE)
    + (1 - p_type) * CAST(0.15 AS DOUBLE) + failure * CAST(0.10 AS DOUBLE)"""

ORD = """ord AS (SELECT *, hour(ts) AS hr, row_number() OVER (PARTITION BY "user" ORDER BY ts_ms, event_id) AS rn FROM ev)"""

_P = "coalesce(CAST({t}.c AS DOUBLE) / tu.n, 0.01)"

PR = f"""{ORD},
tr AS (SELECT * FROM ord WHERE rn <= {LEARN}),
tu AS (SELECT "user", count(*) AS n, CAST(count(*) FILTER (WHERE status = 'failed') AS DOUBLE) / count(*) AS fr
  FROM tr GROUP BY "user" HAVING count(*) = {LEARN}),
th AS (SELECT "user", hr, count(*) AS c FROM tr GROUP BY ALL),
ti AS (SELECT "user", source_ip, count(*) AS c FROM tr GROUP BY ALL),
tg AS (SELECT "user", geo_location, count(*) AS c FROM tr WHERE geo_location IS NOT NULL GROUP BY ALL),
tt AS (SELECT "user", event_type, count(*) AS c FROM tr GROUP BY ALL),
pr AS (SELECT o.*, {_P.format(t='th')} AS p_hour, {_P.format(t='ti')} AS p_ip,
    CASE WHEN o.geo_location IS NULL THEN 0.5 ELSE {_P.format(t='tg')} END AS p_geo, {_P.format(t='tt')} AS p_type,
    CAST(CASE WHEN o.status = 'failed' AND tu.fr < 0.1 THEN 0.8 ELSE 0.0 END AS DOUBLE) AS failure
  FROM ord o JOIN tu ON o."user" = tu."user"
  LEFT JOIN th ON o."user" = th."user" AND o.hr = th.hr
  LEFT JOIN ti ON o."user" = ti."user" AND o.source_ip = ti.source_ip
  LEFT JOIN tg ON o."user" = tg."user" AND o.geo_location = tg.geo_location
  LEFT JOIN tt ON o."user" = tt."user" AND o.event_type = tt.event_type
  WHERE o.rn > {LEARN}),
sc AS (SELECT *, greatest(0.0, least(1.0, {WEIGHTED})) AS score FROM pr)"""

AN = f"""{PR},
an AS (SELECT event_id, "user", ts_ms, score AS anomaly_score, 1 - p_hour AS time_anomaly, 1 - p_ip AS ip_anomaly,
    1 - p_geo AS location_anomaly, 1 - p_type AS type_anomaly, failure AS failure_anomaly, {REASONS} AS reasons
  FROM sc WHERE score >= {CUT})"""

# One step per event of a user; the state is the list of accepted events.
_SHARE = """CASE WHEN len(s.acc) = 0 THEN 0.5 ELSE
    coalesce(nullif(len(list_filter(s.acc, lambda x: x.{f} = o.{f})), 0) / CAST(len(s.acc) AS DOUBLE), 0.01) END"""
_STEP = f"""SELECT o.*, s.acc, len(s.acc) AS n,
      {_SHARE.format(f='hr')} AS p_hour, {_SHARE.format(f='source_ip')} AS p_ip,
      CASE WHEN o.geo_location IS NULL THEN 0.5 ELSE {_SHARE.format(f='geo_location')} END AS p_geo,
      {_SHARE.format(f='event_type')} AS p_type,
      CAST(CASE WHEN o.status = 'failed' AND coalesce(len(list_filter(s.acc, lambda x: x.status = 'failed'))
        / nullif(CAST(len(s.acc) AS DOUBLE), 0), 0) < 0.1 THEN 0.8 ELSE 0.0 END AS DOUBLE) AS failure
    FROM st s JOIN ord o ON o."user" = s."user" AND o.rn = s.rn + 1"""
FOLD = f"""WITH RECURSIVE {EV}, {ORD},
st AS (
  SELECT DISTINCT "user", CAST(0 AS BIGINT) AS rn,
    CAST([] AS STRUCT(hr BIGINT, source_ip VARCHAR, geo_location VARCHAR, event_type VARCHAR, status VARCHAR)[]) AS acc,
    CAST(NULL AS VARCHAR) AS event_id, CAST(NULL AS BIGINT) AS ts_ms, CAST(0 AS BIGINT) AS n,
    CAST(NULL AS BIGINT) AS hr, CAST(NULL AS VARCHAR) AS source_ip, CAST(NULL AS VARCHAR) AS geo_location,
    CAST(NULL AS VARCHAR) AS event_type, CAST(NULL AS DOUBLE) AS p_hour, CAST(NULL AS DOUBLE) AS p_ip,
    CAST(NULL AS DOUBLE) AS p_geo, CAST(NULL AS DOUBLE) AS p_type, CAST(NULL AS DOUBLE) AS failure,
    CAST(NULL AS DOUBLE) AS score
  FROM ord
  UNION ALL
  SELECT "user", rn,
    CASE WHEN n < {LEARN} OR score < {CUT} THEN list_append(acc, {{'hr': hr, 'source_ip': source_ip,
      'geo_location': geo_location, 'event_type': event_type, 'status': status}}) ELSE acc END,
    event_id, ts_ms, n, hr, source_ip, geo_location, event_type, p_hour, p_ip, p_geo, p_type, failure, score
  FROM (SELECT *, greatest(0.0, least(1.0, {WEIGHTED})) AS score FROM ({_STEP}) p) q)
SELECT event_id, "user", ts_ms, round(score, 9) AS anomaly_score, round(1 - p_hour, 9) AS time_anomaly,
  round(1 - p_ip, 9) AS ip_anomaly, round(1 - p_geo, 9) AS location_anomaly, round(1 - p_type, 9) AS type_anomaly,
  round(failure, 9) AS failure_anomaly, {REASONS} AS reasons
FROM st WHERE rn > 0 AND n >= {LEARN} AND score >= {CUT}"""

USERS = """uf AS (
  SELECT "user", count(*) AS total_events, count(DISTINCT source_ip) AS unique_ips,
    count(DISTINCT event_type) AS unique_event_types, avg(threat_score) AS avg_threat_score,
    max(threat_score) AS max_threat_score, count(*) FILTER (WHERE status = 'failed') AS failed_events,
    count(*) FILTER (WHERE hour(ts) BETWEEN 0 AND 6) AS unusual_hour_events,
    count(DISTINCT geo_location) AS unique_locations, epoch_us(min(ts)) // 1000 AS first_seen_ms, epoch_us(max(ts)) // 1000 AS last_seen_ms,
    count(*) FILTER (WHERE status = 'failed') / CAST(count(*) AS DOUBLE) AS failed_auth_rate,
    count(*) FILTER (WHERE hour(ts) BETWEEN 0 AND 6) / CAST(count(*) AS DOUBLE) AS unusual_hour_rate,
    count(DISTINCT source_ip) / CAST(count(*) AS DOUBLE) AS ip_diversity_score,
    datediff('day', min(ts), max(ts)) + 1 AS activity_days,
    count(*) / CAST(datediff('day', min(ts), max(ts)) + 1 AS DOUBLE) AS events_per_day
  FROM ev GROUP BY "user")"""

TYPES = ("auth_attempt", "network_connection", "file_access", "process_execution", "dns_query")
PIVOT = (
    'pv AS (SELECT "user", '
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in TYPES)
    + ' FROM ev GROUP BY "user")'
)
HOURLY = """hf AS (SELECT "user", stddev_samp(n) AS hourly_stddev, var_samp(n) AS hourly_variance,
    sum(w) / CAST(sum(n) AS DOUBLE) AS weekend_share
  FROM (SELECT "user", hour(ts) AS h, count(*) AS n, count(*) FILTER (WHERE dayofweek(ts) IN (0, 6)) AS w FROM ev GROUP BY ALL)
  GROUP BY "user")"""
IPS = """ips AS (SELECT "user", avg(f) AS avg_ip_frequency, stddev_samp(f) AS ip_frequency_stddev,
    count(*) FILTER (WHERE f = 1) AS rare_ip_count, count(*) FILTER (WHERE f = 1) / avg(f) AS rare_ip_ratio
  FROM (SELECT "user", count(*) OVER (PARTITION BY "user", source_ip) AS f FROM ev) GROUP BY "user")"""
GAPS = """gp AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT)
    - lag(CAST(floor(epoch(ts)) AS BIGINT)) OVER (PARTITION BY "user" ORDER BY ts, event_id) AS interval_s FROM ev)"""
SEQ = f"""{GAPS},
sf AS (SELECT "user", avg(interval_s) AS avg_event_interval, stddev_samp(interval_s) AS event_interval_stddev,
    min(interval_s) AS min_event_interval, count(*) FILTER (WHERE interval_s < 1) AS burst_events FROM gp GROUP BY "user")"""
FEATURES = f"{USERS}, {PIVOT}, {HOURLY}, {IPS}, {SEQ}"

# Users labelled by a plain rule, as the batch layer would label them.
LABELLED = f"""{USERS},
raw AS (SELECT *, avg_threat_score + failed_auth_rate AS raw_score FROM uf),
lb AS (SELECT *, (raw_score - lo) / (hi - lo) AS anomaly_score_normalized,
    CAST((raw_score - lo) / (hi - lo) > 0.8 AS INT) AS is_anomaly
  FROM raw, (SELECT min(raw_score) AS lo, max(raw_score) AS hi FROM raw))"""

USAGE = """us AS (SELECT conv_id,
    CASE conv_id % 3 WHEN 0 THEN 'gpt-4o-mini-2024-07-18' WHEN 1 THEN 'gpt-4o' ELSE 'local-model' END AS model,
    coalesce(sum(w) FILTER (WHERE role = 'user'), 0) AS prompt_tokens,
    coalesce(sum(w) FILTER (WHERE role = 'assistant'), 0) AS completion_tokens,
    1704067200000 + conv_id * 600000 AS ts_ms
  FROM (SELECT conv_id, role, len(regexp_split_to_array(trim(text), '\\s+')) AS w FROM conversations) GROUP BY conv_id),
cost AS (SELECT *, CASE conv_id % 3 WHEN 0 THEN prompt_tokens * (0.15::DOUBLE / 1000000) + completion_tokens * (0.60::DOUBLE / 1000000)
    WHEN 1 THEN prompt_tokens * (2.50::DOUBLE / 1000000) + completion_tokens * (10.00::DOUBLE / 1000000) END AS cost,
    CASE conv_id % 3 WHEN 0 THEN 'gpt-4o-mini' WHEN 1 THEN 'gpt-4o' ELSE 'local-model' END AS base_model FROM us)"""

CONTEXT = """cx AS (SELECT conv_id, n_events, n_intel,
    CASE WHEN n_intel > 0 THEN (conv_id % 100) / CAST(100.0 AS DOUBLE) END AS avg_relevance,
    conv_id % 3 = 0 AS has_realtime, conv_id % 4 = 0 AS has_batch
  FROM (SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS n_events,
    count(*) FILTER (WHERE role = 'assistant') AS n_intel FROM conversations GROUP BY conv_id)),
cq AS (SELECT *, least(CAST(0.99 AS DOUBLE), 0.5 + least(CAST(0.2 AS DOUBLE), n_events * CAST(0.02 AS DOUBLE))
    + coalesce(avg_relevance * CAST(0.2 AS DOUBLE), 0.0) + CASE WHEN has_realtime THEN 0.05 ELSE 0.0 END
    + CASE WHEN has_batch THEN 0.1 ELSE 0.0 END) AS confidence,
    array_to_string(list_filter(['openai', CASE WHEN n_events > 0 THEN 'java_api' END, CASE WHEN n_intel > 0 THEN 'rag_service' END,
      CASE WHEN has_batch THEN 'batch-ml' END], lambda x: x IS NOT NULL), ',') AS sources FROM cx)"""


def with_(*parts: str, select: str) -> str:
    return f"WITH {', '.join(parts)} {select}"
