"""Point, range and top-N queries over the event, anomaly and analysis tables.

Filters stay simple comparisons, so they reach the Parquet scan and its partitions; every order
ends in a unique column, and an order with a limit becomes a per-task top-N without a full sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrylake.operators.skew import attach_by_key

# Defaults of the queries.
HIGH_THREAT = 0.7
DEFAULT_LIMIT = 100
FAILED_LOGIN_SCORE = 0.5


def _top(rows: DataFrame, limit: int, *order: Column) -> DataFrame:
    """Ordered rows, cut to ``limit`` unless it is 0."""
    ordered = rows.orderBy(*order)
    return ordered.limit(limit) if limit else ordered


def _event_order(order: str) -> list[Column]:
    """Newest first by ``time``, or by the storage ``key``, whose first part is the event type."""
    newest = [F.desc("ts_ms"), F.desc("event_id")]
    return {"time": newest, "key": [F.desc("event_type"), *newest]}[order]


def event_by_id(events: DataFrame, event_id: str) -> DataFrame:
    return events.where(F.col("event_id") == event_id).orderBy(F.desc("ts_ms")).limit(1)


def events_by_type_time_range(
    events: DataFrame, event_type: str, start_ms: int, end_ms: int, limit: int = 0
) -> DataFrame:
    found = events.where((F.col("event_type") == event_type) & F.col("ts_ms").between(start_ms, end_ms))
    return _top(found, limit, F.asc("ts_ms"), F.asc("event_id"))


def latest_events_by_type(events: DataFrame, event_type: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return _top(events.where(F.col("event_type") == event_type), limit, *_event_order("time"))


def latest_events(events: DataFrame, limit: int = DEFAULT_LIMIT, order: str = "time") -> DataFrame:
    return _top(events, limit, *_event_order(order))


def events_above_threat(
    events: DataFrame, min_score: float = HIGH_THREAT, limit: int = DEFAULT_LIMIT, order: str = "time"
) -> DataFrame:
    return _top(events.where(F.col("threat_score") >= min_score), limit, *_event_order(order))


def failed_logins(events: DataFrame, limit: int = 10, by_status: bool = False, order: str = "key") -> DataFrame:
    """Sign-in events among the top ``limit`` events of at least medium threat.

    That is what the served query does: it never looks at the status. ``by_status`` instead finds
    the latest sign-ins that truly failed.
    """
    is_login = F.lower("event_type").contains("auth")
    if by_status:
        return _top(events.where(is_login & (F.col("status") == "failed")), limit, *_event_order("time"))
    return events_above_threat(events, FAILED_LOGIN_SCORE, limit, order).where(is_login)


def events_by_user(
    events: DataFrame,
    user: str,
    limit: int = DEFAULT_LIMIT,
    window_hours: float | None = None,
    now_ms: int | None = None,
    from_recent_only: bool = False,
    order: str = "time",
) -> DataFrame:
    """A user's newest events, optionally of the last ``window_hours`` before ``now_ms``.

    ``from_recent_only`` looks only among the newest ``5 * limit`` (at most 500) events of all
    users, as the served query does, and so may miss some.
    """
    mine = F.col("user") == user
    if from_recent_only:
        recent = latest_events(events, min(5 * limit, 500), order)
        return _top(recent.where(mine), limit, *_event_order(order))
    if window_hours is not None:
        end = F.lit(now_ms) if now_ms is not None else F.unix_millis(F.current_timestamp())
        mine = mine & (F.col("ts_ms") >= end - int(window_hours * 3_600_000))
    return _top(events.where(mine), limit, *_event_order(order))


def window_hours(text: str) -> float:
    """Hours of a window such as ``24h``, ``7d`` or ``2w``."""
    hours = {"h": 1, "d": 24, "w": 168}
    if not (text[:-1].isdigit() and text[-1] in hours):
        raise ValueError(f"not a time window: {text!r}")
    return int(text[:-1]) * hours[text[-1]]


def analysis_by_event(analyses: DataFrame, event_id: str) -> DataFrame:
    return analyses.where(F.col("event_id") == event_id).orderBy(F.desc("ts_s")).limit(1)


def analyses_by_time_range(analyses: DataFrame, start_s: int, end_s: int, limit: int = 0) -> DataFrame:
    return _top(analyses.where(F.col("ts_s").between(start_s, end_s)), limit, F.asc("event_id"))


def analyses_by_severity(analyses: DataFrame, severity: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return _top(analyses.where(F.upper("severity") == severity.upper()), limit, F.asc("event_id"))


def latest_analyses(analyses: DataFrame, limit: int = DEFAULT_LIMIT, order: str = "key") -> DataFrame:
    """Analyses by descending event id (``key``) or by descending time."""
    first = [F.desc("ts_s")] if order == "time" else []
    return _top(analyses, limit, *first, F.desc("event_id"))


def anomaly_by_event(anomalies: DataFrame, event_id: str) -> DataFrame:
    return anomalies.where(F.col("event_id") == event_id).orderBy(F.desc("ts_ms")).limit(1)


def anomalies_by_time_range(anomalies: DataFrame, start_ms: int, end_ms: int, limit: int = 0) -> DataFrame:
    return _top(anomalies.where(F.col("ts_ms").between(start_ms, end_ms)), limit, F.asc("ts_ms"), F.asc("event_id"))


def anomalies_by_user(anomalies: DataFrame, user: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return _top(anomalies.where(F.col("user") == user), limit, F.asc("ts_ms"), F.asc("event_id"))


def high_score_anomalies(
    anomalies: DataFrame, threshold: float = HIGH_THREAT, limit: int = DEFAULT_LIMIT, newest_first: bool = True
) -> DataFrame:
    way = F.desc if newest_first else F.asc
    return _top(anomalies.where(F.col("anomaly_score") >= threshold), limit, way("ts_ms"), way("event_id"))


def latest_anomalies(anomalies: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return _top(anomalies, limit, F.desc("ts_ms"), F.desc("event_id"))


def top_anomaly_per_user(anomalies: DataFrame) -> DataFrame:
    """Each user's highest-scored anomaly; the later one of equal scores."""
    order = Window.partitionBy("user").orderBy(F.desc("anomaly_score"), F.desc("ts_ms"), F.desc("event_id"))
    return anomalies.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def batch_anomalies(flagged: DataFrame) -> DataFrame:
    return flagged


def batch_anomaly_for_user(flagged: DataFrame, user: str) -> DataFrame:
    return flagged.where(F.col("user") == user).orderBy(F.desc("anomaly_score_normalized")).limit(1)


def expire_events(events: DataFrame, cutoff_ms: int) -> DataFrame:
    """The events that stay: those at or after the cutoff."""
    return events.where(F.col("ts_ms") >= cutoff_ms)


def expired_count(events: DataFrame, cutoff_ms: int) -> DataFrame:
    return events.agg(F.count_if(F.col("ts_ms") < cutoff_ms).alias("deleted"))


def select_for_analysis(events: DataFrame, anomalies: DataFrame, min_score: float = HIGH_THREAT) -> DataFrame:
    """Events worth an analysis: of high threat, or flagged as anomalous."""
    flagged = anomalies.select("event_id", F.lit(True).alias("is_anomalous"))
    marked = events.join(flagged, "event_id", "left").withColumn(
        "is_anomalous", F.coalesce("is_anomalous", F.lit(False))
    )
    return marked.where((F.col("threat_score") >= min_score) | F.col("is_anomalous"))


def suspicious_ip_events(
    events: DataFrame, limit: int = 10, min_score: float = HIGH_THREAT, min_hits: int = 2, **split
) -> DataFrame:
    """The newest events of addresses with at least ``min_hits`` events of high threat."""
    hits = F.count_if(F.col("threat_score") >= min_score)
    addresses = (
        events.groupBy("source_ip")
        .agg(F.count("*").alias("_events"), hits.alias("high_threat_hits"))
        .where((F.col("high_threat_hits") >= min_hits) & F.col("source_ip").isNotNull())
    )
    found = attach_by_key(events, addresses, ["source_ip"], "_events", spread="event_id", **split)
    return _top(found.drop("_events"), limit, *_event_order("time"))


def named_query(
    action: str,
    events: DataFrame,
    analyses: DataFrame,
    stats: DataFrame,
    limit: int = 10,
    min_score: float = HIGH_THREAT,
    severity: str = "HIGH",
) -> DataFrame:
    """A query by name; an unknown name gives the latest events."""
    known = {
        "recent_events": lambda: latest_events(events, limit, order="key"),
        "high_threats": lambda: events_above_threat(events, min_score, limit, order="key"),
        "failed_logins": lambda: failed_logins(events, limit),
        "stats": lambda: stats,
        "analysis_by_severity": lambda: analyses_by_severity(analyses, severity, limit),
        "suspicious_ips": lambda: suspicious_ip_events(events, limit, min_score),
        "file_access": lambda: latest_events_by_type(events, "file_access", limit),
    }
    return known.get(action, known["recent_events"])()


def supporting_events(events: DataFrame, limit: int = 10) -> DataFrame:
    """The first of the given events, in their order, as shown beside an answer, with defaults for what they lack."""
    optional = lambda name, default: (
        F.coalesce(F.col(name), F.lit(default)) if name in events.columns else F.lit(default)
    ).alias(name)
    return events.limit(limit).select(
        optional("event_id", "unknown"),
        "ts_ms",
        optional("event_type", "unknown"),
        optional("severity", "MEDIUM"),
        "user",
        "source_ip",
        optional("threat_score", 0.0),
    )
