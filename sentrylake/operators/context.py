"""Everything known about an event or a user, put side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentrylake.functions.text import (
    LISTED_EVENTS,
    answer_confidence,
    format_anomalies,
    format_events,
    sources_used,
)
from sentrylake.operators.lookups import HIGH_THREAT, high_score_anomalies, top_anomaly_per_user

RECENT_ANOMALIES = 10


def event_context(events: DataFrame, anomalies: DataFrame, analyses: DataFrame, event_id: str | None = None) -> DataFrame:
    """Events with their anomaly and their analysis; for one event the filter reaches all three scans."""
    if event_id is not None:
        events = events.where(F.col("event_id") == event_id)
    found = anomalies.select("event_id", "anomaly_score", "reasons")
    judged = analyses.select("event_id", "severity", "attack_type", "confidence")
    return events.join(found, "event_id", "left").join(judged, "event_id", "left")


def lambda_view(
    anomalies: DataFrame,
    flagged: DataFrame,
    user: str | None = None,
    recent_only: bool = True,
    min_score: float = HIGH_THREAT,
) -> DataFrame:
    """Per user the top anomaly of the speed layer beside the batch layer's row.

    With ``recent_only`` the speed layer is asked for its newest ten high-scored anomalies of all
    users, as the served view does; else for all of them.
    """
    recent = (
        high_score_anomalies(anomalies, min_score, RECENT_ANOMALIES)
        if recent_only
        else anomalies.where(F.col("anomaly_score") >= min_score)
    )
    realtime = top_anomaly_per_user(recent).select(
        "user", F.col("event_id").alias("realtime_event_id"), F.col("anomaly_score").alias("realtime_score")
    )
    batch = flagged.select(
        "user",
        F.col("anomaly_score_normalized").alias("batch_score"),
        "total_events",
        "avg_threat_score",
        "unique_ips",
        "failed_auth_rate",
    )
    if user is not None:
        realtime, batch = (t.where(F.col("user") == user) for t in (realtime, batch))
    return realtime.join(batch, "user", "full")


def format_context(events: DataFrame, view: DataFrame) -> DataFrame:
    """Per user the prompt's event listing (ten newest and how many more) and anomaly block.

    Only ten events per user leave a task, whatever a user's share.
    """
    newest = Window.partitionBy("user").orderBy(F.desc("ts_ms"), F.desc("event_id"))
    severity = F.lit(None).cast("string").alias("severity")
    line = F.struct("ts_ms", "event_id", "event_type", "user", "source_ip", severity, "threat_score")
    top = (
        events.select("user", "ts_ms", "event_id", "event_type", "source_ip", "threat_score")
        .withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= LISTED_EVENTS)
        .groupBy("user")
        .agg(F.reverse(F.array_sort(F.collect_list(line))).alias("top"))
    )
    sizes = events.groupBy("user").agg(F.count("*").alias("n"))
    batch = F.when(
        F.col("batch_score").isNotNull(),
        F.struct(
            F.col("batch_score").alias("anomaly_score_normalized"),
            "total_events",
            "avg_threat_score",
            "unique_ips",
            "failed_auth_rate",
        ),
    )
    return (
        sizes.join(top, "user")
        .join(view, "user", "left")
        .select(
            "user",
            format_events("top", "n").alias("events_text"),
            format_anomalies("realtime_score", batch).alias("anomalies_text"),
        )
    )


def answer_quality(context: DataFrame) -> DataFrame:
    """Confidence and sources of each answer from what was at hand."""
    return context.select(
        "*",
        answer_confidence("n_events", "avg_relevance", "has_realtime", "has_batch").alias("confidence"),
        sources_used("n_events", "n_intel", "has_batch").alias("sources"),
    )
