"""From events to labelled training data and its report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sentrylake.operators.detectors import detect_anomalies
from sentrylake.operators.features import all_user_features, numeric_feature_columns
from sentrylake.operators.summary import anomaly_report, event_summary
from sentrylake.session import materialize
from sentrylake.sources.readers import Topic, read_events_batch
from sentrylake.sources.writers import write_anomaly_report, write_training_data


# What the features and the summary read of an event.
USED = ("user", "ts", "ts_ms", "event_type", "source_ip", "geo_location", "status", "threat_score")


@dataclass(frozen=True)
class TrainingRun:
    """What a run wrote, read back from where it was written."""

    summary: DataFrame
    labelled: DataFrame
    report: DataFrame


def build_training_data(
    events: DataFrame, path: str, algorithm: str = "isolation_forest", **options
) -> TrainingRun:
    """Features, labels and report of an event table, written below ``path``.

    The labelled rows go to ``path/data`` by label and the report to ``path/report``, so neither
    read has to step around the other. The report is computed from the written rows.
    """
    spark = events.sparkSession
    features = all_user_features(events)
    labelled = detect_anomalies(features, numeric_feature_columns(features), algorithm, **options)
    written = spark.read.parquet(write_training_data(labelled, f"{path}/data"))
    report_path = write_anomaly_report(anomaly_report(written), f"{path}/report")
    return TrainingRun(event_summary(events), written, spark.read.json(report_path))


def training_pipeline(
    spark: SparkSession,
    topic: Topic,
    path: str,
    start_offset: str = "earliest",
    max_events: int | None = None,
    algorithm: str = "isolation_forest",
    **options,
) -> TrainingRun:
    """The whole batch run: read a topic from an offset, up to about ``max_events``, and build training data below ``path``.

    The events' columns in ``USED`` are stored in the scratch folder once, so the topic is read and parsed once however many
    steps follow.
    Events without a user belong to no feature row.
    """
    events = read_events_batch(spark, topic, start_offset, max_events=max_events)
    events = materialize(events.where("user IS NOT NULL").select(*USED), "training-events")
    return build_training_data(events, path, algorithm, **options)
