"""Whole-table summaries, reports and readiness rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.scalar import ratio
from sentrylake.operators.lookups import HIGH_THREAT
from sentrylake.operators.skew import exact_quantile
from sentrylake.session import materialize

TOP_ANOMALIES = 10

# Warnings of the status row.
WARNINGS = {
    "events": "No events found - the event stream may not be running",
    "aiAnalysis": "No analyses found - check that analyses are being stored",
    "anomalies": "No anomalies detected - may need more events or lower threshold",
}


def _count(table: DataFrame) -> Column:
    """Row count of another table as a scalar subquery; Parquet answers it from footers."""
    return table.agg(F.count("*")).scalar()


def event_summary(events: DataFrame) -> DataFrame:
    """One row of totals, distinct users and addresses, time range and mean score."""
    return events.agg(
        F.count("*").alias("total_events"),
        F.countDistinct("user").alias("unique_users"),
        F.countDistinct("source_ip").alias("unique_ips"),
        F.min("ts_ms").alias("min_ts_ms"),
        F.max("ts_ms").alias("max_ts_ms"),
        F.avg("threat_score").alias("avg_threat_score"),
    )


def event_type_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("events"))


def stats_summary(events: DataFrame, analyses: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Totals of all tables. A missing score counts as 0 in the mean; no events give a mean of 0."""
    return events.agg(
        F.count("*").alias("total_events"),
        F.count_if(F.col("threat_score") >= HIGH_THREAT).alias("high_threat_events"),
        ratio(F.sum(F.coalesce("threat_score", F.lit(0.0))), F.count("*"), 0.0).alias("average_threat_score"),
        _count(analyses).alias("total_analyses"),
        _count(anomalies).alias("total_anomalies"),
    )


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row count per named table."""
    counts = [t.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def anomaly_report(labelled: DataFrame) -> DataFrame:
    """One row: users, flagged users, their rate and the ten highest-scored flagged users."""
    top = (
        labelled.where("is_anomaly = 1")
        .orderBy(F.desc("anomaly_score_normalized"), F.asc("user"))
        .limit(TOP_ANOMALIES)
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        (-F.col("anomaly_score_normalized")).alias("descending"),
                        "user",
                        "anomaly_score_normalized",
                        "total_events",
                        F.coalesce("avg_threat_score", F.lit(0.0)).alias("avg_threat_score"),
                    )
                )
            ).alias("ten")
        )
        .select(F.transform("ten", lambda r: r.dropFields("descending")).alias("ten"))
    )
    flagged = F.count_if(F.col("is_anomaly") == 1)
    return labelled.agg(
        F.count("*").alias("total_users"),
        flagged.alias("anomalous_users"),
        ratio(flagged, F.count("*"), 0.0).alias("anomaly_rate"),
    ).withColumn("top_anomalies", top.scalar())


def training_stats(report: DataFrame) -> DataFrame:
    """The report's totals, the number of its top anomalies, and a line of text."""
    return report.select(
        "total_users",
        "anomalous_users",
        "anomaly_rate",
        F.size("top_anomalies").alias("top_anomalies_count"),
        F.lit(True).alias("available"),
        F.format_string(
            "Training data: %d users analyzed, %d anomalies (%.1f%% rate)",
            F.col("total_users"),
            F.col("anomalous_users"),
            F.col("anomaly_rate") * 100,
        ).alias("stats"),
    )


def training_availability(report: DataFrame) -> DataFrame:
    """One row that says whether there is a report; unlike ``training_stats`` never empty."""
    found = report.agg(F.count("*").alias("n"))
    return found.select(
        (F.col("n") > 0).alias("available"),
        F.when(F.col("n") > 0, training_stats(report).select("stats").limit(1).scalar())
        .otherwise("No training data available")
        .alias("stats"),
        F.when(F.col("n") > 0, "healthy").otherwise("unavailable").alias("status"),
    )


def normal_users(report: DataFrame) -> DataFrame:
    return report.select((F.col("total_users") - F.col("anomalous_users")).alias("normal_users"))


def population_baseline(features: DataFrame, percentile: float = 0.95) -> DataFrame:
    """What is usual in the population, as one configuration row for detectors.

    The features are written out first, as the exact percentile takes passes of its own.
    """
    used = features.select("events_per_day", "unique_ips", "unusual_hour_rate")
    features = materialize(used, "population")
    return features.agg(
        F.avg("events_per_day").alias("avg_events_per_day"),
        F.stddev_samp("events_per_day").alias("stddev_events_per_day"),
        F.avg("unique_ips").alias("avg_unique_ips"),
        F.stddev_samp("unique_ips").alias("stddev_unique_ips"),
        F.avg("unusual_hour_rate").alias("avg_unusual_hour_rate"),
    ).withColumn("unusual_hour_threshold", F.lit(exact_quantile(features, "unusual_hour_rate", percentile)))


def detector_comparison(scored: DataFrame) -> DataFrame:
    """Precision, recall and F1 per detector from rows of (detector, predicted, actual) booleans."""
    tp = F.count_if(F.col("predicted") & F.col("actual"))
    fp = F.count_if(F.col("predicted") & ~F.col("actual"))
    fn = F.count_if(~F.col("predicted") & F.col("actual"))
    return scored.groupBy("detector").agg(
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        fn.alias("false_negatives"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def data_readiness(events: DataFrame, anomalies: DataFrame, analyses: DataFrame) -> DataFrame:
    """Counts, availability flags, warnings and whether queries can be served."""
    counted = events.agg(
        F.count("*").alias("event_count"),
        _count(anomalies).alias("anomaly_count"),
        _count(analyses).alias("analysis_count"),
    )
    empty = {"events": "event_count", "aiAnalysis": "analysis_count", "anomalies": "anomaly_count"}
    pairs = [F.lit(part) for item in WARNINGS.items() for part in item]
    missing = F.array_compact(F.array(*[F.when(F.col(c) == 0, name) for name, c in empty.items()]))
    return counted.select(
        "*",
        (F.col("event_count") > 0).alias("events_available"),
        (F.col("anomaly_count") >= 0).alias("anomaly_detection_available"),
        (F.col("analysis_count") >= 0).alias("ai_analysis_available"),
        F.map_filter(F.create_map(*pairs), lambda k, _: F.array_contains(missing, k)).alias("warnings"),
        (F.col("event_count") > 0).alias("ready"),
        F.when(F.col("event_count") > 0, "System is ready and has data")
        .otherwise("System is not ready - no events in database")
        .alias("message"),
    )


def layer_metrics(events: DataFrame, anomalies: DataFrame, analyses: DataFrame, report: DataFrame) -> DataFrame:
    """Totals of the speed and batch layers as (metric, value) rows.

    The batch totals appear only where there is a report; ``training_data_available`` always does.
    """
    one = events.agg(
        F.count("*").alias("events"),
        _count(anomalies).alias("anomalies"),
        _count(analyses).alias("analyses"),
        _count(report).alias("reports"),
    )
    row = lambda name, value: F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))
    speed = one.select(
        F.inline(
            F.array(
                row("events_total", F.col("events")),
                row("anomalies_total", F.col("anomalies")),
                row("ai_analyses_total", F.col("analyses")),
                row("training_data_available", F.least(F.col("reports"), F.lit(1))),
            )
        )
    )
    batch = report.select(
        F.inline(
            F.array(
                row("training_data_users_total", F.coalesce("total_users", F.lit(0))),
                row("training_data_anomalies_total", F.coalesce("anomalous_users", F.lit(0))),
                row("training_data_anomaly_rate", F.coalesce("anomaly_rate", F.lit(0.0))),
            )
        )
    )
    return speed.unionByName(batch)
