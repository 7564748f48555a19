"""Counters, histograms, rates and costs over logs, as the dashboards read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.scalar import anomaly_severity, base_model_name, ratio

# Upper bounds of the histograms' buckets.
SCORE_BOUNDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
LATENCY_BOUNDS = (0.001, 0.0025, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
QUERY_SECONDS_BOUNDS = (0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0)
MODEL_SECONDS_BOUNDS = (0.5, 1.0, 2.0, 5.0, 10.0, 30.0)
SOURCE_SECONDS_BOUNDS = (0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0)
CONFIDENCE_BOUNDS = (0.0, 0.2, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
EVENT_COUNT_BOUNDS = (0, 1, 2, 5, 10, 20, 50, 100)
INTEL_COUNT_BOUNDS = (0, 1, 2, 3, 5, 10)

# Dollars per million prompt and completion tokens, in matching order.
PRICES = {
    "gpt-4o-mini": (0.15, 0.60),
    "gpt-4o": (2.50, 10.00),
    "gpt-4-turbo": (10.00, 30.00),
}


def window_start_ms(size: str, ts: str = "ts") -> Column:
    """Start of the tumbling window an event falls in, in milliseconds."""
    return F.unix_millis(F.window(ts, size)["start"])


# --- counters --------------------------------------------------------------------------------


def counter_total(log: DataFrame, *labels: str) -> DataFrame:
    return log.groupBy(*labels).agg(F.count("*").alias("total"))


def event_counters(events: DataFrame, anomalies: DataFrame, analyses: DataFrame) -> DataFrame:
    """Processed events by type; threats by severity (of anomalies and of analyses); anomalies by
    user and score range: one (counter, label, user, total) table."""
    graded = anomalies.select("user", anomaly_severity("anomaly_score").alias("label"))
    none = F.lit(None).cast("string").alias("user")
    processed = events.select(F.lit("events_processed").alias("counter"), F.col("event_type").alias("label"), none)
    threats = graded.select("label").unionByName(analyses.select(F.col("severity").alias("label")))
    detected = threats.select(F.lit("threats_detected").alias("counter"), "label", none)
    per_user = graded.select(F.lit("anomalies_detected").alias("counter"), "label", "user")
    return counter_total(processed.unionByName(detected).unionByName(per_user), "counter", "label", "user")


def storage_errors(log: DataFrame, failed: Column) -> DataFrame:
    return log.agg(F.count_if(failed).alias("storage_errors"))


# --- histograms ------------------------------------------------------------------------------


def _bucket_counts(x: Column, bounds: tuple) -> Column:
    """Cumulative counts per bound and the total, as one array; a single aggregation pass."""
    return F.array(*[F.count_if(x <= F.lit(float(b))) for b in bounds], F.count(x))


def histogram(log: DataFrame, value: str, bounds: tuple, *labels: str) -> DataFrame:
    """Cumulative bucket rows (``le``, ``cumulative``) with the sum and count of the observations."""
    x = F.col(value).cast("double")
    counted = log.groupBy(*labels).agg(
        _bucket_counts(x, bounds).alias("buckets"),
        F.coalesce(F.sum(x), F.lit(0.0)).alias("observed_sum"),
        F.count(x).alias("observed_count"),
    )
    limits = F.array(*[F.lit(f"{float(b):g}") for b in bounds], F.lit("+Inf"))
    return counted.select(
        *labels, F.inline(F.arrays_zip(limits.alias("le"), F.col("buckets").alias("cumulative"))),
        "observed_sum", "observed_count",
    )


def score_histogram(anomalies: DataFrame, *labels: str) -> DataFrame:
    return histogram(anomalies, "anomaly_score", SCORE_BOUNDS, *labels)


def latency_histogram(log: DataFrame, value: str = "seconds", bounds: tuple = LATENCY_BOUNDS, *labels: str) -> DataFrame:
    return histogram(log, value, bounds, *labels)


def _interpolated(q: float, buckets: Column, bounds: tuple) -> Column:
    """Quantile inside the first bucket that reaches rank ``q * n``; the last bound beyond it."""
    upper = F.array(*[F.lit(float(b)) for b in bounds])
    rank = F.element_at(buckets, -1) * F.lit(q)
    at = F.array_position(F.transform(buckets, lambda c: c >= rank), True).cast("int")
    previous = F.when(at > 1, F.get(buckets, at - 2)).otherwise(0)
    lower = F.when(at > 1, F.get(upper, at - 2)).otherwise(F.least(F.lit(0.0), upper[0]))
    inside = lower + (F.get(upper, at - 1) - lower) * ratio(rank - previous, F.get(buckets, at - 1) - previous)
    value = F.when(at > len(bounds), F.lit(float(bounds[-1]))).otherwise(inside)
    return F.when(F.element_at(buckets, -1) > 0, value)


def histogram_quantile(
    log: DataFrame, value: str, bounds: tuple = LATENCY_BOUNDS, quantiles: tuple = (0.5, 0.95, 0.99), *labels: str
) -> DataFrame:
    """Quantiles as a dashboard estimates them from buckets, one column per quantile (``p50`` ...)."""
    counted = log.groupBy(*labels).agg(_bucket_counts(F.col(value).cast("double"), bounds).alias("buckets"))
    return counted.select(
        *labels, *[_interpolated(q, F.col("buckets"), bounds).alias(f"p{q * 100:g}") for q in quantiles]
    )


# --- rates -----------------------------------------------------------------------------------


def rate(log: DataFrame, size: str, seconds: int, *labels: str) -> DataFrame:
    """Rows per window: their number (increase), per second and per minute."""
    counted = log.groupBy(window_start_ms(size).alias("window_start_ms"), *labels).agg(F.count("*").alias("increase"))
    per_second = F.col("increase") / seconds
    return counted.select(
        "*", per_second.alias("per_second"), (per_second * 60).alias("per_minute")
    )


def mean_latency(log: DataFrame, value: str, size: str, *labels: str) -> DataFrame:
    return log.groupBy(window_start_ms(size).alias("window_start_ms"), *labels).agg(
        ratio(F.sum(value), F.count(value)).alias("mean_latency")
    )


def consumer_rate(messages: DataFrame, ok: Column, size: str = "10 seconds", seconds: int = 10) -> DataFrame:
    """Messages, rate and errors per window; the success share is that of the whole log."""
    windows = messages.groupBy(window_start_ms(size).alias("window_start_ms")).agg(
        F.count("*").alias("messages"), (F.count("*") / seconds).alias("per_second"), F.count_if(~ok).alias("errors")
    )
    overall = messages.agg(ratio(F.count_if(ok) * 100, F.count("*"))).scalar()
    return windows.withColumn("success_percent", overall)


def threat_ratio(events: DataFrame, threats: DataFrame) -> DataFrame:
    n = events.agg(F.count("*").alias("events"), threats.agg(F.count("*")).scalar().alias("threats"))
    return n.select("threats", "events", ratio("threats", "events").alias("threat_ratio"))


def error_rate(log: DataFrame, failed: Column, size: str, seconds: int) -> DataFrame:
    """Errors per second and availability (1 - errors / processed) per window."""
    errors = F.count_if(failed)
    return log.groupBy(window_start_ms(size).alias("window_start_ms")).agg(
        (errors / seconds).alias("error_rate"), (1 - ratio(errors, F.count("*"))).alias("availability")
    )


def service_health(status_log: DataFrame, *keys: str) -> DataFrame:
    """The latest value (1 up, 0 down) per service."""
    return status_log.groupBy(*keys).agg(
        F.max_by(F.col("up").cast("int"), F.struct("ts_ms", "event_id")).alias("up"),
        F.max("ts_ms").alias("as_of_ms"),
    )


# --- assistant -------------------------------------------------------------------------------


def _price(model: Column, place: int) -> Column:
    """Dollars per token: an exact name wins, else the first name the model starts with."""
    names = list(PRICES)
    (first, *rest) = [(model == n, n) for n in names] + [(model.startswith(n), n) for n in names]
    price = F.when(first[0], PRICES[first[1]][place])
    for rule, name in rest:
        price = price.when(rule, PRICES[name][place])
    return price / 1_000_000


def with_cost(usage: DataFrame) -> DataFrame:
    """Usage rows with their cost in dollars, null for a model without a price."""
    model = F.col("model")
    cost = F.col("prompt_tokens") * _price(model, 0) + F.col("completion_tokens") * _price(model, 1)
    return usage.withColumn("cost", cost)


def llm_usage_cost(usage: DataFrame) -> DataFrame:
    """Tokens per model and the cost under its base name; no cost for a model without a price."""
    return (
        with_cost(usage)
        .groupBy("model")
        .agg(
            F.sum("prompt_tokens").alias("prompt_tokens"),
            F.sum("completion_tokens").alias("completion_tokens"),
            F.sum("cost").alias("cost"),
        )
        .withColumn("base_model", base_model_name("model"))
    )


def cost_per_hour(usage: DataFrame) -> DataFrame:
    return (
        with_cost(usage)
        .where("cost is not null")
        .groupBy(window_start_ms("1 hour").alias("window_start_ms"), base_model_name("model").alias("base_model"))
        .agg(F.sum("cost").alias("cost_per_hour"))
    )


def assistant_query_metrics(queries: DataFrame) -> DataFrame:
    """Queries by whether intelligence was asked for, and the histograms of what they had at hand."""
    flag = F.when(F.col("include_threat_intel"), "true").otherwise("false")
    counted = queries.groupBy(flag.alias("le")).agg(F.count("*").alias("cumulative"))
    parts = [counted.select(F.lit("queries_total").alias("metric"), "le", "cumulative")]
    for metric, column, bounds in [
        ("confidence_score", "confidence", CONFIDENCE_BOUNDS),
        ("supporting_events_count", "n_events", EVENT_COUNT_BOUNDS),
        ("threat_intel_count", "n_intel", INTEL_COUNT_BOUNDS),
    ]:
        parts.append(histogram(queries, column, bounds).select(F.lit(metric).alias("metric"), "le", "cumulative"))
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
