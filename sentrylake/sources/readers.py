"""Bounded and unbounded reads of the event topic, and reads of result tables."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.schema import ANOMALY_REPORT, BATCH_ANOMALY
from sentrylake.session import materialize, prepare
from sentrylake.sources.parse import project_events

RECORD_SCHEMA = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)


@dataclass(frozen=True)
class Topic:
    """Where the event topic lives: a Kafka topic, or files of topic records.

    ``format`` is any Spark source. For ``kafka``, ``options`` holds the connection; for file
    formats, ``path`` is the folder of records (key, value, topic, partition, offset, timestamp).
    """

    name: str = "security-events"
    format: str = "kafka"
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    @property
    def is_kafka(self) -> bool:
        return self.format == "kafka"


def watermarks(records: DataFrame) -> DataFrame:
    """First and next offset per partition of topic records."""
    return records.groupBy("partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")
    )


def kafka_watermarks(spark: SparkSession, topic: Topic) -> DataFrame:
    """First and next offset per partition, asked from the brokers by the client that Spark's own source uses."""
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.HashMap()
    for option, value in topic.options.items():
        if option.startswith("kafka."):
            settings.put(option.removeprefix("kafka."), value)
    for side in ("key", "value"):
        settings.put(f"{side}.deserializer", "org.apache.kafka.common.serialization.ByteArrayDeserializer")
    client = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(settings)
    try:
        parts = jvm.java.util.ArrayList()
        for info in client.partitionsFor(topic.name):
            parts.add(jvm.org.apache.kafka.common.TopicPartition(topic.name, info.partition()))
        first, following = client.beginningOffsets(parts), client.endOffsets(parts)
        rows = [(p.partition(), first.get(p), following.get(p)) for p in parts]
    finally:
        client.close()
    return spark.createDataFrame(rows, "partition int, low bigint, high bigint")


def bounded_read(
    marks: DataFrame, start_offset: str = "earliest", max_events: int = 1000, topic: str = "security-events"
) -> str | None:
    """End offsets (as the Kafka source's JSON) for about ``max_events`` records, None without partitions.

    Each partition gives the same number, at least one, counted from its first offset or, for
    ``latest``, from its end; an end never lies beyond the partition's end.
    """
    rows = marks.select("partition", "low", "high").collect()  # one row per topic partition
    if not rows:
        return None
    share = max(1, max_events // len(rows))
    ends = {}
    for row in sorted(rows):
        start = row.low if start_offset == "earliest" else row.high
        ends[str(row.partition)] = min(row.high, start + share)
    return json.dumps({topic: ends})


def _within(end_offsets: str, topic: str, column: str = "offset", below: bool = True) -> Column:
    """Records before (or from) the offsets of a Kafka-style offsets JSON; plain comparisons, which reach the scan.

    Partitions that are not named have no end, and no start.
    """
    ends = {int(part): at for part, at in json.loads(end_offsets)[topic].items()}
    inside = ~F.col("partition").isin(list(ends)) if ends else F.lit(True)
    for part, at in ends.items():
        inside = inside | ((F.col("partition") == part) & (F.col(column) < at if below else F.col(column) >= at))
    return inside


def read_records(
    spark: SparkSession,
    topic: Topic,
    start_offset: str = "earliest",
    end_offset: str | None = None,
    start_ms: int | None = None,
    end_ms: int | None = None,
) -> DataFrame:
    """Raw topic records between offsets, or between record times.

    ``latest`` starts at the end of the topic as it is now, so a batch that starts there has no rows.
    """
    prepare(spark)
    if start_offset == "latest":
        return read_records(spark, topic, "earliest", end_offset, start_ms, end_ms).limit(0)
    if topic.is_kafka:
        options = {"subscribe": topic.name, "startingOffsets": start_offset, **topic.options}
        if end_offset:
            options["endingOffsets"] = end_offset
        if start_ms is not None:
            options.pop("startingOffsets")
            options["startingTimestamp"] = str(start_ms)
        if end_ms is not None:
            # The source's end is exclusive, ours is not.
            options["endingTimestamp"] = str(end_ms + 1)
        return spark.read.format("kafka").options(**options).load()
    records = spark.read.format(topic.format).schema(RECORD_SCHEMA).options(**topic.options).load(topic.path)
    if start_offset != "earliest":
        records = records.where(_within(start_offset, topic.name, below=False))
    if end_offset:
        records = records.where(_within(end_offset, topic.name))
    if start_ms is not None:
        records = records.where(F.col("timestamp") >= F.timestamp_millis(F.lit(start_ms)))
    if end_ms is not None:
        records = records.where(F.col("timestamp") <= F.timestamp_millis(F.lit(end_ms)))
    return records


def read_events_batch(
    spark: SparkSession,
    topic: Topic,
    start_offset: str = "earliest",
    end_offset: str | None = None,
    max_events: int | None = None,
    marks: DataFrame | None = None,
) -> DataFrame:
    """Bounded read of events, with partition and offset.

    With ``max_events`` the read itself is cut short by end offsets (from ``marks``, the
    partitions' first and next offsets, looked up if not given) and then limited in
    (partition, offset) order.
    """
    if max_events and not end_offset:
        if marks is None:
            marks = kafka_watermarks(spark, topic) if topic.is_kafka else watermarks(read_records(spark, topic))
        end_offset = bounded_read(marks, start_offset, max_events, topic.name)
    events = project_events(read_records(spark, topic, start_offset, end_offset), "partition", "offset")
    if max_events:
        events = events.orderBy("partition", "offset").limit(max_events)
    return events


def read_events_stream(
    spark: SparkSession, topic: Topic, start_offset: str = "earliest", max_per_trigger: int | None = None
) -> DataFrame:
    """Unbounded read with the same parse. The checkpoint belongs to the writer of the query."""
    prepare(spark)
    reader = spark.readStream.format(topic.format).options(**topic.options)
    if topic.is_kafka:
        reader = reader.option("subscribe", topic.name).option("startingOffsets", start_offset)
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return project_events(reader.load())
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return project_events(reader.schema(RECORD_SCHEMA).load(topic.path))


# Offsets of a partition that share an entry of the time map.
ZONE_RECORDS = 10_000
_ZONE = "partition int, zone bigint, low bigint, high bigint, low_ms bigint, high_ms bigint, timeless bigint"


def map_times(spark: SparkSession, topic: Topic, path: str) -> DataFrame:
    """Bring the time map of a topic below ``path`` up to its end, and return it.

    For each stretch of offsets of a partition it has the lowest and highest event time. Only records beyond the ones
    mapped so far are read, and of their payloads only the time.
    """
    known = _load_or_empty(spark, "parquet", path, _ZONE)
    # One row per topic partition.
    ends = {str(r["partition"]): r["high"] for r in known.groupBy("partition").agg(F.max("high").alias("high")).collect()}
    start = json.dumps({topic.name: ends}) if ends else "earliest"
    if ends and topic.is_kafka:
        # The source wants every partition named; -2 is its first offset.
        marks = kafka_watermarks(spark, topic).select("partition").collect()
        start = json.dumps({topic.name: {str(r["partition"]): ends.get(str(r["partition"]), -2) for r in marks}})
    at = F.get_json_object(F.col("value").cast("string"), "$.timestamp").try_cast("double").try_cast("bigint")
    new = read_records(spark, topic, start).select("partition", "offset", at.alias("ms"))
    zones = new.groupBy("partition", F.floor(F.col("offset") / ZONE_RECORDS).alias("zone")).agg(
        F.min("offset").alias("low"),
        (F.max("offset") + 1).alias("high"),
        F.min("ms").alias("low_ms"),
        F.max("ms").alias("high_ms"),
        F.count_if(F.col("ms").isNull()).alias("timeless"),
    )
    zones.write.mode("append").parquet(path)
    return _load_or_empty(spark, "parquet", path, _ZONE)


def offsets_between(zones: DataFrame, topic: str, start_ms: int, end_ms: int | None) -> tuple[str, str] | None:
    """First and end offsets (as JSON) of the mapped stretches that hold some event time between two; None if none does."""
    inside = F.col("high_ms") >= start_ms
    if end_ms is not None:
        inside = inside & (F.col("low_ms") <= end_ms)
    spans = zones.groupBy("partition").agg(
        F.coalesce(F.min(F.when(inside, F.col("low"))), F.max("high")).alias("low"),
        F.coalesce(F.max(F.when(inside, F.col("high"))), F.max("high")).alias("high"),
    )
    rows = spans.collect()  # one row per topic partition
    if not rows:
        return None
    return tuple(json.dumps({topic: {str(r["partition"]): r[side] for r in rows}}) for side in ("low", "high"))


def read_time_range(
    spark: SparkSession, topic: Topic, start_time: str, end_time: str | None = None, time_map: str | None = None
) -> DataFrame:
    """Events from ``start_time`` to ``end_time``, both inclusive, by event time.

    With ``time_map``, a path where :func:`map_times` keeps the event times of the topic's offsets, the map is brought
    up to date and the read starts and ends at the offsets that can hold such events; those that came late are found
    as well. Without it the whole topic is read.
    """
    if time_map is None:
        return time_range(read_events_batch(spark, topic), start_time, end_time)
    prepare(spark)
    bounds = spark.range(1).select(F.unix_millis(F.lit(start_time).cast("timestamp")), F.unix_millis(F.lit(end_time).cast("timestamp"))).first()
    # A bound between two milliseconds takes the one before into the read; the events are compared exactly.
    spans = offsets_between(map_times(spark, topic, time_map), topic.name, *bounds)
    if spans is None:
        return time_range(read_events_batch(spark, topic), start_time, end_time).limit(0)
    return time_range(read_events_batch(spark, topic, *spans), start_time, end_time)


def time_range(events: DataFrame, start_time: str, end_time: str | None = None) -> DataFrame:
    """Events of any table between two times; on Parquet the bounds reach the scan."""
    found = events.where(F.col("ts") >= F.lit(start_time).cast("timestamp"))
    if end_time:
        found = found.where(F.col("ts") <= F.lit(end_time).cast("timestamp"))
    return found


def _load_or_empty(spark: SparkSession, fmt: str, path: str, schema: str, **options: str) -> DataFrame:
    try:
        return spark.read.format(fmt).schema(schema).options(**options).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_batch_anomalies(spark: SparkSession, path: str) -> DataFrame:
    """Flagged users of the labelled training data; empty where there is none yet.

    Only the ``is_anomaly=1`` folder is read, only six columns of it, and unreadable files are skipped.
    """
    return _load_or_empty(spark, "parquet", path, BATCH_ANOMALY, ignoreCorruptFiles="true").where(
        "is_anomaly = 1"
    )


def read_anomaly_report(spark: SparkSession, path: str) -> DataFrame:
    """The one-row anomaly report, or no row where there is none."""
    return _load_or_empty(spark, "json", path, ANOMALY_REPORT)


def read_embeddings(vectors: DataFrame, event_id: int | str, key: str = "event_id") -> DataFrame:
    """The vector of one event, no row if there is none."""
    return vectors.where(F.col(key) == event_id)


def load_threat_intel(entries: DataFrame) -> DataFrame:
    """Threat intelligence entries with defaults filled in, one row per id: of several the first by its content."""
    filled = entries.select(
        "id",
        "description",
        F.coalesce("category", F.lit("unknown")).alias("category"),
        F.coalesce("severity", F.lit("medium")).alias("severity"),
        F.coalesce("mitre_attack", F.lit("")).alias("mitre_attack"),
    )
    # Only entries whose id is repeated are brought together; all others stay where they are read.
    repeated = filled.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("_id"))
    repeated = materialize(repeated, "repeated")
    if repeated.isEmpty():
        return filled
    content = F.struct("description", "category", "severity", "mitre_attack")
    same = F.col("id").eqNullSafe(F.col("_id"))
    chosen = filled.join(repeated, same, "left_semi").groupBy("id").agg(F.min(content).alias("entry")).select("id", "entry.*")
    return filled.join(repeated, same, "left_anti").unionByName(chosen)
