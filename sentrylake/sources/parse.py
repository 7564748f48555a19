"""Event payloads to rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.scalar import epoch_ms_to_ts, is_event_type, is_status
from sentrylake.schema import BATCH_PAYLOAD, CORRUPT, DETAIL_FIELDS, EVENT_ID_PATTERN, EVENT_PAYLOAD
from sentrylake.schema import IP_PATTERN, MAX_TS_MS, MIN_TS_MS

REQUIRED = ("event_id", "timestamp", "event_type", "source_ip", "user", "threat_score")


def project_events(records: DataFrame, *keep: str) -> DataFrame:
    """The lenient projection of the batch and stream readers.

    One JSON parse per record, casts that give null instead of failing, and only records with an
    event id. The location may sit at the top or inside the metadata. ``keep`` names record
    columns to pass on, such as partition and offset.
    """
    parsed = records.select(*keep, F.from_json(F.col("value").cast("string"), BATCH_PAYLOAD).alias("e"))
    ts_ms = F.col("e.timestamp").try_cast("bigint")
    return parsed.where("e.event_id is not null").select(
        "e.event_id",
        epoch_ms_to_ts(ts_ms).alias("ts"),
        ts_ms.alias("ts_ms"),
        "e.event_type",
        "e.user",
        "e.source_ip",
        "e.destination_ip",
        F.coalesce("e.location", "e.metadata.geo_location").alias("geo_location"),
        "e.status",
        F.col("e.threat_score").try_cast("double").alias("threat_score"),
        "e.details",
        *keep,
    )


def _first_problem() -> Column:
    """Why a payload cannot be taken, null if it can."""
    e = F.col("e")
    problem = F.when(e[CORRUPT].isNotNull() | e.isNull(), "malformed")
    for name in REQUIRED:
        problem = problem.when(e[name].isNull(), f"missing {name}")
    return problem.when(~is_event_type(e["event_type"]), "unknown event_type").when(
        e["status"].isNotNull() & ~is_status(e["status"]), "unknown status"
    )


def parse_event_json(records: DataFrame, *keep: str) -> DataFrame:
    """Strict parse: every record comes back, with ``error`` set for the ones to put aside.

    Good rows carry the typed event; a missing status means success.
    """
    value = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = records.select(*keep, value.alias("value"), F.from_json(value, EVENT_PAYLOAD, options).alias("e"))
    checked = parsed.withColumn("error", _first_problem())
    good = lambda name: F.when(F.col("error").isNull(), F.col(f"e.{name}"))
    plain = ["event_id", "event_type", "source_ip", "destination_ip", "user", "threat_score", "metadata"]
    return checked.select(
        *keep,
        *[good(name).alias(name) for name in plain],
        good("timestamp").alias("ts_ms"),
        epoch_ms_to_ts(good("timestamp")).alias("ts"),
        F.when(F.col("error").isNull(), F.coalesce("e.status", F.lit("success"))).alias("status"),
        *[
            F.when(F.col("error").isNull() & (F.col("e.event_type") == kind), F.col(f"e.{field}")).alias(field)
            for kind, field in DETAIL_FIELDS.items()
        ],
        "error",
        F.when(F.col("error").isNotNull(), F.col("value")).alias("rejected_value"),
    )


def split_rejected(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed records as (good events, dead letters with their reason)."""
    good = parsed.where("error is null").drop("error", "rejected_value")
    rejected = parsed.where("error is not null").select("error", F.col("rejected_value").alias("value"))
    return good, rejected


def parse_typed_details(records: DataFrame) -> DataFrame:
    """Event id and type with the one detail struct that belongs to the type; the others are null."""
    good, _ = split_rejected(parse_event_json(records))
    return good.select("event_id", "event_type", *DETAIL_FIELDS.values())


# Metadata fields of the payload, as text and as positive numbers.
METADATA_TEXTS = ("user_agent", "geo_location", "protocol", "file_path", "process_name", "domain")
METADATA_NUMBERS = ("port", "bytes_transferred")


def serialize_event_json(columns: list[str], custom: str | None = None) -> Column:
    """A flat event with these columns as its JSON payload; null, empty and zero fields are left out.

    ``custom`` names a map column whose entries join the metadata fields; its keys need no schema.
    """
    text = lambda name: F.nullif(F.col(name), F.lit("")).alias(name)
    details = [text(name) for name in METADATA_TEXTS if name in columns]
    details += [F.when(F.col(name) > 0, F.col(name)).alias(name) for name in METADATA_NUMBERS if name in columns]
    event = F.to_json(
        F.struct(
            "event_id",
            F.col("ts_ms").alias("timestamp"),
            "event_type",
            "source_ip",
            "user",
            "status",
            "threat_score",
            *[text(name) for name in ("destination_ip",) if name in columns],
        )
    )
    fields = [F.to_json(F.struct(*details))] if details else []
    if custom:
        fields.append(F.to_json(F.col(custom)))
    inside = lambda j: F.nullif(F.substr(j, F.lit(2), F.length(j) - 2), F.lit(""))
    metadata = F.concat_ws(",", *[inside(j) for j in fields])
    return F.when(metadata == "", event).otherwise(
        F.concat(F.lit("{"), inside(event), F.lit(',"metadata":{'), metadata, F.lit("}}"))
    )


def validate_events(events: DataFrame) -> DataFrame:
    """Events with ``is_valid`` and the list of rules they break."""
    blank = lambda name: F.coalesce(F.col(name), F.lit("")) == ""
    broken = {
        "event_id missing": blank("event_id"),
        "user missing": blank("user"),
        "event_id format": ~blank("event_id") & ~F.col("event_id").rlike(EVENT_ID_PATTERN),
        "timestamp range": ~F.coalesce(F.col("ts_ms").between(MIN_TS_MS, MAX_TS_MS), F.lit(False)),
        "threat_score range": ~F.coalesce(F.col("threat_score").between(0.0, 1.0), F.lit(False)),
        "source_ip format": ~blank("source_ip") & ~F.col("source_ip").rlike(IP_PATTERN),
    }
    problems = F.array_compact(F.array(*[F.when(rule, name) for name, rule in broken.items()]))
    return events.withColumn("problems", problems).withColumn("is_valid", F.size("problems") == 0)
