"""Stored tables laid out for point lookups: a question by id or user opens one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.sources.writers import ANOMALY_KEY, EVENT_KEY, key_folder, latest_per_key, merge_by_key, read_note, read_stored


def _bloom(column: str) -> dict[str, str]:
    return {f"parquet.bloom.filter.enabled#{column}": "true"}


def _with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_date", F.to_date(F.timestamp_millis("ts_ms")))


def store_by_id(rows: DataFrame, path: str, *arrival, key: tuple[str, ...] = EVENT_KEY) -> str:
    """Merge events or anomalies into a table in folders by a hash of the event id, the latest copy of each key."""
    return merge_by_key(latest_per_key(rows, key, *arrival), path, key, by=("event_id",), **_bloom("event_id"))


def store_by_user(rows: DataFrame, path: str, *arrival, key: tuple[str, ...] = ANOMALY_KEY) -> str:
    """Merge events or anomalies into a table in folders by a hash of the user, then by day.

    A user with very many events has many days, and a batch rewrites those it brings only. Copies of a key under two users
    stay rows of both. Rows without a user, or without a time, have folders like others.
    """
    key = tuple(dict.fromkeys(("user", *key)))
    return merge_by_key(_with_day(latest_per_key(rows, key, *arrival)), path, key, by=("user",), then=("event_date",), **_bloom("user"))


def read_keyed(spark: SparkSession, path: str, **values) -> DataFrame:
    """Rows of a keyed table whose key columns have the given values; the other folders are not read.

    The columns must be those that the table is laid out by. A value of None finds the rows that have none.
    """
    stored = read_stored(spark, path, {"key_folder": "int", "event_date": "date"})
    if stored is None:
        raise FileNotFoundError(path)
    layout = read_note(spark, f"{path}.layout")
    by = layout.get("by") or list(values)
    if sorted(by) != sorted(values):
        raise ValueError(f"the table is laid out by {by}")
    given = {c: F.lit(values[c]).cast(stored.schema[c].dataType) for c in by}
    folder = spark.range(1).select(key_folder(list(given.values()), layout["folders"])).first()[0]
    rows = stored.where(F.col("key_folder") == folder)
    for column, value in given.items():
        rows = rows.where(F.col(column).isNull() if values[column] is None else F.col(column) == value)
    return rows.drop("key_folder")
