"""Result tables: upserts by key, partitioned layouts, and the topic sink.

A change to a stored table is written beside it first, then named in a marker (``<table>.pending``), then carried out;
the marker goes last. A change that was broken off is carried out again by the next one, or by ``read_stored``.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sentrylake.session import materialize, scratch_path
from sentrylake.sources.parse import serialize_event_json

# Keys under which a later row replaces an earlier one.
EVENT_KEY = ("event_type", "ts_ms", "event_id")
ANOMALY_KEY = ("ts_ms", "event_id")
ANALYSIS_KEY = ("event_id",)


def latest_per_key(rows: DataFrame, key: tuple[str, ...], *arrival: Column | str) -> DataFrame:
    """The last row of each key by ``arrival``.

    The rank limit is applied in every task before the shuffle, so however many copies a key has,
    each task sends at most one of them. Without ``arrival`` the copy with the greatest JSON text stays.
    """
    arrival = arrival or (F.to_json(F.struct(*(F.col(f"`{c}`") for c in rows.columns))),)
    order = [F.desc(a) if isinstance(a, str) else a.desc() for a in arrival]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def _event_date() -> Column:
    return F.to_date(F.timestamp_millis("ts_ms")).alias("event_date")


def _write(rows: DataFrame, path: str, *partitions: str, mode: str = "overwrite", **options: str) -> str:
    """Write by partition value. Rows are spread over tasks by AQE's rebalance, which also splits
    a partition value that holds most of the rows instead of giving it to one task."""
    if partitions:
        rows = rows.hint("rebalance", *partitions)
    writer = rows.write.mode(mode).options(**options)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return path


# Point lookups by id read the row groups whose bloom filter lets the id through.
_ID_BLOOM = {"parquet.bloom.filter.enabled#event_id": "true"}


# A table without a day is spread by its key over a power of two of folders, of up to this many rows each.
FOLDER_ROWS = 250_000
FEWEST_FOLDERS = 16


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    files, at = _files(spark, path)
    out = files.create(at, True)
    out.write(bytearray(json.dumps(note).encode()))
    out.close()


def read_note(spark: SparkSession, path: str) -> dict | None:
    files, at = _files(spark, path)
    if not files.exists(at):
        return None
    text = spark.read.text(path, wholetext=True).first()
    return json.loads(text[0]) if text and text[0] else None


def remove_path(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def finish(spark: SparkSession, path: str) -> None:
    """Carry out the change that the table's marker names, if there is one; doing so twice changes nothing."""
    note = read_note(spark, f"{path}.pending")
    if note is None:
        return
    staged = spark.read.schema(StructType.fromJson(note["schema"])).parquet(note["staged"])
    how = {} if note["whole"] else {"partitionOverwriteMode": "dynamic"}
    _write(staged, path, *note["partitions"], **how, **note["options"])
    for folder in note["drop"]:
        remove_path(spark, f"{path}/{folder}")
    if note["folders"]:
        write_note(spark, f"{path}.layout", {"folders": note["folders"], "by": note.get("by")})
    remove_path(spark, f"{path}.pending")


def _change(rows: DataFrame, path: str, partitions: tuple[str, ...], options: dict, whole=False, drop=(), folders=None, by=None) -> str:
    """Replace the folders of ``rows`` (or the whole table) and drop others, so that it can be taken up again."""
    spark = rows.sparkSession
    staged = scratch_path(spark, "staged")
    rows.write.parquet(staged)
    note = {"staged": staged, "schema": json.loads(rows.schema.json()), "partitions": partitions, "options": options}
    write_note(spark, f"{path}.pending", note | {"whole": whole, "drop": list(drop), "folders": folders, "by": by})
    finish(spark, path)
    return path


def read_stored(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame | None:
    """A stored table with the columns of all its files, None if there is none; ``types`` gives those of folder columns."""
    finish(spark, path)
    try:
        schema = spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return None
    fields = ", ".join(f"`{f.name}` {(types or {}).get(f.name, f.dataType.simpleString())}" for f in schema.fields)
    return spark.read.schema(fields).parquet(path)


def _matched(left: DataFrame, right: DataFrame, columns: tuple[str, ...], how: str) -> DataFrame:
    """A semi or anti join where null equals null."""
    right = right.select(*(F.col(c).alias(f"_{c}") for c in columns))
    return left.join(right, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns], how)


def merge(rows: DataFrame, path: str, key: tuple[str, ...], partitions: tuple[str, ...], **options: str) -> str:
    """Put rows into a stored table: rows of a known key replace the stored ones, all others stay.

    ``rows`` has each key once. Nulls in a key or partition column are equal to each other. The table has the columns
    of both, null where a row has none; a column whose type changes is refused. Only the partition folders that the
    rows fall into are read and replaced.
    """
    spark = rows.sparkSession
    stored = read_stored(spark, path, {c: rows.schema[c].dataType.simpleString() for c in partitions})
    if stored is None:
        return _write(rows, path, *partitions, **options)
    _same_types(stored, rows)
    return _merge_arrived(materialize(rows, "arrived"), stored, path, key, partitions, options)


def _merge_arrived(rows: DataFrame, stored: DataFrame, path: str, key: tuple[str, ...], partitions: tuple[str, ...], options: dict) -> str:
    touched = rows.select(*partitions).distinct()
    kept = _matched(_matched(stored, touched, partitions, "left_semi"), rows.select(*key), key, "left_anti")
    return _change(kept.unionByName(rows, allowMissingColumns=True), path, partitions, options)


def _same_types(stored: DataFrame, rows: DataFrame) -> None:
    known = {f.name: f.dataType.simpleString() for f in stored.schema.fields}
    changed = [f"{f.name}: {known[f.name]} to {f.dataType.simpleString()}" for f in rows.schema.fields if known.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()]
    if changed:
        raise ValueError(f"stored columns would change their type: {', '.join(changed)}")


def key_folder(by: tuple[str, ...] | list[Column], folders: int) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(folders)).cast("int")


def merge_by_key(
    rows: DataFrame, path: str, key: tuple[str, ...], by: tuple[str, ...] = (), then: tuple[str, ...] = (), **options: str
) -> str:
    """``merge`` for a table in folders by a hash of its key, or of the columns ``by`` of its key; folders may be divided
    further by the values of ``then``, so that a batch touches only a part of a frequent value's rows.

    Their number follows the table: once they would hold more than ``FOLDER_ROWS`` rows each, all rows are dealt anew
    over twice as many or more, so a small batch touches a small part of a large table.
    """
    spark = rows.sparkSession
    partitions = ("key_folder", *then)
    stored = read_stored(spark, path, {"key_folder": "int"} | {c: rows.schema[c].dataType.simpleString() for c in then})
    # A new table is written from the rows as they come; others are read several times for a change.
    rows = rows if stored is None else materialize(rows, "arrived")
    now = (read_note(spark, f"{path}.layout") or {"folders": FEWEST_FOLDERS})["folders"] if stored is not None else 0
    total = rows.count() + (stored.count() if stored is not None else 0)
    wanted = max(FEWEST_FOLDERS, 1 << max(0, -(-total // FOLDER_ROWS) - 1).bit_length())
    folders = max(now, wanted)
    folder = key_folder(by or key, folders)
    rows = rows.withColumn("key_folder", folder)
    if stored is None:
        # There is nothing to lose; the layout without a table says nothing.
        write_note(spark, f"{path}.layout", {"folders": folders, "by": list(by or key)})
        return _write(rows, path, *partitions, **options)
    _same_types(stored, rows)
    if folders == now:
        return _merge_arrived(rows, stored, path, key, partitions, options)
    kept = _matched(stored.withColumn("key_folder", folder), rows.select(*key), key, "left_anti")
    rows = kept.unionByName(rows, allowMissingColumns=True)
    return _change(rows, path, partitions, options, whole=True, folders=folders, by=list(by or key))


def upsert_events(rows: DataFrame, path: str, *arrival: Column | str) -> str:
    """Store events by type and day; a later copy of a key replaces an earlier one, in these rows or stored."""
    # An empty type has the folder of null, and is read back as null.
    rows = rows.withColumn("event_type", F.nullif("event_type", F.lit("")))
    kept = latest_per_key(rows, EVENT_KEY, *arrival).withColumn("event_date", _event_date())
    return merge(kept, path, EVENT_KEY, ("event_type", "event_date"), **_ID_BLOOM)


def write_anomalies(rows: DataFrame, path: str, *arrival: Column | str) -> str:
    kept = latest_per_key(rows, ANOMALY_KEY, *arrival).withColumn("event_date", _event_date())
    return merge(kept, path, ANOMALY_KEY, ("event_date",), **_ID_BLOOM)


def write_analyses(rows: DataFrame, path: str, *arrival: Column | str) -> str:
    return merge_by_key(latest_per_key(rows, ANALYSIS_KEY, *arrival), path, ANALYSIS_KEY, **_ID_BLOOM)


def write_embeddings(rows: DataFrame, path: str, key: str, *arrival: Column | str) -> str:
    """Store vectors as arrays of float, the latest per key."""
    kept = latest_per_key(rows, (key,), *arrival)
    return merge_by_key(kept.withColumn("embedding", F.col("embedding").cast("array<float>")), path, (key,))


def delete_expired(spark: SparkSession, path: str, cutoff_ms: int) -> int:
    """Delete the stored events before the cutoff and return their number.

    Folders of whole days go as they are; only the day of the cutoff is rewritten. The list of folders has one
    entry per type and day.
    """
    events = read_stored(spark, path, {"event_type": "string", "event_date": "date"})
    last = dt.datetime.fromtimestamp(cutoff_ms / 1000, dt.timezone.utc).date()
    old = events.where(F.col("event_date") <= F.lit(last)).where(F.col("ts_ms") < cutoff_ms)
    counts = {(r["event_type"], r["event_date"]): r["n"] for r in old.groupBy("event_type", "event_date").agg(F.count("*").alias("n")).collect()}
    day = events.where(F.col("event_date") == F.lit(last)).where(F.col("ts_ms") >= cutoff_ms)
    staying = {r["event_type"] for r in day.select("event_type").distinct().collect()}
    name = lambda kind: "__HIVE_DEFAULT_PARTITION__" if kind is None else kind
    drop = [f"event_type={name(kind)}/event_date={date}" for kind, date in counts if date < last or kind not in staying]
    if counts:
        _change(day, path, ("event_type", "event_date"), _ID_BLOOM, drop=drop)
    return sum(counts.values())


def write_training_data(labelled: DataFrame, path: str) -> str:
    """Labelled feature rows, one folder per label."""
    return _write(labelled, path, "is_anomaly")


def write_anomaly_report(report: DataFrame, path: str) -> str:
    """The one-row report as JSON beside the data."""
    report.write.mode("overwrite").json(path)
    return path


def write_threat_intel(entries: DataFrame, path: str) -> str:
    """Store threat intelligence entries; a known id's entry is replaced."""
    return merge_by_key(entries, path, ("id",))


def to_records(events: DataFrame) -> DataFrame:
    """Events as topic records: the id is the key, the JSON payload the value."""
    return events.select(F.col("event_id").alias("key"), serialize_event_json(events.columns).alias("value"))


def publish_events(events: DataFrame, topic: str, fmt: str = "kafka", path: str | None = None, **options: str):
    """Send events to the topic: a batch is written at once, a stream's writer is returned to start."""
    records = to_records(events)
    writer = records.writeStream if events.isStreaming else records.write
    writer = writer.format(fmt).options(**options)
    if fmt == "kafka":
        writer = writer.option("topic", topic)
    elif path:
        writer = writer.option("path", path)
    if events.isStreaming:
        return writer
    return writer.mode("append").save()
