"""The speed layer as Structured Streaming queries.

Input streams are flat events with an event time ``ts``. State is keyed by user or event id and
lives in the RocksDB state store under the query's checkpoint; sinks write one folder per
micro-batch, so a batch that is run again replaces its own output.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sentrylake.functions.scalar import hour_of_day, ratio
from sentrylake.functions.text import anomaly_reasons
from sentrylake.operators.baseline import DIMENSIONS, MIN_EVENTS, SCORES, THRESHOLD, TRAITS, Baseline
from sentrylake.operators.features import UNUSUAL_HOURS
from sentrylake.operators.lookups import HIGH_THREAT
from sentrylake.session import ROCKSDB_PROVIDER, shuffle_parts
from sentrylake.sources.writers import ANOMALY_KEY, EVENT_KEY, latest_per_key, read_note, write_note

DEFAULT_DELAY = "10 minutes"
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
# Bytes of stored events, about 60,000 of them, whose points one task of the sliding features holds.
SLIDING_BYTES = 1 << 20

# What a scored event carries: enough to store the event, its anomaly and the analysis gate.
EVENT_COLUMNS = [
    "event_id", "user", "ts_ms", "event_type", "source_ip", "destination_ip", "status", "threat_score",
    "geo_location",
]
_CARRIED = (
    "event_id string, user string, ts_ms bigint, event_type string, source_ip string, "
    "destination_ip string, status string, threat_score double, geo_location string, arrival bigint, hour int"
)
_SCORES = ", ".join(f"{name} double" for name in SCORES)

# The counts of up to this many values lie in a user's one row of state; those of a user with more have entries of their own.
FEW_VALUES = 256
# Counts that a user starts with come in rows of up to this many.
START_VALUES = 1000


class _BaselineProcessor(StatefulProcessor):
    """Scores one user's events of a micro-batch in time order and keeps the learned counts.

    A user with few values has one row of state, which is read and written once for a micro-batch. With more values it
    holds the totals and the counts of the 24 hours, and every other value has an entry of its own.
    """

    def __init__(self, min_events: int, threshold: float, only_anomalies: bool):
        self.min_events = min_events
        self.threshold = threshold
        self.only_anomalies = only_anomalies

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "total bigint, failed bigint, hours array<bigint>, values string")
        self.counts = handle.getMapState("counts", "dimension string, value string", "n bigint")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        baseline, many = self._totals()
        for entry in json.loads(initialState["counts"]):
            baseline.carry(entry["dimension"], entry.get("value"), entry["events"])
        self._store(baseline, many, {})

    def _totals(self) -> tuple[Baseline, bool]:
        """What the user's row holds, and whether its values have entries."""
        baseline = Baseline()
        found = self.totals.get()
        if found is None:
            return baseline, False
        baseline.total, baseline.failed, hours, values = found
        baseline.counts[0].update({hour: n for hour, n in enumerate(hours) if n})
        for dimension, value, n in json.loads(values or "[]"):
            baseline.carry(dimension, value, n)
        return baseline, values is None

    def _load(self, traits: list[tuple]) -> tuple[Baseline, bool]:
        """The user's totals, and at least the counts of the values that these events have."""
        baseline, many = self._totals()
        if many:
            for place, dimension in enumerate(DIMENSIONS[1:], 1):
                for value in {t[place] for t in traits} - {None}:
                    found = self.counts.getValue((dimension, value))
                    if found is not None:
                        baseline.carry(dimension, value, int(found[0]))
        return baseline, many

    def _store(self, baseline: Baseline, many: bool, before: dict[tuple, int]) -> None:
        """Totals, and the counts, of entries only those that are not as ``before``."""
        hours = [baseline.counts[0].get(hour, 0) for hour in range(24)]
        values = [(d, v, n) for d, seen in zip(DIMENSIONS[1:], baseline.counts[1:]) for v, n in seen.items()]
        if not many and len(values) <= FEW_VALUES:
            self.totals.update((baseline.total, baseline.failed, hours, json.dumps(values)))
            return
        self.totals.update((baseline.total, baseline.failed, hours, None))
        for dimension, value, n in values:
            if not many or before.get((dimension, value)) != n:
                self.counts.updateValue((dimension, value), (n,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # One user's share of one micro-batch, which the trigger's limit bounds.
        events = sorted(map(_read, rows), key=itemgetter(0, 2))
        traits = [event[1] for event in events]
        baseline, many = self._load(traits)
        before = baseline.entries() if many else {}
        scores = [baseline.step(t, self.min_events, self.threshold) for t in traits]
        self._store(baseline, many, before)
        for event, found in zip(events, scores):
            if found is not None or not self.only_anomalies:
                yield _Scored(event[2], *(found or _NO_SCORES))

    def close(self) -> None:
        pass


_Scored = Row("event", *SCORES)
_NO_SCORES = (None,) * len(SCORES)


def _read(row: Row) -> tuple:
    """An event's place in time, its traits and its text; without a time it comes last."""
    text = row[1]
    event = json.loads(text)
    ts_ms, event_id, arrival = (event.get(c) for c in ("ts_ms", "event_id", "arrival"))
    time = (ts_ms is None, ts_ms or 0, event_id is None, event_id or "", arrival is None, arrival or 0)
    return time, tuple(event.get(c) for c in TRAITS), text


def _packed(start: DataFrame) -> DataFrame:
    """Counts that users start with, in rows of a bounded number of them."""
    number = F.row_number().over(Window.partitionBy("user").orderBy("dimension", "value"))
    rows = start.withColumn("_row", F.floor((number - 1) / START_VALUES))
    listed = F.to_json(F.collect_list(F.struct("dimension", "value", "events")))
    return rows.groupBy("user", "_row").agg(listed.alias("counts")).select("user", "counts")


def score_stream(
    events: DataFrame,
    min_events: int = MIN_EVENTS,
    threshold: float = THRESHOLD,
    only_anomalies: bool = False,
    start: DataFrame | None = None,
) -> DataFrame:
    """Every event with its scores, null unless it is an anomaly.

    State is keyed by user, a row for one with few values, else a count for each value, of which an event reads and writes
    its own; one user's events of a micro-batch are scored by one task, and the source's limit per trigger (offsets or files) is
    what bounds that task. ``start`` has counts that users begin with (``baseline_snapshot``); they are read with the
    first micro-batch only.
    """
    # Copies of a key come from one partition of a topic, where the offset tells which is later. A source without
    # positions cannot tell; of its copies in one micro-batch the one with the highest score counts as the last.
    place = next((c for c in ("offset", "arrival") if c in events.columns), None)
    arrival = F.col(place).cast("long") if place else F.lit(0).cast("long")
    facts = events.select(
        *EVENT_COLUMNS,
        arrival.alias("arrival"),
        hour_of_day("ts").alias("hour"),
        F.coalesce(F.col("status") == "failed", F.lit(False)).alias("failed"),
    ).withColumn("geo_location", F.nullif("geo_location", F.lit("")))
    # A row is handed over as one text, as every column of it would cost a conversion by itself.
    facts = facts.select("user", F.to_json(F.struct("*")).alias("event"))
    scored = facts.groupBy("user").transformWithState(
        statefulProcessor=_BaselineProcessor(min_events, min(1.0, max(0.0, threshold)), only_anomalies),
        outputStructType=f"event string, {_SCORES}",
        outputMode="Append",
        timeMode="None",
        initialState=None if start is None else _packed(start).groupBy("user"),
    )
    return scored.select(F.from_json("event", _CARRIED).alias("event"), *SCORES).select("event.*", *SCORES)


def _as_anomalies(scored: DataFrame, *more: str) -> DataFrame:
    return scored.select(
        *more,
        "event_id",
        "user",
        "ts_ms",
        "anomaly_score",
        (1 - F.col("p_hour")).alias("time_anomaly"),
        (1 - F.col("p_ip")).alias("ip_anomaly"),
        (1 - F.col("p_geo")).alias("location_anomaly"),
        (1 - F.col("p_type")).alias("type_anomaly"),
        "failure_anomaly",
        anomaly_reasons().alias("reasons"),
    )


def baseline_stream(
    events: DataFrame, min_events: int = MIN_EVENTS, threshold: float = THRESHOLD, start: DataFrame | None = None
) -> DataFrame:
    """Anomalies of an event stream, by the same rule as the batch detector.

    Within a micro-batch a user's events are taken in time order; an event that arrives in a later
    micro-batch is scored then, as arrival order decides between batches. With ``start``, the counts of a batch
    snapshot, the stream goes on where the batch detector ended.
    """
    return _as_anomalies(score_stream(events, min_events, threshold, True, start))


# --- sinks -----------------------------------------------------------------------------------


def micro_batch_hook(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    trigger: str = "10 seconds",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` per micro-batch; progress is kept in the checkpoint.

    A query keeps the number of state partitions it first starts with and they are not merged at
    run time, so it is worth choosing: about the cores of the cluster, more for large state.
    """
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    conf = stream.sparkSession.conf
    conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    before = conf.get(SHUFFLE_PARTITIONS)
    try:
        conf.set(SHUFFLE_PARTITIONS, str(state_partitions or before))
        return writer.start()
    finally:
        conf.set(SHUFFLE_PARTITIONS, before)


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch's rows to its own folder; running the batch again replaces them."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_latest(spark: SparkSession, path: str, key: tuple[str, ...]) -> DataFrame:
    """A table written by micro-batches, with later batches replacing rows of the same key."""
    return latest_per_key(spark.read.parquet(path), key, "batch_id").drop("batch_id")


def event_pipeline_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    min_events: int = MIN_EVENTS,
    threshold: float = THRESHOLD,
    min_score: float = HIGH_THREAT,
    available_now: bool = False,
    trigger: str = "10 seconds",
    state_partitions: int | None = None,
) -> StreamingQuery:
    """The whole speed layer: store events, score them, store anomalies, pick events to analyse.

    Scores come from one stateful query; every micro-batch then writes ``events``, ``anomalies``,
    ``to_analyse`` and ``counters`` below ``path``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Four tables are written from the batch; it is scored once.
        batch = batch.persist()
        try:
            anomalous = F.col("anomaly_score").isNotNull()
            stored = latest_per_key(batch.select(*EVENT_COLUMNS, "arrival"), EVENT_KEY, "arrival", "threat_score").drop("arrival")
            found = latest_per_key(_as_anomalies(batch.where(anomalous), "arrival"), ANOMALY_KEY, "arrival", "anomaly_score").drop("arrival")
            chosen = batch.where((F.col("threat_score") >= min_score) | anomalous).select(
                "event_id", "threat_score", anomalous.alias("is_anomalous")
            )
            counters = batch.groupBy("event_type").agg(
                F.count("*").alias("processed"), F.count_if(anomalous).alias("anomalies")
            )
            tables = {"events": stored, "anomalies": found, "to_analyse": chosen, "counters": counters}
            for name, rows in tables.items():
                write_batch(rows, f"{path}/{name}", batch_id)
        finally:
            batch.unpersist()

    scored = score_stream(events, min_events, threshold)
    return micro_batch_hook(scored, handle, checkpoint, available_now, trigger, state_partitions)


# --- live counters ---------------------------------------------------------------------------------

CONSUMER = "consumer"
_PROGRESS = "query string, batch_id bigint, at timestamp, duration_ms bigint, messages bigint, errors bigint"


def counted_stream(messages: DataFrame, ok: Column) -> DataFrame:
    """The same stream, whose micro-batches report how many messages they have and how many are not ``ok``."""
    errors = F.count_if(~F.coalesce(ok, F.lit(False)))
    return messages.observe(CONSUMER, F.count(F.lit(1)).alias("messages"), errors.alias("errors"))


class ProgressLog(StreamingQueryListener):
    """Writes a progress row for each micro-batch of the counted streams, in a file of its own; a batch run again replaces it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(CONSUMER)
        if counts is not None:
            row = {"query": str(progress.id), "batch_id": progress.batchId, "at": progress.timestamp, "duration_ms": progress.batchDuration}
            write_note(self.spark, f"{self.path}/{progress.id}-{progress.batchId}.json", row | counts.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def rows(self) -> DataFrame:
        return self.spark.read.schema(_PROGRESS).json(self.path)

    def settle(self, query: StreamingQuery, seconds: float = 30.0) -> None:
        """Wait until the last batch of a query that has ended is written; progress is reported a little later."""
        last = query.lastProgress
        until = time.monotonic() + seconds
        while last and read_note(self.spark, f"{self.path}/{last['id']}-{last['batchId']}.json") is None and time.monotonic() < until:
            time.sleep(0.1)


def live_rates(progress: DataFrame) -> DataFrame:
    """Messages, errors, messages a second and success share of each query so far."""
    sums = progress.groupBy("query").agg(
        F.count("*").alias("batches"), F.sum("messages").alias("messages"), F.sum("errors").alias("errors"), F.sum("duration_ms").alias("_ms")
    )
    return sums.select(
        "query", "batches", "messages", "errors",
        ratio(F.col("messages") * 1000, "_ms").alias("per_second"),
        ratio((F.col("messages") - F.col("errors")) * 100, "messages").alias("success_percent"),
    )


# --- windows, duplicates and late events --------------------------------------------------------


def tumbling_rates(
    stream: DataFrame, size: str = "1 minute", seconds: int = 60, keys: tuple[str, ...] = ("event_type",),
    delay: str = DEFAULT_DELAY,
) -> DataFrame:
    """Events per window and key, and their rate per second; a window is final ``delay`` after its end."""
    counted = (
        stream.withWatermark("ts", delay).groupBy(F.window("ts", size), *keys).agg(F.count("*").alias("increase"))
    )
    return counted.select(
        F.unix_millis("window.start").alias("window_start_ms"),
        *keys,
        "increase",
        (F.col("increase") / seconds).alias("per_second"),
    )


def sliding_features(events: DataFrame, window_hours: int = 24, slide_hours: int = 1) -> DataFrame:
    """Per-user features of overlapping windows, for a stored table.

    Events are reduced to panes of one slide. What a window holds changes only where a pane enters or leaves it, so a
    user's time line has at most three points for each pane, and between two points all windows are alike. An
    address or type enters the windows with its first pane out of reach of the one before, and leaves after its pane:
    +1 and -1, whose running sum is the exact distinct count. Other measures are taken over the panes in reach of
    a point. A pane's row is never repeated for the windows that cover it; windows are listed at the end only.
    Points are many times the bytes of their events, so tasks are dealt by the size of the input.
    """
    parts = shuffle_parts(events, SLIDING_BYTES)
    slide_s, width = slide_hours * 3600, window_hours // slide_hours
    measures = ["n", "score", "scored", "top_score", "failed", "unusual"]
    cells = events.groupBy("user", F.floor(F.unix_seconds("ts") / slide_s).alias("pane"), "source_ip", "event_type").agg(
        F.count("*").alias("n"),
        F.sum("threat_score").alias("score"),
        F.count("threat_score").alias("scored"),
        F.max("threat_score").alias("top_score"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(hour_of_day("ts").between(*UNUSUAL_HOURS)).alias("unusual"),
    )
    # A cell names an address, with its measures, and a type.
    named = F.array(
        F.struct(F.lit("ip").alias("kind"), F.col("source_ip").alias("value"), *measures),
        F.struct(F.lit("type").alias("kind"), F.col("event_type").alias("value"), *[F.lit(None).cast(t).alias(c) for c, t in zip(measures, ["bigint", "double", "bigint", "double", "bigint", "bigint"], strict=True)]),
    )
    values = cells.where("pane IS NOT NULL").select("user", "pane", F.explode(named).alias("v")).select("user", "pane", "v.*")
    values = values.where("kind = 'ip' OR value IS NOT NULL")
    totals = {c: F.max(c) if c == "top_score" else F.sum(c) for c in measures}
    values = values.repartition(parts, "user", "kind", "value").groupBy("user", "kind", "value", "pane").agg(*[f.alias(c) for c, f in totals.items()])
    before = F.lag("pane").over(Window.partitionBy("user", "kind", "value").orderBy("pane"))
    enters = F.greatest(F.col("pane") - (width - 1), before + 1)
    values = values.withColumn("enters", enters)

    def point(at: Column, change: int, measured: bool) -> Column:
        one = lambda kind: F.when((F.col("kind") == kind) & F.col("value").isNotNull(), change).otherwise(0)
        return F.struct(
            at.alias("x"), one("ip").alias("ips"), one("type").alias("types"),
            *[(F.col(c) if measured else F.lit(None)).cast("double" if "score" in c and c != "scored" else "bigint").alias(c) for c in measures],
        )

    change = F.array(point(F.col("enters"), 1, False), point(F.col("pane") + 1, -1, False))
    # The first window that holds a pane starts at a point, whatever its addresses have been before.
    held = F.array(point(F.col("pane"), 0, True), point(F.col("pane") - (width - 1), 0, False))
    points = F.when(F.col("kind") == "ip", F.concat(change, held)).otherwise(change)
    line = values.select("user", F.explode(points).alias("p")).select("user", "p.*")
    line = line.groupBy("user", "x").agg(F.sum("ips").alias("ips"), F.sum("types").alias("types"), *[f.alias(c) for c, f in totals.items()])
    line = line.repartition(parts, "user")
    along = Window.partitionBy("user").orderBy("x")
    upto, reach = along.rowsBetween(Window.unboundedPreceding, 0), along.rangeBetween(0, width - 1)
    line = line.select(
        "user",
        F.col("x").alias("start"),
        F.lead("x").over(along).alias("end"),
        F.sum("n").over(reach).alias("total_events"),
        F.sum("ips").over(upto).alias("unique_ips"),
        F.sum("types").over(upto).alias("unique_event_types"),
        ratio(F.sum("score").over(reach), F.sum("scored").over(reach)).alias("avg_threat_score"),
        F.max("top_score").over(reach).alias("max_threat_score"),
        F.sum("failed").over(reach).alias("failed_events"),
        F.sum("unusual").over(reach).alias("unusual_hour_events"),
    )
    step = slide_s * 1000
    starts = F.explode(F.sequence(F.col("start") * step, (F.col("end") - 1) * step, F.lit(step)))
    return line.where("total_events > 0").withColumn("window_start_ms", starts).select("window_start_ms", *[c for c in line.columns if c not in ("start", "end")])


def sliding_feature_stream(
    stream: DataFrame, size: str = "24 hours", slide: str = "1 hour", delay: str = DEFAULT_DELAY, together: int = 6
) -> DataFrame:
    """The same windows over a stream. Distinct counts are exact: the state holds a group's events.

    ``together`` neighbouring windows of a user are one group, to which an event goes once instead of once for each window;
    it comes with the first and the last of the group's windows that hold it. What a window holds changes only
    where an event enters or leaves, so measures are taken once for each stretch of like windows, and windows are listed at
    the end only. A group is final ``delay`` after the end of its last window, and late events count until then.
    """
    group = F.window("ts", " ".join([size] + [slide] * (together - 1)), " ".join([slide] * together))
    zero = F.timestamp_seconds(F.lit(0))
    width, step = (F.unix_micros(zero + F.expr(f"interval {x}")) for x in (size, slide))
    since = F.unix_micros("ts") - F.unix_micros("window.start")
    number = lambda x: F.floor(x / step).cast("int")
    event = F.struct(
        F.greatest(F.lit(0), number(since - width) + 1).alias("first"),
        F.least(F.lit(together - 1), number(since)).alias("last"),
        "source_ip",
        "event_type",
        "threat_score",
        (F.col("status") == "failed").alias("failed"),
        hour_of_day("ts").between(*UNUSUAL_HOURS).alias("unusual"),
    )
    groups = stream.withWatermark("ts", delay).withColumn("window", group).select("window", "user", event.alias("e"))
    groups = groups.groupBy("window", "user").agg(F.collect_list("e").alias("events"))
    every = F.col("events")
    changes = F.array_union(F.array_distinct(F.transform(every, lambda e: e["first"])), F.transform(every, lambda e: e["last"] + 1))
    starts = F.array_sort(F.filter(changes, lambda n: n < together))
    stretches = F.transform(
        starts,
        lambda n, i: F.struct(
            n.alias("from"),
            (F.coalesce(F.get(starts, i + 1), F.lit(together)) - 1).alias("to"),
            F.filter(every, lambda e: (e["first"] <= n) & (n <= e["last"])).alias("events"),
        ),
    )
    held = F.filter(stretches, lambda x: F.size(x["events"]) > 0)
    rows = groups.select("window", "user", F.explode(held).alias("x"))
    of = lambda name: F.transform("x.events", lambda e: e[name])
    kinds = lambda name: F.size(F.array_distinct(F.array_compact(of(name)))).cast("bigint")
    true = lambda name: F.size(F.filter("x.events", lambda e: e[name])).cast("bigint")
    scores = F.array_compact(of("threat_score"))
    rows = rows.select(
        F.size("x.events").cast("bigint").alias("total_events"),
        "user",
        kinds("source_ip").alias("unique_ips"),
        kinds("event_type").alias("unique_event_types"),
        ratio(F.aggregate(scores, F.lit(0.0), lambda a, x: a + x), F.size(scores)).alias("avg_threat_score"),
        F.array_max(scores).alias("max_threat_score"),
        true("failed").alias("failed_events"),
        true("unusual").alias("unusual_hour_events"),
        F.explode(F.sequence("x.from", "x.to")).alias("n"),
        "window",
    )
    return rows.withColumn("window_start_ms", F.unix_millis(F.timestamp_micros(F.unix_micros("window.start") + F.col("n") * step))).drop("window", "n")


def stream_dedup(stream: DataFrame, keys: tuple[str, ...] = ("event_id",), delay: str = DEFAULT_DELAY) -> DataFrame:
    """Each event once, as long as its copies arrive within ``delay`` of each other."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def late_data(
    stream: DataFrame, path: str, checkpoint: str, delay_ms: int = 600_000, available_now: bool = False
) -> StreamingQuery:
    """Sort events into ``on_time`` and ``late`` tables below ``path``.

    An event is late if it lies more than ``delay_ms`` before the newest event of the earlier
    micro-batches. That mark is written per batch, so a batch that runs again decides alike.
    """
    spark = stream.sparkSession
    marks = f"{path}/newest"

    def handle(batch: DataFrame, batch_id: int) -> None:
        # One row per micro-batch: the newest time up to and including it.
        newest = spark.read.parquet(f"{marks}/batch_id={batch_id - 1}").first()[0] if batch_id else None
        is_late = F.lit(False) if newest is None else F.coalesce(F.col("ts_ms") < newest - delay_ms, F.lit(False))
        batch = batch.withColumn("_late", is_late).persist()
        try:
            write_batch(batch.where("not _late").drop("_late"), f"{path}/on_time", batch_id)
            write_batch(batch.where("_late").drop("_late"), f"{path}/late", batch_id)
            upto = F.greatest(F.max("ts_ms"), F.lit(newest).cast("bigint")).alias("ts_ms")
            write_batch(batch.agg(upto), marks, batch_id)
        finally:
            batch.unpersist()

    return micro_batch_hook(stream, handle, checkpoint, available_now)
