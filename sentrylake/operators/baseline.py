"""Scoring events against their user's learned baseline.

Two detectors share the scoring rule. ``baseline_anomaly_detector`` keeps learning from events it
accepts, so each decision depends on the ones before it; ``frozen_baseline_detector`` learns from
the first events only and is plain relational algebra.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrylake.functions.scalar import (
    NEUTRAL_PROBABILITY,
    UNSEEN_PROBABILITY,
    clamp01,
    hour_of_day,
    rarity,
    ratio,
)
from sentrylake.functions.text import anomaly_reasons
from sentrylake.operators.skew import attach_by_key
from sentrylake.session import materialize

# Weights of the parts of the score and the rule for rare failures.
WEIGHTS = {"time": 0.25, "ip": 0.30, "location": 0.20, "type": 0.15, "failure": 0.10}
FAILURE_PART = 0.8
LOW_FAILURE_RATE = 0.1
# Defaults of the detector.
MIN_EVENTS = 100
THRESHOLD = 0.5

# A user's time line is scored in parts of about this many events, of more where all events make over MOST_PARTS parts.
PART_ROWS = 1_000_000
MOST_PARTS = 10_000
# Rounds after which the settled events of a run are taken and the rest starts anew.
ROUNDS = 64

DIMENSIONS = ("hour", "source_ip", "geo_location", "event_type")


def _facts(events: DataFrame) -> DataFrame:
    """The narrow row a detector needs."""
    return events.select(
        "event_id",
        "user",
        "ts_ms",
        hour_of_day("ts").alias("hour"),
        "source_ip",
        F.nullif("geo_location", F.lit("")).alias("geo_location"),
        "event_type",
        F.coalesce(F.col("status") == "failed", F.lit(False)).alias("failed"),
    )


def _anomaly_row() -> list[Column]:
    """The result columns from the event's facts, its probabilities and its score."""
    return [
        F.col("event_id"),
        F.col("user"),
        F.col("ts_ms"),
        F.col("anomaly_score"),
        (1 - F.col("p_hour")).alias("time_anomaly"),
        (1 - F.col("p_ip")).alias("ip_anomaly"),
        (1 - F.col("p_geo")).alias("location_anomaly"),
        (1 - F.col("p_type")).alias("type_anomaly"),
        F.col("failure_anomaly"),
        anomaly_reasons().alias("reasons"),
    ]


# --- learning phase -------------------------------------------------------------------------


def _learned(events: DataFrame, n: int) -> DataFrame:
    """Each user's first ``n`` events by (time, id); cut per task before the shuffle."""
    order = Window.partitionBy("user").orderBy("ts_ms", "event_id")
    return events.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def _position() -> Column:
    return F.struct("ts_ms", "event_id")


def learning_phase_split(events: DataFrame, n: int = MIN_EVENTS, **split) -> DataFrame:
    """Every event with ``phase``: ``train`` for its user's first ``n`` events, ``score`` after them."""
    last = _learned(events.select("user", "ts_ms", "event_id"), n).groupBy("user").agg(
        F.max(_position()).alias("_cutoff")
    )
    sizes = events.groupBy("user").agg(F.count("*").alias("_events"))
    rows = attach_by_key(events, sizes.join(last, "user"), ["user"], "_events", "event_id", sizes=sizes, **split)
    return rows.select(
        *events.columns, F.when(_position() <= F.col("_cutoff"), "train").otherwise("score").alias("phase")
    )


# --- frozen baseline ------------------------------------------------------------------------


def _count_map(values: Column) -> Column:
    """How often each value occurs in a list of at most ``n`` learned values."""
    return F.map_from_entries(
        F.transform(
            F.array_distinct(values), lambda v: F.struct(v, F.size(F.filter(values, lambda w: w == v)))
        )
    )


def frozen_baseline(events: DataFrame, n: int = MIN_EVENTS) -> DataFrame:
    """What each user's first ``n`` events look like: one bounded row per user that has that many."""
    lists = {d: F.collect_list(d) for d in DIMENSIONS}
    return (
        _learned(_facts(events), n)
        .groupBy("user")
        .agg(
            F.count("*").alias("learned"),
            ratio(F.count_if("failed"), F.count("*")).alias("failure_rate"),
            F.max(_position()).alias("cutoff"),
            *[values.alias(f"{d}_list") for d, values in lists.items()],
        )
        .where(F.col("learned") == n)
        .select(
            "user",
            "learned",
            "failure_rate",
            "cutoff",
            *[_count_map(F.col(f"{d}_list")).alias(f"{d}_counts") for d in DIMENSIONS],
        )
    )


def frozen_baseline_detector(
    events: DataFrame, n: int = MIN_EVENTS, threshold: float = THRESHOLD, **split
) -> DataFrame:
    """Anomalies among the events after each user's first ``n``, by what those ``n`` events show."""
    threshold = min(1.0, max(0.0, threshold))
    facts = _facts(events)
    sizes = events.groupBy("user").agg(F.count("*").alias("_events"))
    baseline = sizes.join(frozen_baseline(events, n), "user")
    rows = attach_by_key(facts, baseline, ["user"], "_events", "event_id", sizes=sizes, **split)

    def p(dimension: str, **kw) -> Column:
        seen = F.try_element_at(F.col(f"{dimension}_counts"), F.col(dimension))
        return rarity(seen, "learned", **kw)

    failure = F.when(F.col("failed") & (F.col("failure_rate") < LOW_FAILURE_RATE), FAILURE_PART).otherwise(0.0)
    score = clamp01(
        (1 - F.col("p_hour")) * WEIGHTS["time"]
        + (1 - F.col("p_ip")) * WEIGHTS["ip"]
        + (1 - F.col("p_geo")) * WEIGHTS["location"]
        + (1 - F.col("p_type")) * WEIGHTS["type"]
        + F.col("failure_anomaly") * WEIGHTS["failure"]
    )
    return (
        rows.where(_position() > F.col("cutoff"))
        .select(
            *facts.columns,
            p("hour").alias("p_hour"),
            p("source_ip").alias("p_ip"),
            p("geo_location", known=F.col("geo_location").isNotNull()).alias("p_geo"),
            p("event_type").alias("p_type"),
            failure.alias("failure_anomaly"),
        )
        .withColumn("anomaly_score", score)
        .where(F.col("anomaly_score") >= threshold)
        .select(*_anomaly_row())
    )


# --- adaptive baseline ----------------------------------------------------------------------


class Baseline:
    """Counts of one user's accepted events; small, and the same in batch and streaming."""

    __slots__ = ("counts", "total", "failed")

    def __init__(self):
        self.counts: tuple[dict, ...] = tuple({} for _ in DIMENSIONS)
        self.total = 0
        self.failed = 0

    def score(self, traits: tuple) -> tuple:
        """Probabilities of the event's traits, its failure part and its score."""
        *values, failed = traits
        total = self.total
        p = [
            NEUTRAL_PROBABILITY if not total or value is None
            else seen[value] / total if value in seen
            else UNSEEN_PROBABILITY
            for seen, value in zip(self.counts, values)
        ]
        rare_failure = failed and (self.failed / total if total else 0.0) < LOW_FAILURE_RATE
        failure = FAILURE_PART if rare_failure else 0.0
        weighted = (
            (1 - p[0]) * WEIGHTS["time"]
            + (1 - p[1]) * WEIGHTS["ip"]
            + (1 - p[2]) * WEIGHTS["location"]
            + (1 - p[3]) * WEIGHTS["type"]
            + failure * WEIGHTS["failure"]
        )
        return *p, failure, min(1.0, max(0.0, weighted))

    def learn(self, traits: tuple) -> None:
        *values, failed = traits
        for seen, value in zip(self.counts, values):
            if value is not None:
                seen[value] = seen.get(value, 0) + 1
        self.total += 1
        self.failed += bool(failed)

    def step(self, traits: tuple, min_events: int, threshold: float) -> tuple | None:
        """Take one event: its scores if it is anomalous, else learn from it and return nothing."""
        if self.total >= min_events:
            scores = self.score(traits)
            if scores[-1] >= threshold:
                return scores
        self.learn(traits)
        return None

    def carry(self, dimension: str, value, count: int) -> None:
        """Start from a count that earlier events left behind."""
        if dimension == "total":
            self.total = count
        elif dimension == "failed":
            self.failed = count
        elif count:
            self.counts[DIMENSIONS.index(dimension)][int(value) if dimension == "hour" else value] = count

    def entries(self) -> dict[tuple, int]:
        """All counts by (dimension, value as text)."""
        found = {(d, str(v)): n for d, seen in zip(DIMENSIONS, self.counts) for v, n in seen.items()}
        return {**found, ("total", None): self.total, ("failed", None): self.failed}


TRAITS = [*DIMENSIONS, "failed"]
SCORES = ["p_hour", "p_ip", "p_geo", "p_type", "failure_anomaly", "anomaly_score"]
_EVENT = ["event_id", "user", "ts_ms", *DIMENSIONS]

_FLAGGED = (
    "event_id string, user string, ts_ms bigint, hour int, source_ip string, geo_location string, "
    "event_type string, p_hour double, p_ip double, p_geo double, p_type double, "
    "failure_anomaly double, anomaly_score double"
)
_ACCEPTED = "user string, part int, dimension string, value string, accepted bigint"


def _owners(rows: pa.RecordBatch) -> np.ndarray:
    """Numbers of the (user, part) of each row, counted up from 0 wherever it changes."""
    user = rows["user"].dictionary_encode().indices.fill_null(-1).to_numpy()
    part = rows["part"].to_numpy()
    return np.cumsum(np.concatenate([[False], (user[1:] != user[:-1]) | (part[1:] != part[:-1])]))


class _Groups:
    """Rows by key: for flags of the rows, how many flagged rows of the same key come before each."""

    def __init__(self, key: np.ndarray):
        self.order = np.argsort(key, kind="stable")
        ordered = key[self.order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        self.head = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))

    def before(self, flags: np.ndarray) -> np.ndarray:
        flags = flags[self.order].astype(np.int64)
        running = np.cumsum(flags) - flags
        out = np.empty(len(flags), np.int64)
        out[self.order] = running - running[self.head]
        return out


def _carried_counts(key: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts of ``key`` in a list of known keys, 0 where it has none."""
    if not len(known):
        return np.zeros(len(key), np.int64)
    order = np.argsort(known)
    known, counts = known[order], counts[order]
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    return np.where(known[at] == key, counts[at], 0)


class _Run:
    """Consecutive rows of one or more (user, part), earlier counts first, decided together.

    The decision on an event follows from those on earlier events of its owner. All are first taken as accepted;
    counts of accepted events by key, running sums, then give new decisions for all rows at once. Each round makes
    at least the first open decision right, and decisions that repeat are those of one pass in order.
    """

    def __init__(self, rows: pa.RecordBatch, state: Baseline):
        self.state = state
        self.size = rows.num_rows
        self.owner = _owners(rows)
        seed = rows["dimension"].is_valid().to_numpy(zero_copy_only=False)
        self.events, self.seeds = np.flatnonzero(~seed), np.flatnonzero(seed)
        self.own = self.owner[self.events]
        self.failed = rows["failed"].fill_null(False).to_numpy(zero_copy_only=False)[self.events]
        earlier = rows.take(pa.array(self.seeds))
        self.kinds, self.seed_values = earlier["dimension"].to_pylist(), earlier["value"]
        self.carried = earlier["carried"].to_numpy() if len(self.seeds) else np.zeros(0, np.int64)
        self.total = self._start("total", state.total)
        self.failures = self._start("failed", state.failed)
        self.vocabulary, self.codes, self.start, self.groups = [], [], [], []
        for dimension, seen in zip(DIMENSIONS, state.counts):
            self._read(rows[dimension].dictionary_encode(), dimension, seen)
        self.by_owner = _Groups(self.own) if len(self.own) else None

    def _of(self, dimension: str) -> np.ndarray:
        return np.array([i for i, kind in enumerate(self.kinds) if kind == dimension], np.int64)

    def _start(self, name: str, held: int) -> np.ndarray:
        counts = np.zeros(self.owner[-1] + 1, np.int64)
        counts[0] = held
        mine = self._of(name)
        counts[self.owner[self.seeds[mine]]] = self.carried[mine]
        return counts[self.own]

    def _read(self, values: pa.DictionaryArray, dimension: str, seen: dict) -> None:
        words = values.dictionary
        codes = values.indices.fill_null(-1).to_numpy()[self.events].astype(np.int64)
        names = words.to_pylist()
        held = np.array([seen.get(v, 0) for v in names] + [0], np.int64)  # a null has code -1, the last place
        width = len(names) + 1
        key = self.own * width + codes + 1
        mine = self._of(dimension)
        place = pc.index_in(self.seed_values.take(pa.array(mine)), value_set=words.cast(pa.string()))
        found = place.is_valid().to_numpy(zero_copy_only=False)
        known = self.owner[self.seeds[mine[found]]] * width + place.drop_null().to_numpy() + 1
        self.start.append(np.where(self.own == 0, held[codes], 0) + _carried_counts(key, known, self.carried[mine[found]]))
        self.vocabulary.append(names)
        self.codes.append(codes)
        self.groups.append(_Groups(key) if len(key) else None)

    def _scores(self, accepted: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        total = self.total + self.by_owner.before(accepted)
        some = np.maximum(total, 1)
        p = []
        for codes, start, group in zip(self.codes, self.start, self.groups):
            seen = start + group.before(accepted)
            rate = np.where(seen > 0, seen / some, UNSEEN_PROBABILITY)
            p.append(np.where((total == 0) | (codes < 0), NEUTRAL_PROBABILITY, rate))
        failures = self.failures + self.by_owner.before(accepted & self.failed)
        failure = np.where(self.failed & (failures / some < LOW_FAILURE_RATE), FAILURE_PART, 0.0)
        weighted = (
            (1 - p[0]) * WEIGHTS["time"]
            + (1 - p[1]) * WEIGHTS["ip"]
            + (1 - p[2]) * WEIGHTS["location"]
            + (1 - p[3]) * WEIGHTS["type"]
            + failure * WEIGHTS["failure"]
        )
        return total, [*p, failure, np.clip(weighted, 0.0, 1.0)]

    def settle(self, min_events: int, threshold: float) -> tuple[int, np.ndarray, list[np.ndarray]]:
        """How many rows are decided, which of them are anomalies, and the scores of these."""
        n = len(self.events)
        accepted, done, scores = np.ones(n, bool), n, [np.zeros(0)] * len(SCORES)
        for _ in range(ROUNDS if n else 0):
            total, scores = self._scores(accepted)
            now = (total < min_events) | (scores[-1] < threshold)
            changed = np.flatnonzero(now != accepted)
            accepted = now
            # Scores up to the first change, that one included, were taken from final decisions.
            done = changed[0] + 1 if len(changed) else n
            if done == n:
                break
        hits = np.flatnonzero(~accepted[:done])
        self.accepted = accepted[:done]
        self.decided = int(self.events[done]) if done < n else self.size
        return self.decided, self.events[hits], [s[hits] for s in scores]

    def last_state(self) -> Baseline:
        """Counts of the last owner after the decided rows."""
        last = self.owner[self.decided - 1]
        state = self.state if last == 0 else Baseline()
        at = self.seeds[self.seeds < self.decided]
        for i in np.flatnonzero(self.owner[at] == last):
            state.carry(self.kinds[i], self.seed_values[int(i)].as_py(), int(self.carried[i]))
        learned = np.flatnonzero(self.accepted & (self.own[: len(self.accepted)] == last))
        for seen, names, codes in zip(state.counts, self.vocabulary, self.codes):
            mine = codes[learned]
            found, counts = np.unique(mine[mine >= 0], return_counts=True)
            for code, count in zip(found.tolist(), counts.tolist()):
                seen[names[code]] = seen.get(names[code], 0) + count
        state.total += len(learned)
        state.failed += int(self.failed[learned].sum())
        return state


def _runs(
    batches: Iterator[pa.RecordBatch], min_events: int, threshold: float, single: bool = False
) -> Iterator[tuple[tuple, pa.RecordBatch, np.ndarray, list[np.ndarray], Baseline, int]]:
    """Decided runs of a partition: the last owner, the rows, places and scores of anomalies, the last owner's counts, and
    how many of the rows are decided. With ``single`` a run has one owner. A run that does not settle is halved."""
    owner, state, most = None, Baseline(), 1 << 30
    for batch in batches:
        while batch.num_rows:
            rows = batch.slice(0, most)
            if single:
                rows = rows.slice(0, int(np.searchsorted(_owners(rows), 1)))
            first = (rows["user"][0].as_py(), rows["part"][0].as_py())
            run = _Run(rows, state if first == owner else Baseline())
            done, hits, scores = run.settle(min_events, threshold)
            most = min(1 << 30, 2 * most) if done == rows.num_rows else max(ROUNDS, rows.num_rows // 2)
            owner, state = (rows["user"][done - 1].as_py(), rows["part"][done - 1].as_py()), run.last_state()
            yield owner, rows, hits, scores, state, done
            batch = batch.slice(done)


def _flagging(min_events: int, threshold: float):
    """Per partition: emit the anomalous events. A user's state outlives the Arrow batch."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows, hits, scores, _, _ in _runs(batches, min_events, threshold):
            if len(hits):
                events = rows.select(_EVENT).take(pa.array(hits))
                scores = [pa.array(column, pa.float64()) for column in scores]
                yield pa.RecordBatch.from_arrays([*events.columns, *scores], names=[*_EVENT, *SCORES])

    return fold


def _accepting(min_events: int, threshold: float):
    """Per partition: emit what each part of a user's events adds to its counts."""

    def gains(owner: tuple, before: dict, state: Baseline) -> pa.RecordBatch:
        rows = [(*owner, *key, n - before.get(key, 0)) for key, n in state.entries().items()]
        kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64()]
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["user", "part", "dimension", "value", "accepted"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, before, state = None, {}, Baseline()
        for owner, rows, _, _, after, done in _runs(batches, min_events, threshold, single=True):
            if owner != key:
                if key is not None:
                    yield gains(key, before, state)
                key, before = owner, {}
            state = after
            seeds = rows.slice(0, done).filter(rows.slice(0, done)["dimension"].is_valid())
            before.update(zip(zip(seeds["dimension"].to_pylist(), seeds["value"].to_pylist()), seeds["carried"].to_pylist()))
        if key is not None:
            yield gains(key, before, state)

    return fold


_NO_CARRY = {"dimension": "string", "value": "string", "carried": "bigint"}


def _ordered(facts: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Rows of each (user, part) together and in time order, earlier counts first."""
    rows = facts.withColumns({name: F.lit(None).cast(kind) for name, kind in _NO_CARRY.items()})
    if carried is not None:
        rows = rows.unionByName(carried, allowMissingColumns=True)
    first = F.col("dimension").isNull()
    return rows.repartition("user", "part").sortWithinPartitions("user", "part", first, "ts_ms", "event_id")


def _of_users(facts: DataFrame, users: DataFrame, how: str) -> DataFrame:
    """Events of the listed users, or of all others; events without a user are those of one user."""
    listed = users.select(F.col("user").alias("_user"))
    return facts.join(F.broadcast(listed), F.col("user").eqNullSafe(F.col("_user")), how)


def _parts(facts: DataFrame, large: DataFrame, part_rows: int) -> DataFrame:
    """Events of the large users, each with the part of its user's time line it falls in.

    Part borders are time quantiles from a sketch, so a border never splits equal times and the
    parts are about even whatever the user's rhythm.
    """
    mine = _of_users(facts, large, "left_semi")
    # As many quantiles as the largest user has parts.
    steps = max(2, -(-(large.agg(F.max("n")).first()[0] or 0) // part_rows))
    quantiles = F.percentile_approx("ts_ms", F.lit([i / steps for i in range(1, steps)]), max(10_000, 10 * steps))
    wanted = F.ceil(F.col("n") / part_rows).cast("int")
    border = lambda i: F.element_at("quantiles", F.greatest(F.lit(1), F.floor(i * steps / wanted)).cast("int"))
    borders = (
        mine.groupBy("user")
        .agg(quantiles.alias("quantiles"), F.count("*").alias("n"))
        .select(
            F.col("user").alias("_user"),
            F.when(wanted > 1, F.transform(F.sequence(F.lit(1), wanted - 1), border))
            .otherwise(F.array().cast("array<bigint>"))
            .alias("borders"),
        )
    )
    return mine.join(F.broadcast(borders), F.col("user").eqNullSafe(F.col("_user"))).select(
        *facts.columns, F.size(F.filter("borders", lambda b: b < F.col("ts_ms"))).alias("part")
    )


def _additions(rows: DataFrame) -> DataFrame:
    """What each part would add to its user's counts if every event were accepted."""
    entry = lambda d, v, n: F.struct(F.lit(d).alias("dimension"), v.alias("value"), n.alias("n"))
    one, none = F.lit(1).cast("bigint"), F.lit(None).cast("string")
    entries = [entry(d, F.col(d).cast("string"), one) for d in DIMENSIONS]
    entries += [entry("total", none, one), entry("failed", none, F.col("failed").cast("bigint"))]
    long = rows.select("user", "part", F.explode(F.array(*entries)).alias("e")).select("user", "part", "e.*")
    kept = long.where(F.col("value").isNotNull() | F.col("dimension").isin("total", "failed"))
    return kept.groupBy("user", "part", "dimension", "value").agg(F.sum("n").alias("accepted"))


def _carried(touched: DataFrame, gains: DataFrame) -> DataFrame:
    """Counts a part starts from, for every value that occurs in it: the sum over earlier parts."""
    earlier = (
        Window.partitionBy("user", "dimension", "value")
        .orderBy("part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    key = ["user", "part", "dimension", "value"]
    filled = touched.select(*key).unionByName(gains, allowMissingColumns=True).groupBy(*key).agg(
        F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted")
    )
    return filled.select(*key, F.coalesce(F.sum("accepted").over(earlier), F.lit(0)).alias("carried"))


def _settled_start(rows: DataFrame, min_events: int, threshold: float) -> DataFrame:
    """The counts that every part of every large user truly starts from.

    All parts are folded side by side from assumed starting counts, first as if every earlier event
    had been accepted; what they accept gives the next starting counts. Part 0 is right at once and
    each round makes at least one more part right, so when two rounds agree they equal the result
    of one pass in order. Every round is written out, which also cuts the lineage.
    """
    touched = materialize(_additions(rows), "additions")
    start = materialize(_carried(touched, touched), "start")
    part = ["user", "part"]
    key = [*part, "dimension", "value"]
    same = lambda one, other, names: reduce(
        Column.__and__, [F.col(f"{one}.{c}").eqNullSafe(F.col(f"{other}.{c}")) for c in names]
    )
    gains, changed = None, None
    while True:
        # Only parts whose starting counts are new are folded again; the others add what they did.
        again, seeds, kept = rows, start, None
        if changed is not None:
            listed = changed.select(*part).distinct()
            of = lambda table, how: table.alias("t").join(listed.alias("c"), same("t", "c", part), how)
            again, seeds, kept = of(rows, "left_semi"), of(start, "left_semi"), of(gains, "left_anti")
        folded = _ordered(again, seeds).mapInArrow(_accepting(min_events, threshold), _ACCEPTED)
        gains = materialize(folded if kept is None else folded.unionByName(kept), "gains")
        following = materialize(_carried(touched, gains), "start")
        changed = following.alias("n").join(start.alias("o"), same("n", "o", [*key, "carried"]), "left_anti")
        start = following
        if changed.isEmpty():
            return start


def baseline_anomaly_detector(
    events: DataFrame,
    min_events: int = MIN_EVENTS,
    threshold: float = THRESHOLD,
    single_task_rows: int = PART_ROWS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Anomalies of every user by a baseline that goes on learning from accepted events.

    A user's events are taken in (time, id) order. Until ``min_events`` are learned nothing is
    reported; after that an event that scores ``threshold`` or more is reported and not learned.

    Runs of events are decided together, so users are folded one after another in their partition at
    the speed of array sums, with only the current user's counts in memory. The time line of a user with more than
    ``single_task_rows`` events is cut into parts that are folded in parallel until their starting counts settle; the
    result is the same. There are at most about ``MOST_PARTS`` parts, so the list of such users is short.
    """
    threshold = min(1.0, max(0.0, threshold))
    facts = _facts(events)
    sizes = materialize(facts.groupBy("user").agg(F.count("*").alias("n")), "user-sizes")
    most, total = sizes.agg(F.max("n"), F.sum("n")).first()
    single_task_rows, part_rows = (max(rows, (total or 0) // MOST_PARTS) for rows in (single_task_rows, part_rows))
    fold = _flagging(min_events, threshold)
    if (most or 0) <= single_task_rows:
        flagged = _ordered(facts.withColumn("part", F.lit(0))).mapInArrow(fold, _FLAGGED)
        return flagged.select(*_anomaly_row())
    large_users = sizes.where(F.col("n") > single_task_rows)
    ordinary = _of_users(facts, large_users, "left_anti").withColumn("part", F.lit(0))
    cut = materialize(_parts(facts, large_users, part_rows), "parts")
    start = _settled_start(cut, min_events, threshold)
    flagged = _ordered(ordinary.unionByName(cut), start).mapInArrow(fold, _FLAGGED)
    return flagged.select(*_anomaly_row())


def accepted_events(events: DataFrame, min_events: int = MIN_EVENTS, threshold: float = THRESHOLD) -> DataFrame:
    """The events that the adaptive baseline has learned from: all but the anomalies it reported.

    Profiles and totals of these are the snapshot that the detector itself serves.
    """
    found = baseline_anomaly_detector(events, min_events, threshold).select("ts_ms", "event_id")
    return events.join(found, ["ts_ms", "event_id"], "left_anti")


def baseline_profiles(events: DataFrame) -> DataFrame:
    """What each user's history looks like: one row per user, dimension and value.

    Kept long, so that a user with very many addresses never becomes one huge row.
    """
    facts = _facts(events)
    entries = F.explode(
        F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in DIMENSIONS])
    )
    return (
        facts.select("user", entries.alias("e"))
        .where("e.value is not null")
        .groupBy("user", F.col("e.dimension").alias("dimension"), F.col("e.value").alias("value"))
        .agg(F.count("*").alias("events"))
    )


def baseline_snapshot(accepted: DataFrame) -> DataFrame:
    """The counts that a stream starts from: the profiles of the accepted events, and each user's totals."""
    totals = accepted.groupBy("user").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "failed").alias("failed"))
    long = totals.unpivot("user", ["total", "failed"], "dimension", "events")
    profiles = baseline_profiles(accepted)
    return profiles.unionByName(long.select("user", "dimension", F.lit(None).cast("string").alias("value"), "events"))


def baseline_totals(events: DataFrame, min_events: int = MIN_EVENTS) -> DataFrame:
    """Totals of each tracked user and whether its baseline is ready."""
    return events.groupBy("user").agg(
        F.count("*").alias("total_events"),
        F.count_if(F.col("status") == "failed").alias("failed_events"),
        F.avg("threat_score").alias("avg_threat_score"),
        (F.count("*") >= min_events).alias("is_baseline_ready"),
    )
