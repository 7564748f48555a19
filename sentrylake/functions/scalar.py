"""Scalar functions as native column expressions; nothing here leaves the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentrylake.schema import EVENT_TYPES, STATUSES

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(payload: ColumnOrName, path: str) -> Column:
    """Text of one path of a JSON payload. To read many paths, parse once with a schema."""
    return F.get_json_object(payload, path)


def epoch_ms_to_ts(ms: ColumnOrName, truncate_to_second: bool = False) -> Column:
    """Milliseconds to timestamp, at full precision or cut to whole seconds."""
    ts = F.timestamp_millis(_col(ms).cast("bigint"))
    return F.date_trunc("second", ts) if truncate_to_second else ts


def hour_of_day(ts: ColumnOrName) -> Column:
    return F.hour(ts)


def is_weekend(ts: ColumnOrName) -> Column:
    """Saturday or Sunday (days 7 and 1)."""
    return F.dayofweek(ts).isin(1, 7)


def ratio(numerator: ColumnOrName, denominator: ColumnOrName, default: float | None = None) -> Column:
    """Division that gives null, or ``default``, where the denominator is zero."""
    value = F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))
    return value if default is None else F.coalesce(value, F.lit(default))


def _graded(score: ColumnOrName, steps: list[tuple[float, str]], lowest: str) -> Column:
    value = _col(score)
    (first_cut, first_name), *rest = steps
    chain = F.when(value >= first_cut, first_name)
    for cut, name in rest:
        chain = chain.when(value >= cut, name)
    return chain.otherwise(lowest)


def anomaly_severity(score: ColumnOrName) -> Column:
    return _graded(score, [(0.9, "critical"), (0.8, "high"), (0.7, "medium")], "low")


def threat_severity(score: ColumnOrName) -> Column:
    return _graded(score, [(0.9, "CRITICAL"), (0.8, "HIGH"), (0.7, "MEDIUM")], "LOW")


def threat_band(score: ColumnOrName) -> Column:
    return _graded(score, [(0.9, "critical"), (0.6, "high"), (0.3, "medium")], "low")


def clamp01(x: ColumnOrName) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), _col(x)))


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine_similarity(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Cosine of two arrays; 0 where sizes differ, an array is empty or a norm is zero."""
    a, b = _col(a), _col(b)
    value = F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))
    comparable = (F.size(a) == F.size(b)) & (F.size(a) > 0)
    return F.when(comparable, F.coalesce(value, F.lit(0.0))).otherwise(0.0)


def cosine_to(a: ColumnOrName, query: list[float]) -> Column:
    """Cosine of an array to one given vector, whose norm is taken once and not per row."""
    a = _col(a)
    norm = math.sqrt(math.fsum(float(x) * float(x) for x in query))
    if norm == 0.0:
        return F.lit(0.0)
    unit = F.lit([float(x) / norm for x in query])
    value = F.try_divide(_dot(a, unit), F.sqrt(_dot(a, a)))
    return F.when(F.size(a) == len(query), F.coalesce(value, F.lit(0.0))).otherwise(0.0)


# Probability of something no history says anything about, and of something new.
NEUTRAL_PROBABILITY = 0.5
UNSEEN_PROBABILITY = 0.01


def rarity(
    seen: ColumnOrName,
    total: ColumnOrName,
    known: Column | None = None,
    neutral: float = NEUTRAL_PROBABILITY,
    unseen: float = UNSEEN_PROBABILITY,
) -> Column:
    """Share of past events with this value: ``unseen`` for a new value, ``neutral`` without history.

    ``known`` marks rows that carry a value at all; the others are neutral too.
    """
    share = F.coalesce(F.nullif(_col(seen), F.lit(0)) / _col(total), F.lit(unseen))
    no_history = F.coalesce(_col(total), F.lit(0)) == 0
    if known is not None:
        no_history = no_history | ~known
    return F.when(no_history, F.lit(neutral)).otherwise(share)


def is_event_type(value: ColumnOrName) -> Column:
    return F.coalesce(_col(value).isin(*EVENT_TYPES), F.lit(False))


def is_status(value: ColumnOrName) -> Column:
    return F.coalesce(_col(value).isin(*STATUSES), F.lit(False))


def base_model_name(model: ColumnOrName) -> Column:
    """Model name without its date suffix (the part from ``-202`` on)."""
    return F.split_part(_col(model), F.lit("-202"), F.lit(1))


def minmax_scaled(x: ColumnOrName, low: ColumnOrName, high: ColumnOrName) -> Column:
    """Position of ``x`` between ``low`` and ``high``; 0 where both are equal."""
    low = _col(low)
    return F.coalesce(F.try_divide(_col(x) - low, _col(high) - low), F.lit(0.0))
