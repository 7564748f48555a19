"""Joins and statistics that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sentrylake.session import materialize

# A key is split once it holds more than 1/SHARES of the rows, into parts of about that size.
# At most SHARES keys can be that large and they get at most 2 * SHARES parts in all, so the
# broadcast list of large keys is bounded whatever the data.
SHARES = 1000
# Keys below this many rows fit one task and are never split.
MIN_SPLIT_ROWS = 100_000


def attach_by_key(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    weight: str,
    spread: str,
    how: str = "inner",
    sizes: DataFrame | None = None,
    shares: int = SHARES,
    min_split_rows: int = MIN_SPLIT_ROWS,
) -> DataFrame:
    """Join ``rows`` with ``table``, which has one row per key, splitting the heavy keys.

    ``weight`` is the table's count of rows per key; where the table costs more to compute than the
    counts, ``sizes`` gives them by themselves. A heavy key's rows are spread by a hash of
    ``spread`` over as many parts as its share asks for, and its table row is repeated once per
    part. Nulls match nulls. All rows meet their table row; nothing is sampled or dropped.
    """
    # The keys that may be heavy are stored, and all rows counted, in one pass: both sides must see the same part numbers
    # even if the input moves meanwhile. At most one key per ``min_split_rows`` rows is stored.
    seen = Observation()
    sizes = (table if sizes is None else sizes).select(*keys, weight).observe(seen, F.sum(weight).alias("total"))
    sizes = materialize(sizes.where(F.col(weight) > min_split_rows), "sizes")
    share = F.col(weight) * shares / F.lit(seen.get["total"] or 1)
    part_count = F.when(share > 1, F.ceil(share).cast("int")).otherwise(1)
    values = [c for c in table.columns if c not in keys]
    names = {k: f"_key{i}" for i, k in enumerate(keys)}

    def matches(other: DataFrame, *extra: Column) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(other[n]) for k, n in names.items()] + list(extra))

    heavy = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}_heavy")) for n in names.values()])
    renamed = [F.col(k).alias(n) for k, n in names.items()]
    parts = sizes.select(*renamed, part_count.alias("_parts")).where("_parts > 1")
    salted_rows = rows.join(F.broadcast(parts), matches(parts), "left").select(
        *rows.columns,
        F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(spread), F.col("_parts")))
        .otherwise(0)
        .cast("int")
        .alias("_part"),
    )
    numbered = table.select(*renamed, *values)
    split = numbered.join(F.broadcast(parts.select(*[F.col(n).alias(f"{n}_heavy") for n in names.values()], "_parts")), heavy, "left")
    numbers = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)).alias("_table_part")
    salted_table = split.select(*names.values(), *values, numbers)
    joined = salted_rows.join(
        salted_table, matches(salted_table, F.col("_part") == F.col("_table_part")), how
    )
    return joined.select(*rows.columns, *values)


def sample_std(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from a count, a sum and a sum of squares held as whole decimals.

    The numerator is exact while it fits 38 digits, so nothing cancels; beyond that it is a double.
    """
    n38 = n.cast("decimal(20,0)")
    exact = F.try_subtract(F.try_multiply(n38, squares), F.try_multiply(total, total)).cast("double")
    rough = n.cast("double") * squares.cast("double") - total.cast("double") * total.cast("double")
    spread = F.greatest(F.coalesce(exact, rough), F.lit(0.0))
    return F.when(n > 1, F.sqrt(spread / (n.cast("double") * (n.cast("double") - 1.0))))


# Distinct values up to this many are summarised in one step.
SMALL_COUNT = 1_000_000
BUCKETS = 10_000


def exact_quantile(df: DataFrame, column: str, q: float, small: int = SMALL_COUNT, buckets: int = BUCKETS) -> float:
    """The ``q`` quantile with linear interpolation between neighbours, without sorting in one task.

    Large inputs are narrowed by bucket counts until the wanted ranks lie in a range that is small
    or holds one value; the driver only ever sees ``buckets`` counts.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where("x is not null")
    n, low, high = values.agg(F.count("x"), F.min("x"), F.max("x")).first()
    if n == 0:
        raise ValueError(f"no values in {column}")
    rank = q * (n - 1)
    return _by_rank(values, n, low, high, int(rank), rank - int(rank), small, buckets)


def _by_rank(values, n, low, high, k, fraction, small, buckets) -> float:
    """Value at zero-based rank ``k``, moved ``fraction`` of the way to the next one."""
    if low == high:
        return low
    if n <= small:
        return values.agg(F.percentile("x", F.lit((k + fraction) / (n - 1)))).first()[0]
    width = (high - low) / buckets
    bucket = F.least(F.floor((F.col("x") - low) / width), F.lit(buckets - 1)).alias("b")
    counts = sorted(values.groupBy(bucket).agg(F.count("x"), F.min("x"), F.max("x")).collect())
    before = 0
    for i, (b, count, b_low, b_high) in enumerate(counts):
        if before + count > k:
            inside = values.where(bucket == b)
            if k + 1 < before + count:
                return _by_rank(inside, count, b_low, b_high, k - before, fraction, small, buckets)
            upper = counts[i + 1][2] if i + 1 < len(counts) else b_high
            return b_high + fraction * (upper - b_high)
        before += count
    return high
