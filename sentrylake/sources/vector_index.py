"""Stored cell index over vectors: exact nearest vectors without reading all of them.

Vectors lie in folders by their nearest centre. By the triangle inequality of angles, no vector of a cell is nearer to a
query than the angle to the cell's centre less the cell's radius, so a cell beyond the reach of the best matches found so
far is never opened. Vectors that have no angle (null, of another size, zero, not finite) share a cell that is always read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentrylake.operators.similarity import similar_events
from sentrylake.session import materialize

# There are about as many cells as the root of the number of rows, at most this many: what is collected or broadcast.
MOST_CELLS = 4096
NO_ANGLE = -1
# With many queries, bins of about this many rows meet parts of about this many queries, some of which are compared at once.
BLOCK_ROWS = 4096
QUERY_ROWS = 4096
QUERY_CHUNK = 256
PAIR_CHUNK = 100_000
# Room for rounding in angles.
SLACK = 1e-6

_CELLS = "cell int, centre array<double>, radius double, rows bigint"


def _usable(vector: Column, size: int) -> Column:
    """Whether a vector has an angle to others of this size."""
    square = F.aggregate(vector, F.lit(0.0), lambda sum_, x: sum_ + x.cast("double") * x.cast("double"))
    return F.coalesce((F.size(vector) == size) & (square > 0) & (square < math.inf), F.lit(False))


def _units(vectors) -> np.ndarray:
    matrix = np.array([np.asarray(v, "float64") for v in vectors])
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _angles(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centres.T, -1.0, 1.0))


def index_vectors(vectors: DataFrame, path: str, key: str = "event_id", vector: str = "embedding", most_cells: int = MOST_CELLS) -> str:
    """Store the key and the vector of every row in cells around vectors drawn by a hash of the key.

    Null and repeated keys are rows like others. An empty table gives an index without cells. Any other columns are left out.
    """
    rows = materialize(vectors.select(F.col(key).alias(key), F.col(vector).alias(vector)), "vectors")
    count, size = rows.agg(F.count(F.lit(1)), F.mode(F.size(vector))).first()
    usable = _usable(F.col(vector), size or 0)
    wanted = min(most_cells, max(1, math.isqrt(count)))
    drawn = rows.where(usable).orderBy(F.xxhash64(key, vector), key).limit(wanted).select(vector).collect()
    spark = vectors.sparkSession
    centres = _units([r[0] for r in drawn]) if drawn else np.zeros((0, size or 0))
    shared = spark.sparkContext.broadcast(centres)

    @F.pandas_udf("struct<cell: int, angle: double>")
    def nearest(column: pd.Series) -> pd.DataFrame:
        angles = _angles(_units(column), shared.value)
        cell = angles.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "angle": angles[np.arange(len(cell)), cell]})

    other = rows.where(~usable).select(key, vector, F.lit(NO_ANGLE).alias("cell"), F.lit(None).cast("double").alias("angle"))
    placed = other
    if drawn:
        found = rows.where(usable).withColumn("at", nearest(vector))
        placed = found.select(key, vector, "at.cell", "at.angle").unionByName(other)
    # A cell that many vectors share fills several files.
    placed.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    found = stored.groupBy("cell").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("rows"))
    listed = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    cells = found.join(F.broadcast(listed), "cell", "left").select("cell", "centre", "radius", "rows")
    cells.coalesce(1).write.mode("overwrite").parquet(f"{path}.cells")
    types = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    spark.createDataFrame([(key, vector, types[key], types[vector], size or 0)], "key string, vector string, key_type string, vector_type string, size int").coalesce(
        1
    ).write.mode("overwrite").parquet(f"{path}.layout")
    return path


class _Index:
    """The stored table and its short list of cells."""

    def __init__(self, spark: SparkSession, path: str):
        self.key, self.vector, key_type, vector_type, self.size = spark.read.parquet(f"{path}.layout").first()
        schema = f"`{self.key}` {key_type}, `{self.vector}` {vector_type}, angle double, cell int"
        self.rows = spark.read.schema(schema).parquet(path)
        self.sizes = spark.read.schema(_CELLS).parquet(f"{path}.cells")
        cells = self.sizes.orderBy("cell").collect()  # at most MOST_CELLS and one
        self.all = [c["cell"] for c in cells]
        self.always = [c for c in self.all if c == NO_ANGLE]
        cells = [c for c in cells if c["cell"] != NO_ANGLE]
        self.plain = (
            np.array([c["cell"] for c in cells], "int64"),
            np.array([c["centre"] for c in cells], "float64").reshape(len(cells), self.size),
            np.array([c["radius"] for c in cells], "float64"),
            np.array([c["rows"] for c in cells], "int64"),
        )


def _first_cells(unit: np.ndarray, k: int, plain: tuple) -> list[int]:
    """The nearest cells that have ``k`` rows together."""
    cells, centres, _, rows = plain
    if not len(cells):
        return []
    order = _angles(unit[None, :], centres)[0].argsort(kind="stable")
    return cells[order[: int(np.searchsorted(np.cumsum(rows[order]), k)) + 1]].tolist()


def _cells_within(unit: np.ndarray, reach: float, plain: tuple) -> list[int]:
    cells, centres, radii, _ = plain
    if not len(cells):
        return []
    return cells[_angles(unit[None, :], centres)[0] - radii <= reach + SLACK].tolist()


def _is_usable(query, size: int) -> bool:
    if query is None or len(query) != size or any(x is None for x in query):
        return False
    square = float(np.square(np.asarray(query, "float64")).sum())
    return 0 < square < math.inf


def similar_indexed(spark: SparkSession, path: str, query: list[float], k: int = 10) -> DataFrame:
    """As ``similar_events`` over the stored vectors, from the cells that can hold a match; exact, ties by key.

    The nearest cells give ``k`` rows first; the last of these says how far a better one can lie. A query without
    an angle (zero, of another size) reads all cells.
    """
    index = _Index(spark, path)
    near = index.all
    if k > 0 and _is_usable(query, index.size):
        unit = _units([query])[0]
        first = index.rows.where(F.col("cell").isin(_first_cells(unit, k, index.plain)))
        found, worst = similar_events(first, query, k, index.key, index.vector).agg(F.count(F.lit(1)), F.min("similarity")).first()
        reach = math.acos(max(-1.0, min(1.0, worst))) if found == k else math.pi
        near = _cells_within(unit, reach, index.plain) + index.always
    return similar_events(index.rows.where(F.col("cell").isin(near)), query, k, index.key, index.vector)


def _bins(plain: tuple, always: list[int], sizes: dict[int, int]) -> tuple[dict[int, tuple[int, int]], int]:
    """First bin and number of bins of each cell, and the number of all bins, which have about ``BLOCK_ROWS`` rows.

    Small cells that lie near each other share a bin; a cell that fills several is dealt over them.
    """
    cells, centres = plain[0], plain[1]
    order = cells
    if len(cells):
        order = cells[_angles(centres, centres[: math.isqrt(len(cells))]).argmin(axis=1).argsort(kind="stable")]
    found, bins, filled = {}, 0, 0
    for cell in [*order.tolist(), *always]:
        rows = sizes[cell]
        if rows > BLOCK_ROWS or cell in always:
            # Bins after this cell's own start empty.
            bins += filled > 0
            blocks, filled = max(1, -(-rows // BLOCK_ROWS)), 0
            found[cell] = (bins, blocks)
            bins += blocks
            continue
        if filled and filled + rows > BLOCK_ROWS:
            bins, filled = bins + 1, 0
        found[cell] = (bins, 1)
        filled += rows
    return found, bins + (filled > 0)


def _matrix(vectors: pa.ChunkedArray, size: int) -> np.ndarray:
    return vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, size)


def _sum_of_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums along the first axis in order, as the row-wise cosine adds them."""
    total = np.zeros(np.broadcast_shapes(a.shape[1:], b.shape[1:]))
    for x, y in zip(a, b):
        total += x * y
    return total


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``cosine_similarity`` of vectors that lie along the first axis."""
    with np.errstate(all="ignore"):
        norms = np.sqrt(_sum_of_products(a, a)) * np.sqrt(_sum_of_products(b, b))
        return np.where(norms == 0.0, 0.0, _sum_of_products(a, b) / norms)


def _nearest_in(asked: pa.Table, stored: pa.Table, k: int, size: int) -> pa.Table:
    """The ``k`` best of ``stored`` for each query, by similarity and key.

    Matrix products find which can be among them; their similarities are then taken pair by pair, so that equal vectors
    have equal ones.
    """
    key = stored["_key"].combine_chunks()
    by_key = pc.rank(key, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
    kinds = [table["_size"].to_numpy() for table in (asked, stored)]
    plain = [table["_plain"].to_numpy() for table in (asked, stored)]
    floor = asked["_worst"].to_numpy()
    m, k = stored.num_rows, min(k, stored.num_rows)
    rows = np.flatnonzero(plain[1])
    vectors = _matrix(stored["_vector"].filter(pa.array(plain[1])), size).T.copy() if len(rows) else np.zeros((size, 0))
    units = vectors / np.sqrt(np.square(vectors).sum(axis=0))
    place = np.full(m, -1)
    place[rows] = np.arange(len(rows))
    # Vectors without an angle by their size; those with a null in them have none.
    odd = {int(n): np.flatnonzero((kinds[1] == n) & ~plain[1]) for n in np.unique(kinds[1][~plain[1]]) if n > 0}
    odd = {n: (at, _matrix(stored["_vector"].take(pa.array(at)), n).T) for n, at in odd.items()}
    found = []
    for start in range(0, asked.num_rows, QUERY_CHUNK):
        part = slice(start, min(asked.num_rows, start + QUERY_CHUNK))
        query, kind, is_plain = asked["_query"].slice(start, QUERY_CHUNK), kinds[0][part], plain[0][part]
        scores = np.zeros((len(kind), m))
        here = np.flatnonzero(is_plain)
        own = _matrix(query.filter(pa.array(is_plain)), size) if len(here) else np.zeros((0, size))
        if len(here) and len(rows):
            scores[np.ix_(here, rows)] = (own / np.sqrt(np.square(own).sum(axis=1, keepdims=True))) @ units
        for n in np.unique(kind[kind > 0]):
            mine = np.flatnonzero(kind == n)
            those = _matrix(query.take(pa.array(mine)), n).T[:, :, None]
            if n in odd:
                scores[np.ix_(mine, odd[n][0])] = _cosines(those, odd[n][1][:, None, :])
            others = ~is_plain[mine]
            if n == size and len(rows) and others.any():
                scores[np.ix_(mine[others], rows)] = _cosines(those[:, others], vectors[:, None, :])
        scores[np.isnan(scores)] = np.inf  # comes first, as in the order of the table
        least = np.maximum(np.partition(scores, m - k, axis=1)[:, m - k], floor[part])
        at, row = np.nonzero(scores >= least[:, None] - SLACK)
        similarity = scores[at, row]
        exact = np.flatnonzero(is_plain[at] & plain[1][row])
        order = np.cumsum(is_plain) - 1
        for pairs in np.array_split(exact, -(-len(exact) // PAIR_CHUNK) or 1):
            similarity[pairs] = _cosines(own.T[:, order[at[pairs]]], vectors[:, place[row[pairs]]])
        ranked = np.lexsort((by_key[row], -similarity, at))
        at, row, similarity = at[ranked], row[ranked], similarity[ranked]
        first = np.searchsorted(at, np.arange(len(kind)))
        kept = np.arange(len(at)) - first[at] < k
        found.append((at[kept] + start, row[kept], np.where(np.isinf(similarity[kept]), np.nan, similarity[kept])))
    at, row, similarity = (np.concatenate(column) for column in zip(*found))
    return pa.table({"_query_id": asked["_query_id"].take(pa.array(at)), "_key": key.take(pa.array(row)), "similarity": similarity})


def similar_many(
    spark: SparkSession, path: str, queries: DataFrame, k: int = 10, query_key: str = "query_id", query_vector: str = "query"
) -> DataFrame:
    """The ``k`` stored vectors most similar to each query (``query_key``, similarity and the stored key); exact, ties by key.

    Query keys are taken as unique. Cells are put together or divided into bins of equal size, queries into parts; a part
    meets the bins that hold its queries' cells, by products of matrices, so neither side is broadcast and a task has
    a bin and a part at a time. Queries without an angle meet all bins.
    """
    index = _Index(spark, path)
    asked = queries.select(F.col(query_key).alias("_query_id"), F.col(query_vector).alias("_query"))
    asked = materialize(asked.withColumn("_worst", F.lit(-math.inf)), "asked")
    plain, always, size = index.plain, index.always, index.size or 0
    rows = {r["cell"]: r["rows"] for r in index.sizes.select("cell", "rows").collect()}  # at most MOST_CELLS and one
    bin_of, n_bins = _bins(plain, always, rows)
    parts = max(1, -(-asked.count() // QUERY_ROWS))
    spread = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = max(1, min(n_bins * parts, spread))
    shared = spark.sparkContext.broadcast((plain, bin_of))

    def opened(cells: list[int]) -> list[int]:
        of = shared.value[1]
        return sorted({b for c in cells for b in range(of[c][0], of[c][0] + of[c][1])})

    @F.pandas_udf("array<int>")
    def first_bins(query: pd.Series) -> pd.Series:
        plain = shared.value[0]
        return pd.Series([opened(_first_cells(_units([q])[0], k, plain)) if _is_usable(q, size) else [] for q in query], dtype="object")

    @F.pandas_udf("array<int>")
    def bins_within(query: pd.Series, reach: pd.Series) -> pd.Series:
        plain = shared.value[0]
        return pd.Series(
            [opened([*_cells_within(_units([q])[0], r, plain), *always]) if _is_usable(q, size) else list(range(n_bins)) for q, r in zip(query, reach)],
            dtype="object",
        )

    def described(table: DataFrame, vector: str) -> DataFrame:
        """With the size of the vector (-1 with a null in it) and whether it has an angle to those of the index."""
        whole = F.coalesce(~F.exists(vector, lambda x: x.isNull()), F.lit(False))
        return table.withColumns({"_size": F.when(whole, F.size(vector)).otherwise(-1), "_plain": whole & _usable(F.col(vector), size)})

    listed = spark.createDataFrame([(c, *b) for c, b in bin_of.items()], "cell int, first int, blocks int")
    stored = index.rows.join(F.broadcast(listed), "cell")
    stored = stored.withColumn("bin", F.col("first") + F.pmod(F.xxhash64(index.key, index.vector), F.col("blocks")).cast("int"))
    stored = described(stored.select("bin", F.col(index.key).alias("_key"), F.col(index.vector).alias("_vector")), "_vector")
    stored = stored.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    meet = ["bin", "part"]
    types = {f.name: f.dataType.simpleString() for f in [*asked.schema.fields, *stored.schema.fields]}
    pairs = f"_query_id {types['_query_id']}, _key {types['_key']}, similarity double"

    def nearest(one: pa.Table, other: pa.Table) -> pa.Table:
        if not one.num_rows or not other.num_rows:
            return pa.table({"_query_id": one["_query_id"].slice(0, 0), "_key": other["_key"].slice(0, 0), "similarity": np.zeros(0)})
        return _nearest_in(one, other, k, size)

    def best(asked: DataFrame, bins: Column) -> DataFrame:
        one = described(asked.withColumn("bin", F.explode(bins)), "_query")
        one = one.withColumn("part", F.pmod(F.xxhash64("_query_id"), F.lit(parts)).cast("int"))
        # The work goes with the product of both sides, which their bytes do not show; a given number is not merged.
        one, other = (side.repartition(tasks, *meet).groupBy(*meet) for side in (one, stored))
        order = Window.partitionBy("_query_id").orderBy(F.desc("similarity"), F.asc("_key"))
        scored = one.cogroup(other).applyInArrow(nearest, pairs)
        return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    if k < 1 or not n_bins:
        return asked.limit(0).join(stored.limit(0), F.lit(True)).select(
            F.col("_query_id").alias(query_key), F.col("_key").alias(index.key), F.lit(0.0).alias("similarity")
        )
    worst = best(asked, first_bins("_query")).groupBy("_query_id").agg(F.count(F.lit(1)).alias("found"), F.min("similarity").alias("worst"))
    full = F.col("found") == k
    reach = F.when(full, F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "worst")))).otherwise(math.pi)
    bounded = asked.alias("q").join(worst.alias("w"), F.col("q._query_id").eqNullSafe(F.col("w._query_id")), "left")
    least = F.coalesce(F.when(full, F.col("worst")), F.lit(-math.inf)).alias("_worst")
    bounded = materialize(bounded.select("q._query_id", "_query", least, F.coalesce(reach, F.lit(math.pi)).alias("reach")), "reach")
    return best(bounded, bins_within("_query", "reach")).select(
        F.col("_query_id").alias(query_key), F.col("_key").alias(index.key), "similarity"
    )
