"""Labelling users from their feature rows: Isolation Forest and K-Means.

The Isolation Forest follows Liu, Ting and Zhou, "Isolation Forest" (ICDM 2008). Growing a tree
needs only a small sample, which each tree draws from all rows; trees are grown in parallel, and the forest
itself is small and is sent to all tasks to score every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentrylake.functions.scalar import minmax_scaled
from sentrylake.operators.skew import exact_quantile
from sentrylake.session import materialize

# Defaults of the detectors.
TREES = 100
CONTAMINATION = 0.1
SEED = 42
TREE_ROWS = 256
CLUSTERS = 5
FAR_FROM_CENTER = 0.8

_NODES = "tree int, node int, feature int, threshold double, left int, right int, path double"


def minmax_normalise(df: DataFrame, column: str, to: str, stored: bool = False) -> DataFrame:
    """``column`` scaled to 0..1 over the whole table; 0 everywhere if all values are equal.

    The rows are written first, so that they are computed once for their ends and their values; ``stored`` rows are
    cheap to read as they are.
    """
    df = df if stored else materialize(df, "to-scale")
    ends = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high"))).scalar()
    return df.withColumn(to, minmax_scaled(column, ends["low"], ends["high"]))


def prepare_features(df: DataFrame, columns: list[str]) -> tuple[DataFrame, str]:
    """Rows without null or NaN, with their standardised feature vector (mean 0, deviation 1)."""
    assembled = VectorAssembler(inputCols=columns, outputCol="features_raw", handleInvalid="skip").transform(df)
    scaler = StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True)
    return scaler.fit(assembled).transform(assembled), "features"


def _usable(df: DataFrame, columns: list[str]) -> DataFrame:
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.where(complete)


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` rows, which stands in for the unsplit rest."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(tree: int, rows: np.ndarray, seed: int) -> pd.DataFrame:
    """One tree over at most ``TREE_ROWS`` rows, as a table of nodes."""
    rng = np.random.default_rng([seed, tree])
    depth_limit = math.ceil(math.log2(max(len(rows), 2)))
    nodes: list[list] = []
    open_nodes = [(np.arange(len(rows)), 0, None)]
    while open_nodes:
        members, depth, parent = open_nodes.pop()
        here = len(nodes)
        if parent is not None:
            nodes[parent[0]][parent[1]] = here
        values = rows[members]
        low, high = values.min(axis=0), values.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= depth_limit or len(members) <= 1 or not len(splittable):
            nodes.append([tree, here, -1, 0.0, here, here, depth + average_path(len(members))])
            continue
        feature = int(rng.choice(splittable))
        # Between neighbouring doubles the draw is rounded to one of them; the highest value always goes right.
        cut = min(rng.uniform(low[feature], high[feature]), np.nextafter(high[feature], low[feature]))
        goes_left = values[:, feature] <= cut
        nodes.append([tree, here, feature, cut, -1, -1, 0.0])
        open_nodes.append((members[~goes_left], depth + 1, (here, 5)))
        open_nodes.append((members[goes_left], depth + 1, (here, 4)))
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "path"])


def _drawn(rows: DataFrame, columns: list[str], key: str, n: int, trees: int, seed: int, wanted: int) -> DataFrame:
    """About ``wanted`` rows for each tree out of all rows: those whose hash with the tree's number is lowest.

    Each row names the trees that it falls to, so only hits are repeated, and no tree sees less than the whole.
    """
    vector = F.array(*[F.col(c).cast("double") for c in columns]).alias("vector")
    draw = lambda t: F.xxhash64(F.lit(seed), t, F.col(key))
    below = F.lit(min(2**63 - 1, -(2**63) + int(min(1.0, wanted / n) * 2.0**64)))
    hits = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) <= below)
    found = rows.select(key, vector, F.explode(hits).alias("tree"))
    return found.withColumn("draw", draw(F.col("tree")))


def grow_forest(rows: DataFrame, columns: list[str], key: str, n: int, trees: int, seed: int) -> DataFrame:
    """Node table of ``trees`` trees, each from its own sample of ``TREE_ROWS`` rows out of all (all rows if fewer)."""
    wanted = 2 * TREE_ROWS
    while True:
        drawn = materialize(_drawn(rows, columns, key, n, trees, seed, wanted), "draws")
        sizes = drawn.groupBy("tree").agg(F.count("*").alias("n")).agg(F.min("n"), F.count("*")).first()
        if wanted >= n or (sizes[1] == trees and sizes[0] >= TREE_ROWS):
            break
        wanted *= 2
    by_chance = Window.partitionBy("tree").orderBy("draw", key)
    drawn = drawn.withColumn("place", F.row_number().over(by_chance)).where(F.col("place") <= TREE_ROWS)

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("place")
        return _grow(int(sample["tree"].iat[0]), np.array(sample["vector"].tolist()), seed)

    return drawn.groupBy("tree").applyInPandas(grow, _NODES)


def _forest_arrays(nodes: pd.DataFrame) -> list[tuple[np.ndarray, ...]]:
    fields = ["feature", "threshold", "left", "right", "path"]
    return [
        tuple(tree.sort_values("node")[f].to_numpy() for f in fields) for _, tree in nodes.groupby("tree", sort=True)
    ]


def _mean_path(x: np.ndarray, forest: list[tuple[np.ndarray, ...]], depth: int) -> np.ndarray:
    """Mean path length of each row; a leaf leads to itself, so all rows walk the same steps."""
    total = np.zeros(len(x))
    every = np.arange(len(x))
    for feature, threshold, left, right, path in forest:
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(depth):
            goes_left = x[every, feature[at]] <= threshold[at]
            at = np.where(goes_left, left[at], right[at])
        total += path[at]
    return total / len(forest)


def isolation_forest(
    features: DataFrame,
    columns: list[str],
    key: str = "user",
    trees: int = TREES,
    contamination: float = CONTAMINATION,
    seed: int = SEED,
) -> DataFrame:
    """Feature rows with ``anomaly_score``, ``is_anomaly`` and ``anomaly_score_normalized``.

    The raw features are used. The share ``contamination`` with the highest scores is flagged.
    """
    spark = features.sparkSession
    # Sampling and scoring both read the feature rows; the events are read once.
    rows = materialize(_usable(features, columns), "feature-rows")
    n = rows.count()
    if n == 0:
        raise ValueError("no complete feature rows")
    sample_size = min(TREE_ROWS, n)
    # The forest is at most trees * (2 * TREE_ROWS - 1) nodes.
    nodes = grow_forest(rows, columns, key, n, trees, seed).toPandas()
    shared = spark.sparkContext.broadcast(_forest_arrays(nodes))
    depth = math.ceil(math.log2(max(sample_size, 2)))
    usual = max(average_path(sample_size), 1e-12)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            x = np.array(vectors.tolist()).reshape(len(vectors), len(columns))
            yield pd.Series(np.power(2.0, -_mean_path(x, shared.value, depth) / usual))

    vector = F.array(*[F.col(c).cast("double") for c in columns])
    scored = materialize(rows.withColumn("anomaly_score", score(vector)), "scored-rows")
    cut_off = exact_quantile(scored, "anomaly_score", 1.0 - contamination)
    flagged = scored.withColumn("is_anomaly", (F.col("anomaly_score") > cut_off).cast("int"))
    return minmax_normalise(flagged, "anomaly_score", "anomaly_score_normalized", stored=True)


def kmeans_anomaly(features: DataFrame, columns: list[str], k: int = CLUSTERS, seed: int = SEED) -> DataFrame:
    """Feature rows with their cluster, the scaled distance to its centre, and a flag for the far ones."""
    prepared, vector = prepare_features(materialize(features, "feature-rows"), columns)
    model = KMeans(k=k, seed=seed, featuresCol=vector).fit(prepared)
    centers = F.array(*[F.lit([float(x) for x in c]) for c in model.clusterCenters()])
    squares = F.zip_with(
        vector_to_array(vector), F.get(centers, F.col("prediction")), lambda x, c: (x - c) * (x - c)
    )
    distance = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s))
    placed = model.transform(prepared).withColumn("distance_to_center", distance).drop("features_raw", "features")
    scaled = minmax_normalise(placed, "distance_to_center", "anomaly_score_normalized")
    return scaled.withColumn("is_anomaly", (F.col("anomaly_score_normalized") > FAR_FROM_CENTER).cast("int"))


ALGORITHMS = {"isolation_forest": isolation_forest, "kmeans": kmeans_anomaly}


def detect_anomalies(features: DataFrame, columns: list[str], algorithm: str = "isolation_forest", **options) -> DataFrame:
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm: {algorithm}")
    return ALGORITHMS[algorithm](features, columns, **options)
