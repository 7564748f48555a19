import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrylake.functions.scalar import cosine_similarity
from sentrylake.operators.similarity import similar_events
from sentrylake.session import scratch_path
from sentrylake.sources import vector_index


def made(spark, n=900, groups=12, seed=1):
    """Vectors in narrow groups, repeated ones, and some that have no angle."""
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(groups, 16))
    rows = [(i, (middles[i % groups] + 0.1 * rng.normal(size=16)).tolist()) for i in range(n)]
    rows += [(n + i, rows[i][1]) for i in range(5)]
    rows += [(n + 10, [0.0] * 16), (n + 11, None), (n + 12, [1.0] * 3), (n + 13, [None] + [1.0] * 15), (None, rows[3][1])]
    return spark.createDataFrame(rows, "event_id bigint, embedding array<double>").withColumn("cell", F.lit("other"))


@pytest.fixture(scope="module")
def stored(spark):
    rows = made(spark).cache()
    return rows, vector_index.index_vectors(rows, scratch_path(spark, "cells"))


def listed(rows):
    return [(r[0], round(r[1], 9)) for r in rows.collect()]


@pytest.mark.parametrize("k", [1, 5, 40, 2000])
def test_nearest_are_exact(spark, stored, k):
    rows, path = stored
    for i in (0, 7, 901):
        query = rows.where(F.col("event_id") == i).first()["embedding"]
        assert listed(vector_index.similar_indexed(spark, path, query, k)) == listed(similar_events(rows, query, k))


def test_query_without_an_angle_reads_all(spark, stored):
    rows, path = stored
    for query in ([0.0] * 16, [1.0, 2.0]):
        assert listed(vector_index.similar_indexed(spark, path, query, 3)) == listed(similar_events(rows, query, 3))


def test_far_cells_are_not_read(spark, stored):
    rows, path = stored
    query = rows.where("event_id = 0").first()["embedding"]
    found = vector_index.similar_indexed(spark, path, query, 5)
    cells = spark.read.parquet(path).select("cell").distinct().count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    chosen = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "cell" in chosen and 0 < chosen.count(",") < cells / 2


def test_many_queries_are_exact(spark, stored, monkeypatch):
    monkeypatch.setattr(vector_index, "BLOCK_ROWS", 10)
    rows, path = stored
    queries = rows.where("event_id % 50 = 0 or event_id > 908").select(F.col("event_id").alias("query_id"), F.col("embedding").alias("query"))
    got = vector_index.similar_many(spark, path, queries, 6)
    want = {}
    pairs = queries.crossJoin(rows).select("query_id", "event_id", cosine_similarity("embedding", "query").alias("s")).collect()
    for q, key, s in pairs:
        want.setdefault(q, []).append((-round(s, 9), key is not None, key or 0))
    found = {}
    for q, key, s in got.collect():
        found.setdefault(q, []).append((-round(s, 9), key is not None, key or 0))
    assert {q: sorted(v) for q, v in found.items()} == {q: sorted(v)[:6] for q, v in want.items()} and len(found) > 18


def test_empty_table(spark):
    rows = made(spark).where("event_id < 0")
    path = vector_index.index_vectors(rows, scratch_path(spark, "cells"))
    assert vector_index.similar_indexed(spark, path, [1.0] * 16, 3).count() == 0
    queries = made(spark).limit(2).select(F.col("event_id").alias("query_id"), F.col("embedding").alias("query"))
    assert vector_index.similar_many(spark, path, queries, 3).count() == 0


def test_many_queries_meet_in_bounded_parts(spark, stored, monkeypatch):
    """Bins and parts are bounded and dealt over tasks, and equal vectors come in the order of their keys."""
    monkeypatch.setattr(vector_index, "BLOCK_ROWS", 64)
    monkeypatch.setattr(vector_index, "QUERY_ROWS", 8)
    bins, n = vector_index._bins((np.array([0, 1, 2, 3]), np.eye(4), None, None), [-1], {0: 30, 1: 200, 2: 30, 3: 30, -1: 70})
    assert bins[1][1] == 4 and bins[-1][1] == 2 and n == 8 and len({bins[c] for c in (0, 2, 3)}) == 2
    rows, path = stored
    queries = rows.where("event_id < 40").select(F.col("event_id").alias("query_id"), F.col("embedding").alias("query"))
    got = vector_index.similar_many(spark, path, queries, 2)
    found = sorted((r["query_id"], -r["similarity"], r["event_id"] is not None, r["event_id"] or 0) for r in got.collect())
    assert len(found) == 80 and [f[2:] for f in found if f[0] == 2] == [(True, 2), (True, 902)] and [f[2:] for f in found if f[0] == 3] == [(False, 0), (True, 3)]
    assert "CoGroup" in got._jdf.queryExecution().toString()
