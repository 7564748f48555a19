import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrylake.operators import detectors
from sentrylake.operators.summary import anomaly_report, training_availability, training_stats
from sentrylake.plans import training
from sentrylake.plans.catalog import _stored_topic

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = [(f"u{i:03d}", *map(float, rng.normal(size=3)), 10, 0.1) for i in range(300)]
    rows += [("far1", 40.0, 40.0, 40.0, 10, 0.1), ("far2", -35.0, 50.0, 0.0, 10, None), ("hole", None, 0.0, 0.0, 1, 0.1)]
    return spark.createDataFrame(rows, "user string, a double, b double, c double, total_events bigint, avg_threat_score double")


def test_forest_flags_a_tenth_with_outliers_first(table):
    found = detectors.isolation_forest(table, COLUMNS)
    rows = found.orderBy(F.desc("anomaly_score")).collect()
    assert len(rows) == 302 and {rows[0].user, rows[1].user} == {"far1", "far2"}
    assert 28 <= sum(r.is_anomaly for r in rows) <= 31
    assert rows[0].anomaly_score_normalized == 1.0 and rows[-1].anomaly_score_normalized == 0.0
    assert all(0 < r.anomaly_score <= 1 for r in rows)


def test_forest_is_the_same_for_the_same_seed_and_layout(table):
    scores = lambda df, **kw: {r.user: r.anomaly_score for r in detectors.isolation_forest(df, COLUMNS, trees=20, **kw).collect()}
    first = scores(table)
    assert first == scores(table.repartition(7))
    assert first != scores(table, seed=1)


@pytest.mark.parametrize("n", [200, 3_000, 40_000])
def test_trees_draw_from_all_rows_at_any_size(spark, n):
    rows = spark.range(n).selectExpr("cast(id as string) AS user", "cast(id as double) AS a")
    drawn = detectors._drawn(rows, ["a"], "user", n, 50, 42, 2 * detectors.TREE_ROWS)
    sizes = [r["n"] for r in drawn.groupBy("tree").agg(F.count("*").alias("n")).collect()]
    expected = min(n, 2 * detectors.TREE_ROWS)
    assert len(sizes) == 50 and abs(sum(sizes) / 50 - expected) <= 0.05 * expected
    # Rows are as likely to be drawn at either end of the table.
    low = drawn.where(f"vector[0] < {n / 2}").count()
    assert abs(low / sum(sizes) - 0.5) < 0.05


def test_trees_split_neighbouring_doubles():
    rows = np.array([[0.1], [np.nextafter(0.1, 1)]])
    for tree in range(40):
        nodes = detectors._grow(tree, rows, 42)
        assert len(nodes) == 3 and (nodes["feature"] == 0).sum() == 1


def test_kmeans_distance_and_flag(table):
    rows = detectors.kmeans_anomaly(table, COLUMNS, k=2).orderBy(F.desc("anomaly_score_normalized")).collect()
    assert len(rows) == 302 and rows[0].anomaly_score_normalized == 1.0 and rows[0].is_anomaly == 1
    assert all((r.anomaly_score_normalized > 0.8) == bool(r.is_anomaly) for r in rows)


def test_equal_values_normalise_to_zero(table):
    flat = table.where("user <> 'hole'")
    assert {r.m for r in detectors.minmax_normalise(flat, "total_events", "m").collect()} == {0.0}


def test_unknown_algorithm(table):
    with pytest.raises(ValueError):
        detectors.detect_anomalies(table, COLUMNS, "dbscan")


def test_report_of_a_labelled_table(spark, table):
    labelled = table.where("a is not null").select(
        "*", (F.col("user").startswith("far")).cast("int").alias("is_anomaly"), F.col("b").alias("anomaly_score_normalized")
    )
    report = anomaly_report(labelled)
    (row,) = report.collect()
    assert (row.total_users, row.anomalous_users) == (302, 2)
    assert [t.user for t in row.top_anomalies] == ["far2", "far1"] and row.top_anomalies[0].avg_threat_score == 0.0
    assert training_stats(report).first().stats == "Training data: 302 users analyzed, 2 anomalies (0.7% rate)"
    assert training_availability(report).first().status == "healthy"
    assert training_availability(report.limit(0)).first().stats == "No training data available"
    (empty,) = anomaly_report(labelled.limit(0)).collect()
    assert (empty.total_users, empty.anomaly_rate) == (0, 0.0)


def test_training_run_stores_the_columns_that_it_uses(spark, sf, monkeypatch):
    class Stored(Exception):
        pass

    def stop(df, name):
        raise Stored(df.columns)

    monkeypatch.setattr(training, "materialize", stop)
    with pytest.raises(Stored) as stored:
        training.training_pipeline(spark, _stored_topic(spark, sf), "unused")
    assert set(stored.value.args[0]) == set(training.USED)
