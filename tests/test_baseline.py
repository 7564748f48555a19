import pytest

from sentrylake.operators.baseline import (
    Baseline,
    baseline_anomaly_detector,
    baseline_profiles,
    baseline_totals,
    frozen_baseline_detector,
)
from sentrylake.plans import fixtures
from tests.conftest import make_event

TRAITS = (10, "10.20.0.7", "harbour", "auth_attempt", False)


def trained(n=100, failures=0):
    state = Baseline()
    for i in range(n):
        state.step((*TRAITS[:4], i < failures), 100, 0.5)
    return state


@pytest.mark.parametrize(
    "traits, score",
    [
        ((3, "198.51.100.9", "harbour", "auth_attempt", False), 0.5445),
        ((3, "198.51.100.9", "mountain", "auth_attempt", False), 0.7425),
        ((3, "198.51.100.9", "mountain", "auth_attempt", True), 0.8225),
        ((3, "198.51.100.9", "mountain", "process_execution", False), 0.891),
        ((3, "198.51.100.9", "mountain", "process_execution", True), 0.971),
    ],
)
def test_known_scores(traits, score):
    assert trained().step(traits, 100, 0.5)[-1] == pytest.approx(score)


def test_new_address_alone_is_learned():
    state = trained()
    assert state.score((10, "10.9.9.9", *TRAITS[2:]))[-1] == pytest.approx(0.297)
    assert state.step((10, "10.9.9.9", *TRAITS[2:]), 100, 0.5) is None
    assert state.total == 101 and state.counts[1]["10.9.9.9"] == 1


def test_nothing_is_reported_while_learning():
    state = trained(50)
    assert state.step((3, "1.1.1.1", "X", "dns_query", True), 100, 0.5) is None
    assert state.total == 51


def test_anomaly_does_not_poison_the_baseline():
    state = trained()
    assert state.step((3, "1.1.1.1", "X", "dns_query", False), 100, 0.5) is not None
    assert state.total == 100 and "1.1.1.1" not in state.counts[1]
    state.step(TRAITS, 100, 0.5)
    assert state.total == 101


def test_frequent_failures_are_not_rare():
    assert trained(failures=5).score((*TRAITS[:4], True))[4] == 0.8
    assert trained(failures=20).score((*TRAITS[:4], True))[4] == 0.0


def test_detector_reports_with_reasons(events_of):
    rows = [make_event(i) for i in range(100)]
    rows.append(make_event(100, hour=3, ip="198.51.100.9", geo="mountain", status="failed"))
    rows.append(make_event(101))
    for detect in (baseline_anomaly_detector, frozen_baseline_detector):
        (found,) = detect(events_of(rows)).collect()
        assert found.anomaly_score == pytest.approx(0.8225)
        assert found.reasons == [
            "HIGH: Significant deviation from normal behavior",
            "Unusual login time (03:00)",
            "New or unusual source IP: 198.51.100.9",
            "New or unusual location: mountain",
            "User typically has low failure rate",
        ]


def test_threshold_and_users_are_independent(events_of):
    rows = [make_event(i, user=u, hour=h) for u, h in (("alice", 9), ("bob", 14), ("carl", 18)) for i in range(30)]
    rows += [make_event(30, user="bob", hour=9, ip="10.0.0.1", geo="Oslo")]
    ev = events_of(rows)
    assert [r.user for r in baseline_anomaly_detector(ev, 30, 0.5).collect()] == ["bob"]
    assert baseline_anomaly_detector(ev, 30, 0.8).count() == 0
    hours = {(r.user, r.value) for r in baseline_profiles(ev).where("dimension = 'hour'").collect()}
    assert hours == {("alice", "9"), ("bob", "14"), ("bob", "9"), ("carl", "18")}
    assert {r.user: r.is_baseline_ready for r in baseline_totals(ev, 31).collect()} == {
        "alice": False, "bob": True, "carl": False,
    }


@pytest.mark.parametrize("min_events, threshold", [(20, 0.7), (5, 0.5)])
def test_parts_of_a_large_user_give_the_same_result(spark, sf, min_events, threshold):
    ev = fixtures.events(spark, sf)
    whole = baseline_anomaly_detector(ev, min_events, threshold)
    parts = baseline_anomaly_detector(ev, min_events, threshold, single_task_rows=60, part_rows=9)
    assert whole.count() == parts.count() > 0
    assert whole.exceptAll(parts).isEmpty()


def test_frozen_detector_splits_heavy_users(spark, sf):
    ev = fixtures.events(spark, sf)
    plain = frozen_baseline_detector(ev, 20, 0.6)
    split = frozen_baseline_detector(ev, 20, 0.6, shares=40, min_split_rows=10)
    assert plain.count() == split.count() > 0
    assert plain.exceptAll(split).isEmpty()


def test_learning_phase_is_cut_before_the_shuffle(spark, sf):
    plan = frozen_baseline_detector(fixtures.events(spark, sf), 20, 0.6)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_task_code_needs_no_package_on_the_executor(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from sentrylake.operators.baseline import _flagging

    code = "import pickle, sys; fold = pickle.load(sys.stdin.buffer); assert list(fold(iter([]))) == []"
    done = subprocess.run(
        [sys.executable, "-c", code], input=cloudpickle.dumps(_flagging(20, 0.7)), cwd=tmp_path, capture_output=True
    )
    assert done.returncode == 0, done.stderr
