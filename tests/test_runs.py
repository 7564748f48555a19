"""Events that are decided in runs, against the rule taken step by step."""

import random

import pyarrow as pa
import pytest

from sentrylake.operators import baseline

KINDS = {
    "event_id": pa.string(), "user": pa.string(), "ts_ms": pa.int64(), "hour": pa.int32(), "source_ip": pa.string(),
    "geo_location": pa.string(), "event_type": pa.string(), "failed": pa.bool_(), "part": pa.int32(),
    "dimension": pa.string(), "value": pa.string(), "carried": pa.int64(),
}


def table(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), KINDS.values())], names=list(KINDS))


def made(rng, users, most, addresses):
    return [
        (
            f"e{u}.{i}", f"u{u}" if u else None, i, rng.choice([None, 9, 10, 11, 3]),
            f"ip{min(int(rng.expovariate(0.4)), addresses)}", rng.choice(["a", "a", "a", "b", None]), rng.choice("xxxyz"),
            rng.random() < 0.1, 0, None, None, None,
        )
        for u in range(users)
        for i in range(rng.randint(1, most))
    ]


def step_by_step(rows, min_events, threshold):
    found, states = [], {}
    for row in rows:
        scores = states.setdefault(row[1], baseline.Baseline()).step(row[3:8], min_events, threshold)
        if scores is not None:
            found.append((row[0], *scores))
    return found, states


def in_runs(batches, min_events, threshold):
    columns = ["event_id", *baseline.SCORES]
    return [tuple(r[c] for c in columns) for out in baseline._flagging(min_events, threshold)(batches) for r in out.to_pylist()]


@pytest.mark.parametrize("rounds", [2, 64])
@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_single_steps(monkeypatch, rounds, seed):
    # With two rounds most runs do not settle, and are halved.
    monkeypatch.setattr(baseline, "ROUNDS", rounds)
    rng = random.Random(seed)
    rows = made(rng, rng.randint(1, 8), rng.choice([3, 100, 600]), rng.choice([3, 40]))
    min_events, threshold, size = rng.choice([0, 1, 5, 20]), rng.choice([0.3, 0.5, 0.6, 0.7]), rng.choice([7, 100, 10_000])
    whole = table(rows)
    batches = (whole.slice(i, size) for i in range(0, len(rows), size))
    assert in_runs(batches, min_events, threshold) == step_by_step(rows, min_events, threshold)[0]


def test_runs_start_from_earlier_counts():
    rng = random.Random(7)
    rows = made(rng, 3, 400, 20)
    first, second = [r for r in rows if r[2] < 150], [r for r in rows if r[2] >= 150]
    _, states = step_by_step(first, 20, 0.6)
    seeds = [
        (None, user, None, None, None, None, None, None, 0, *key, n)
        for user, state in states.items()
        for key, n in state.entries().items()
    ]
    together = sorted(seeds + second, key=lambda r: (r[1] or "", r[2] or 0))
    want = [f for f in step_by_step(rows, 20, 0.6)[0] if int(f[0].split(".")[1]) >= 150]
    whole = table(together)
    assert in_runs((whole.slice(i, 11) for i in range(0, len(together), 11)), 20, 0.6) == want != []


def test_a_part_reports_what_it_accepted():
    rows = made(random.Random(3), 2, 300, 10)
    _, states = step_by_step(rows, 20, 0.6)
    whole = table(rows)
    got = {}
    for out in baseline._accepting(20, 0.6)(whole.slice(i, 50) for i in range(0, len(rows), 50)):
        for r in out.to_pylist():
            got[r["user"], r["dimension"], r["value"]] = r["accepted"]
    assert got == {(user, *key): n for user, state in states.items() for key, n in state.entries().items()}


def test_one_long_run_of_a_new_address():
    # Each rejected event leaves the address unseen for the next; all decisions hang together.
    calm = [(f"c{i}", "u", i, 9, "home", "a", "x", False, 0, None, None, None) for i in range(100)]
    rows = calm + [(f"n{i}", "u", 100 + i, 3, "away", "b", "y", True, 0, None, None, None) for i in range(500)]
    assert in_runs([table(rows)], 20, 0.6) == step_by_step(rows, 20, 0.6)[0]


def test_no_rows():
    assert in_runs([], 20, 0.6) == [] == in_runs([table([(None,) * len(KINDS)]).slice(1)], 20, 0.6)
