import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentrylake.functions import scalar, text
from sentrylake.operators import lookups, metrics, similarity


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_recommendations(spark):
    answers = [
        ("**Summary**: bad\n**Recommendations**:\n1. Block the address now\n- short\n* Rotate all passwords\n**End** - not this one here",),
        ("No section, but\n 2.  Review the sign-in log \n- Isolate the workstation",),
        ("nothing to do",),
        ("**recommendations**:\n" + "\n".join(f"- recommendation number {i}" for i in range(9)),),
    ]
    found = values(spark, answers, "a string", text.extract_recommendations("a"))
    assert found[0] == ["Block the address now", "Rotate all passwords"]
    assert found[1] == ["Review the sign-in log", "Isolate the workstation"]
    assert found[2] == [] and found[3] == [f"recommendation number {i}" for i in range(5)]


def test_json_block(spark):
    rows = [('say {"a": {"b": 1}} ok',), ("none",), ("{open",)]
    assert values(spark, rows, "a string", text.extract_json_block("a")) == ['{"a": {"b": 1}}', "none", "{open"]


def test_analysis_response(spark):
    wrap = lambda content: json.dumps({"choices": [{"message": {"content": content}}]})
    rows = [
        (wrap('```{"attack_type": "Brute Force", "confidence": 0.9, "recommendations": ["a", 1, null, "b"]}```'), 0.95),
        (wrap("{}"), 0.1), (wrap("no json"), 0.1), (json.dumps({"choices": []}), 0.1), (wrap('{"description": 3}'), 0.1), ("", 0.1),
    ]
    found = values(spark, rows, "response string, threat_score double", text.parse_analysis_response())
    assert found[0].asDict() == {
        "severity": "CRITICAL", "attack_type": "Brute Force", "description": "No description provided",
        "recommendations": ["a", "b"], "confidence": 0.9,
    }
    assert found[1].attack_type == "Unknown" and found[1].confidence == 0.5 and found[1].severity == "LOW"
    assert found[2:] == [None] * 4


def test_short_numbers_match_c(spark):
    numbers = [0.0, 1.0, 0.85, 0.5, 0.05, 0.00005, 0.0123456789, 123.456789, 99999.95, 0.1 + 0.2]
    found = values(spark, [(x,) for x in numbers], "x double", text.short_number("x"))
    assert found == [f"{x:g}" for x in numbers]


def test_confidence(spark):
    rows = [(0, None, False, False), (5, 0.5, True, False), (50, 1.0, True, True)]
    found = values(spark, rows, "e int, r double, a boolean, b boolean", text.answer_confidence("e", "r", "a", "b"))
    assert found == pytest.approx([0.5, 0.75, 0.99])


def test_event_listing(spark):
    line = "array<struct<ts_ms: bigint, event_type: string, user: string, source_ip: string, severity: string, threat_score: double>>"
    rows = [([(5, None, "u", "1.1.1.1", None, 0.735)], 12), (None, 0)]
    found = values(spark, rows, f"top {line}, n bigint", text.format_events("top", "n"))
    assert found[0] == "1. [5] unknown - User: u, IP: 1.1.1.1, Severity: MEDIUM, Threat Score: 0.73\n\n... and 2 more events"
    assert found[1] == "No events found in the specified time window."


def test_intel_listing(spark):
    match = "array<struct<source: string, summary: string, relevance_score: double>>"
    found = values(spark, [([("feed", "x", 0.5)] * 7,), ([],)], f"m {match}", text.format_intel("m"))
    assert found[0].startswith("1. [feed] (Relevance: 0.50)\n   x\n2. ") and found[0].count("feed") == 5
    assert found[1] == "No matching threat intelligence found in knowledge base."


def test_cosine_edge_cases(spark):
    rows = [([1.0, 2.0], [2.0, 4.0]), ([1.0], [1.0, 2.0]), ([], []), ([0.0, 0.0], [1.0, 1.0])]
    found = values(spark, rows, "a array<double>, b array<double>", scalar.cosine_similarity("a", "b"))
    assert found == pytest.approx([1.0, 0.0, 0.0, 0.0])


def test_prices_match_exactly_before_by_prefix(spark):
    rows = [(m, 1_000_000, 0) for m in ("gpt-4o", "gpt-4o-mini-2024-07-18", "gpt-4o-2024-05-13", "gpt-4-turbo-x", "other")]
    usage = spark.createDataFrame(rows, "model string, prompt_tokens bigint, completion_tokens bigint")
    found = {r.model: (r.base_model, r.cost) for r in metrics.llm_usage_cost(usage).collect()}
    assert found["gpt-4o"] == ("gpt-4o", pytest.approx(2.5)) and found["gpt-4o-mini-2024-07-18"] == ("gpt-4o-mini", pytest.approx(0.15))
    assert found["gpt-4o-2024-05-13"] == ("gpt-4o", pytest.approx(2.5)) and found["gpt-4-turbo-x"][1] == pytest.approx(10.0)
    assert found["other"] == ("other", None)


def test_histogram_quantile_beyond_the_last_bucket(spark):
    log = spark.createDataFrame([(20.0,)] * 9 + [(0.0005,)], "seconds double")
    row = metrics.histogram_quantile(log, "seconds", quantiles=(0.05, 0.95)).first()
    assert row.p95 == 10.0 and row.p5 == pytest.approx(0.0005)
    assert metrics.histogram_quantile(log.limit(0), "seconds").first().p50 is None


def test_nearest_vectors_against_brute_force(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = vectors.collect()
    x = np.array([r.embedding for r in rows], dtype=float)
    cosine = x @ x[0] / np.linalg.norm(x, axis=1) / np.linalg.norm(x[0])
    best = sorted(zip(-cosine, [r.vec_id for r in rows]))[:10]
    found = similarity.similar_events(vectors, rows[0].embedding, 10, key="vec_id").collect()
    assert [r.vec_id for r in found] == [v for _, v in best]
    assert [r.similarity for r in found] == pytest.approx([-s for s, _ in best])


def test_intel_matches(spark):
    rows = [
        ("T1", "Credential dumping using mimikatz to extract passwords", None, None, None),
        ("T2", "Brute force authentication attempts with many failed login events", "access", "high", "T1110"),
        ("T3", "Data exfiltration over an encrypted channel", "exfil", "high", ""),
    ]
    intel = spark.createDataFrame(rows, "id string, description string, category string, severity string, mitre_attack string")
    found = similarity.match_threat_intel(intel, "failed login attempts, login", top_k=50).collect()
    assert [r.threat_id for r in found][0] == "T2" and len(found) == 3 and found[1].similarity == 0.0
    assert similarity.intel_records(similarity.match_threat_intel(intel, "mimikatz", 1)).first().source == "unknown"


def test_time_windows():
    assert [lookups.window_hours(w) for w in ("24h", "7d", "2w")] == [24, 168, 336]
    with pytest.raises(ValueError):
        lookups.window_hours("1m")


def test_severity_cut_points(spark):
    scores = [(0.69,), (0.7,), (0.8,), (0.9,)]
    assert values(spark, scores, "s double", scalar.anomaly_severity("s")) == ["low", "medium", "high", "critical"]
    assert values(spark, scores, "s double", scalar.threat_severity("s")) == ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
    bands = values(spark, [(0.0,), (0.3,), (0.6,), (0.9,)], "s double", scalar.threat_band("s"))
    assert bands == ["low", "medium", "high", "critical"]
    assert values(spark, [(1, 0)], "a int, b int", scalar.ratio("a", "b")) == [None]
    assert values(spark, [(None, 0)], "s bigint, n bigint", scalar.rarity("s", "n")) == [0.5]
    assert values(spark, [(None, 5)], "s bigint, n bigint", scalar.rarity("s", F.col("n"))) == [0.01]
