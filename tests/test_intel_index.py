"""The stored index of threat intelligence against the scan of all texts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sentrylake.operators.similarity import match_threat_intel
from sentrylake.session import scratch_path
from sentrylake.sources import intel_index
from sentrylake.sources.intel_index import index_intel, match_indexed_intel, term_postings
from sentrylake.sources.readers import load_threat_intel

SCHEMA = "id string, description string, category string, severity string, mitre_attack string"
WORDS = ["login", "failed", "malware", "beacon", "dns", "tunnel", "root", "shell", "Report", "system", "the", "of"]


def entries(spark, ids, seed):
    draw = random.Random(seed)
    texts = {i: draw.choice([None, ""]) if i % 29 == 0 else " ".join(draw.choice(WORDS) for _ in range(draw.randint(1, 40))) for i in ids}
    return load_threat_intel(spark.createDataFrame([(str(i), t, None, draw.choice([None, "high"]), None) for i, t in texts.items()], SCHEMA))


@pytest.mark.parametrize("most", [2, 8])
def test_equals_the_scan_after_merges(spark, monkeypatch, most):
    monkeypatch.setattr(intel_index, "MAX_SEGMENTS", most)
    path, seen = scratch_path(spark, "intel"), {}
    for seed, ids in enumerate((range(0, 60), range(40, 90), range(0, 10), range(5, 100))):
        rows = entries(spark, ids, seed)
        index_intel(rows, path)
        seen |= {r["id"]: r for r in rows.collect()}
    everything = spark.createDataFrame(list(seen.values()), SCHEMA)
    for question, k in (("Failed login of root?", 5), ("the of", 3), ("beacon beacon dns", 20), ("nothing known", 4), ("", 2), ("shell report", 50)):
        want = match_threat_intel(everything, question, k).collect()
        got = match_indexed_intel(spark, path, question, k).collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_reads_the_terms_folders_only(spark):
    path = index_intel(entries(spark, range(50), 1), scratch_path(spark, "intel"))
    found = term_postings(spark, path, ["malware", "dns"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    folders = plan.split("PartitionFilters: [", 1)[1].split("PushedFilters", 1)[0]
    assert "segment" in folders and "folder" in folders and "In(term" in plan.split("PushedFilters", 1)[1]
    assert {r["term"] for r in found.collect()} == {"malware", "dns"}


def test_words_are_counted_without_a_shuffle(spark):
    from sentrylake.operators.similarity import vector_length, words_of

    texts = [("a", "b a b, c a b"), ("e", ""), ("n", None), ("o", "one"), ("z", " ".join(f"w{i % 7}" for i in range(50)))]
    entries = spark.createDataFrame(texts, "id string, description string")
    found = intel_index.postings(entries)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    words = entries.withColumn("words", words_of(F.coalesce("description", F.lit(""))))
    lengths = {r["id"]: r["n"] for r in words.select("id", vector_length(F.col("words")).alias("n")).collect()}
    got = {(r["id"], r["term"]): (round(r["weight"], 12), r["length"]) for r in found.collect()}
    assert got["a", "b"] == (round(1 + math.log(3), 12), lengths["a"]) and got["a", "c"] == (1.0, lengths["a"])
    assert got["o", "one"] == (1.0, 1.0) and len(got) == 3 + 1 + 7 and got["z", "w0"][0] == round(1 + math.log(8), 12)


def test_texts_of_single_ids_are_not_shuffled(spark):
    from sentrylake.sources.readers import load_threat_intel

    schema = "id string, description string, category string, severity string, mitre_attack string"
    rows = [("1", "one", None, None, None), ("2", "two", "c", "low", "T1"), (None, "none", None, None, None)]
    plain = load_threat_intel(spark.createDataFrame(rows, schema))
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString() and plain.count() == 3
    twice = load_threat_intel(spark.createDataFrame([*rows, ("2", "again", "c", "low", "T1"), (None, "more", None, None, None)], schema))
    assert sorted((r["id"] or "", r["description"]) for r in twice.collect()) == [("", "more"), ("1", "one"), ("2", "again")]
