"""Near duplicates where ids are missing or shared, loose groups in hot bands, and forests of links."""

import random

import pytest

import corpus_pipeline
from sentrylake.llm import common, minhash

BASE = [f"w{i}" for i in range(120)]


def changed(rng, times):
    own = list(BASE)
    for _ in range(times):
        own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
    return " ".join(own)


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups_of(texts):
    """Component number of each distinct text, by all pairs."""
    kinds = sorted(set(texts))
    sets, parent = [shingles(t) for t in kinds], list(range(len(kinds)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(kinds)):
        for j in range(i):
            both = len(sets[i] | sets[j])
            if not both or len(sets[i] & sets[j]) / both >= 0.8:
                parent[root(i)] = root(j)
    return {t: root(i) for i, t in enumerate(kinds)}


def table(spark, rows):
    return spark.createDataFrame([(i, t, "c", 1, "m", "r") for i, t in rows], "doc_id long, text string, component string, node int, m string, first string").repartition(3)


def test_ids_shared_by_different_texts(spark):
    rng = random.Random(3)
    other = " ".join(f"other{i}" for i in range(60))
    third = " ".join(f"third{i}" for i in range(60))
    rows = [(1, " ".join(BASE)), (1, other), (1, third), (1, third), (None, third), (2, changed(rng, 1)), (3, changed(rng, 60)), (None, changed(rng, 80)), (-5, other + " end")]
    docs = table(spark, rows)
    group = groups_of([t for _, t in rows])
    kept = [(r["doc_id"], r["text"]) for r in minhash.one_of_each(docs).collect()]
    assert minhash.one_of_each(docs).columns == docs.columns
    assert len(kept) == len({group[t] for _, t in kept}) == len(set(group.values()))
    least = {g: min((i for i, t in rows if group[t] == g and i is not None), default=None) for g in group.values()}
    got = sorted(map(repr, map(tuple, minhash.near_duplicates(docs).select("doc_id", "class_id").collect())))
    assert got == sorted(repr((i, least[group[t]])) for i, t in rows)
    stage = dict(corpus_pipeline.STAGES)["minhash_near_dedup"]
    assert sorted(t for _, t in kept) == sorted(r["text"] for r in stage(spark, docs, "").collect())


@pytest.mark.parametrize("split", [4_096, 7])
def test_loose_group_in_one_hot_band(spark, monkeypatch, split):
    monkeypatch.setattr(minhash, "SPLIT_ROWS", split)
    rng = random.Random(8)
    rows = [(d, changed(rng, rng.randint(2, 5))) for d in range(160)]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(table(spark, rows)).collect()}
    group = groups_of([t for _, t in rows])
    least = {g: min(i for i, t in rows if group[t] == g) for g in group.values()}
    assert got == {i: least[group[t]] for i, t in rows}


def test_roots(spark):
    rng = random.Random(4)
    parent = {i: rng.randrange(i) for i in range(1, 200)} | {i: i - 1 for i in range(1001, 1300)}

    def root(x):
        while x in parent:
            x = parent[x]
        return x

    got = common.roots(spark.createDataFrame(list(parent.items()), "node long, parent long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: root(x) for x in parent} and len(got) == len(parent)
    assert common.roots(spark.createDataFrame([], "node long, parent long")).count() == 0
