"""The pipeline against its stages done by hand."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from sentrylake.llm import common, tokens
from tests.llm.test_llm import WORD_BPE, groups_by_hand, lines_by_hand


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs, out = common.table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = common.cut(stage(spark, docs, sf), name)
        out.append(docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_columns(spark, sf, steps):
    want = common.table(spark, sf, "documents").columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "line_dedup", "minhash_near_dedup", "best_fit_packing"]
    assert all(df.columns == want for df in steps[:-1])
    assert all(r["n_chars"] == len(r["text"]) for df in steps[:-1] for r in df.collect())


def test_quality_and_toxicity_take_effect(spark, sf, steps):
    labels = {r["doc_id"]: r for r in common.table(spark, sf, "labels").collect()}
    kept = texts(steps[0])
    assert not any(labels[i]["quality"] == 0 for i in kept if i in labels)
    after = texts(steps[1])
    clean = [i for i in kept if i in labels and labels[i]["toxic"] == 0]
    assert after.keys() <= kept.keys() and sum(i in after for i in clean) >= 0.97 * len(clean)
    assert all(after[i] == kept[i] for i in after)


def test_dedup_stages(steps):
    before, after = texts(steps[1]), texts(steps[2])
    want = lines_by_hand(list(before.items()), 50)
    assert after == {i: t for i, t in want.items() if t == before[i] or re.search(r"[^\x20\x09-\x0D]", t)}
    groups = groups_by_hand(list(after.items()))
    assert texts(steps[3]).keys() == {i for i, g in groups.items() if i == g}


def test_packing_holds_all(spark, sf, steps):
    library, pieces = tokens.tokenizer(WORD_BPE), defaultdict(dict)
    for r in steps[4].collect():
        pieces[r["doc_id"]][r["piece"]] = (r["start"], r["length"], r["ids_crc32"])
    for i, t in texts(steps[3]).items():
        ids = library.encode(t, add_special_tokens=False).ids + [0]
        own = [ids[a : a + 2048] for a in range(0, len(ids), 2048)]
        assert pieces.pop(i) == {n: (2048 * n, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for n, x in enumerate(own)}
    assert not pieces
    run = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, run.select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(tuple, steps[4].select("doc_id", "piece", "ids_crc32").collect()))


def test_odd_rows_and_empty_tables(spark, sf):
    clean = " ".join(f"word{i}" for i in range(120)) + "."
    other = " ".join(f"term{i}" for i in range(130)) + "."
    rows = [(None, clean), (None, other), (1, None), (2, ""), (3, clean), (3, clean), (4, " \n "), (5, other + "\n" + clean)]
    docs = spark.createDataFrame([(i, t, None, None, None, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, d string")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            table = common.cut(stage(spark, table, sf), "odd")
        got = sorted((r["doc_id"] or -1, r["piece"]) for r in table.collect())
        # The rows without an id come first, and hold all that the others repeat.
        assert got in ([(-1, 0), (-1, 0)], [])
