"""The training-text operators against brute force, on small hand-made and given tables."""

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sentrylake.llm import common, html, lm, minhash, packing, pieces, tokencounts, tokens, toxicity, vectors
from sentrylake.llm.linededup import line_dedup
from sentrylake.llm.quality import quality_rules
from sentrylake.llm.queries import QUERIES
from sentrylake.session import checkpoint_root

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
BYTE_BPE, WORD_BPE = tokens.vocabulary_path("byte_bpe_50k.json"), tokens.vocabulary_path("word_bpe_49k.json")
PIECES = tokens.vocabulary_path("piece_bpe_32k.model")
LONG = " ".join(f"w{i % 977} of" for i in range(30_000))
PROSE = "The quick brown fox of the hill went to see the lazy dog by the river and then it ran home again. "


def odd_documents(spark, schema="doc_id long, text string, kept string, n_words string, score string, d string, node string, band string"):
    """Nulls everywhere, empty and long texts, repeated rows, and columns that bear names used within."""
    rows = [(None, None), (1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, PROSE), (5, PROSE), (6, PROSE), (None, PROSE), (7, "ab\ncd"), (7, "other")]
    return spark.createDataFrame([(i, t, "x", None, "y", "z", None, "q") for i, t in rows], schema)


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def documents(spark, sf):
    return [(r["doc_id"], r["text"]) for r in common.table(spark, sf, "documents").collect()]


# --- quality rules ---------------------------------------------------------------------------


def quality_by_hand(text):
    text = text or ""
    w = SPACE.findall(text)
    found = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if found[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark, sf, documents):
    got = {r["doc_id"]: r for r in QUERIES["op2_quality_rules"](spark, sf).collect()}
    assert len(got) == len(documents)
    for i, t in documents:
        r, want = got[i], quality_by_hand(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_quality_separates_labels(spark, sf):
    rows = QUERIES["op2_quality_rules"](spark, sf).join(common.table(spark, sf, "labels"), "doc_id").collect()
    assert not any(r["kept"] for r in rows if r["quality"] == 0)
    assert all(r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"])


def test_quality_lines(spark):
    good = " ".join(f"word{i}" for i in range(80)) + "."
    rows = [(1, f"{good}\n{good.upper()}"), (2, f"{good}\nLicensed under the MIT License.\nHome\nno end"), (3, "a | b | c | d\n" * 30)]
    got = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not got[1]["kept"] and got[1]["clean_text"] == good
    assert got[2]["kept"] and got[2]["clean_text"] == good
    assert got[3]["clean_text"] == "" and not got[3]["kept"]


# --- line dedup ------------------------------------------------------------------------------


def lines_by_hand(rows, least):
    """Lines of every run with ``least`` words that also occurs earlier, by comparing all places."""
    text = {d: [(l, j, len(SPACE.findall(l))) for j, l in enumerate(t.split("\n")) if SPACE.search(l)] for d, t in rows}
    places = defaultdict(list)
    gone = defaultdict(set)
    for d in sorted(text):
        for i, (line, _, _) in enumerate(text[d]):
            for e, j in places[line]:
                n = 0
                while i + n < len(text[d]) and j + n < len(text[e]) and text[d][i + n][0] == text[e][j + n][0]:
                    n += 1
                if sum(x[2] for x in text[d][i : i + n]) >= least:
                    gone[d] |= {x[1] for x in text[d][i : i + n]}
            places[line].append((d, i))
    return {d: "\n".join(l for j, l in enumerate(t.split("\n")) if j not in gone[d]) for d, t in rows}


def test_line_dedup_given_table(spark, sf, documents):
    got = {r["doc_id"]: r["text"] for r in QUERIES["op4_line_dedup"](spark, sf).collect()}
    assert got == lines_by_hand(documents, 50)


def test_line_dedup_random_lines(spark):
    rng = random.Random(4)
    for least in (1, 3, 6):
        rows = [(d, "\n".join(rng.choice(["a", "b b", "c c c", "", "d", " "]) for _ in range(rng.randint(0, 14)))) for d in range(60)]
        got = {r["doc_id"]: r["text"] for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_words=least).collect()}
        assert got == lines_by_hand(rows, least)


def test_line_dedup_odd_rows(spark):
    got = line_dedup(odd_documents(spark), min_words=5).collect()
    assert len(got) == 11 and {r["kept"] for r in got} == {"x"}
    by_id = defaultdict(list)
    for r in got:
        by_id[r["doc_id"]].append(r)
    # The null id comes first, so its copy of the prose stays; equal rows have equal results.
    assert {r["text"] for r in by_id[None]} == {None, PROSE}
    assert [r["text"] for r in by_id[5]] == ["", ""] and by_id[6][0]["n_removed"] == 1
    assert by_id[1][0]["text"] is None and by_id[2][0]["text"] == "" and by_id[4][0]["text"] == LONG
    assert line_dedup(empty_documents(spark)).count() == 0


# --- near duplicates --------------------------------------------------------------------------


def groups_by_hand(rows, least=0.8):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if (len(x & y) / len(x | y) if x | y else 1.0) >= least:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def test_near_duplicates_given_table(spark, sf, documents):
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op8_minhash_near_dedup"](spark, sf).collect()}
    assert got == groups_by_hand(documents)


def test_near_duplicates_large_loose_group(spark):
    """Copies of one text, each changed in places, most of them near to some others only."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(150):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(own)))
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == groups_by_hand(rows)


def test_near_duplicates_odd_rows(spark):
    got = minhash.near_duplicates(odd_documents(spark)).collect()
    assert len(got) == 11
    classes = {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None}
    assert classes[5] == classes[6] and classes[1] == classes[2] != classes[4] and classes[3] != classes[4]
    assert minhash.near_duplicates(empty_documents(spark)).count() == 0


def test_dart_minhash_estimates_weighted_similarity():
    rng = np.random.default_rng(2)
    elements = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.integers(1, 6, 300).astype(float), rng.integers(1, 6, 300).astype(float)
    b[200:] = 0
    keep = b > 0
    sets = np.concatenate([np.zeros(300, np.int64), np.ones(keep.sum(), np.int64)])
    k = 4096
    sig = minhash.dart_minhash(sets, np.concatenate([elements, elements[keep]]), np.concatenate([a, b[keep]]), 2, k)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * math.sqrt(want * (1 - want) / k)
    one = minhash.dart_minhash(np.zeros(1, np.int64), elements[:1], np.ones(1), 2, 64)
    assert (one[0] != 0).all() and (one[1] == 0).all()


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in links for x in (a, b) if a != b or x in got}


def test_small_tables_are_written_by_few_tasks(spark):
    """Rounds of links, forests and ranks of lines write few files, however many partitions a shuffle has."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    written, materialize = defaultdict(list), common.materialize

    def counted(df, name):
        df = materialize(df, name)
        written[name].append(len(df.inputFiles()))
        return df

    links = spark.range(1, 600).selectExpr("id AS a", "id - 1 AS b")
    texts = spark.range(300).selectExpr("id AS doc_id", r"concat_ws('\n', transform(sequence(0, 5), i -> concat('line ', id % 100 + i))) AS text")
    cores = spark.sparkContext.defaultParallelism
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        common.materialize = counted
        assert {r["component"] for r in common.components(links).collect()} == {0}
        assert {r["component"] for r in common.roots(links.toDF("node", "parent"), 600).collect()} == {0}
        line_dedup(texts, min_words=4).collect()
    finally:
        common.materialize = materialize
        for k, v in before.items():
            spark.conf.set(k, v)
    few = written["links"][1:] + written["roots"] + written["ranks"] + written["runs"]
    assert len(few) >= 8 and max(few) <= cores


# --- packing and tokens -----------------------------------------------------------------------


def test_packing_starts_no_plain_python_workers(spark):
    """The places come as a local relation; rows turned by plain Python would be a scan of an RDD."""
    pieces = spark.range(40).selectExpr("id AS doc_id", "id % 7 + 1 AS length")
    packed = packing.pack(pieces, 16)
    assert "ExistingRDD" not in packed._jdf.queryExecution().executedPlan().toString()
    assert packed.count() == 40


def test_packing_is_whole(spark, sf, documents):
    rows = QUERIES["op10_best_fit_packing"](spark, sf).collect()
    library, by_doc, by_sequence = tokens.tokenizer(WORD_BPE), defaultdict(dict), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]][r["piece"]] = r
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert by_doc.keys() == {i for i, _ in documents}
    for i, t in documents:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        cut = [ids[a : a + 2048] for a in range(0, len(ids), 2048)]
        for n, own in enumerate(cut):
            r = by_doc[i][n]
            assert (r["start"], r["length"]) == (2048 * n, len(own))
            assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        assert len(by_doc[i]) == len(cut)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= -(-total // 2048) + 2


@pytest.mark.parametrize("lengths", [range(1, 2049), range(700, 1300), range(200, 900), [2048] * 9, [1], [600] * 100, [1025] * 7 + [1023] * 7])
def test_plans_are_valid_and_tight(lengths):
    want = Counter(lengths)
    runs = packing.plan(dict(want), 2048)
    got = Counter()
    for n, items in runs:
        assert n > 0 and sum(items) <= 2048
        for x in items:
            got[x] += n
    assert got == want
    plain = packing.best_fit([], dict(want), 2048)
    assert sum(n for n, _ in runs) <= sum(n for n, _ in plain) * 1.01 + 1


def odd_texts(seed, count):
    rng = random.Random(seed)
    letters = list("aB é'sßĞ1²½ \t\xa0\x85\x1c\x1f!-ʼnǅſ\n\rΣσ") + ["İ", "漢", "😀", "<|endoftext|>", "<|startoftext|>", "́", " "]
    return ["".join(rng.choice(letters[: rng.choice([6, 20, 99])]) for _ in range(rng.randint(0, 40))) for _ in range(count)]


def test_word_ids_equal_the_library():
    encoder, library = tokens.WordEncoder(WORD_BPE), tokens.tokenizer(WORD_BPE)
    texts = odd_texts(1, 1500)
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_counts_equal_the_library(spark, sf, documents):
    split, library = tokencounts.PreTokens(BYTE_BPE), tokens.tokenizer(BYTE_BPE)
    lengths = tokencounts.Lengths(BYTE_BPE, {})
    for text in odd_texts(2, 1500):
        parts, specials = split(text)
        assert sum(map(lengths.__getitem__, parts)) + specials == len(library.encode(text, add_special_tokens=False).ids), repr(text)
    got = {r["doc_id"]: r for r in QUERIES["op5_token_counts"](spark, sf).collect()}
    for i, t in documents:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 1024)


def test_odd_rows_of_token_operators(spark):
    docs, empty = odd_documents(spark), empty_documents(spark)
    assert sorted(r["n_tokens"] for r in tokencounts.token_counts(docs, BYTE_BPE).collect())[:3] == [0, 0, 0]
    packed = packing.pack_documents(docs, WORD_BPE).collect()
    assert sum(r["piece"] == 0 for r in packed) == 11 and any(r["piece"] > 5 for r in packed)
    assert all(r["exact"] for r in pieces.round_trips(docs, PIECES).collect())
    for got in (tokencounts.token_counts(empty, BYTE_BPE), packing.pack_documents(empty, WORD_BPE), pieces.round_trips(empty, PIECES)):
        assert got.count() == 0


def test_viterbi_is_best():
    model, rng = pieces.PieceModel(PIECES), random.Random(3)

    def best(word):
        cost = [0.0] + [-math.inf] * len(word)
        for e in range(1, len(word) + 1):
            ends = [cost[b] + model.scores[word[b:e]][0] for b in range(e) if word[b:e] in model.scores]
            cost[e] = max(ends) if ends else cost[e - 1] + model.penalty
        return cost[-1]

    for _ in range(1500):
        word = "".join(rng.choice("abcdething▁é漢😀ß0") for _ in range(rng.randint(1, 14)))
        total, byte_run = 0.0, b""
        for i in model.viterbi(word):
            if i in model.bytes_of:
                byte_run += bytes([model.bytes_of[i]])
                try:
                    byte_run.decode()
                except UnicodeDecodeError:
                    continue
                total, byte_run = total + model.penalty, b""
            else:
                total += model.scores[model.pieces[i]][0]
        assert math.isclose(total, best(word), rel_tol=1e-9), word


def test_pieces_round_trip(spark, sf):
    rows = QUERIES["op7_sentencepiece"](spark, sf).collect()
    assert rows and all(r["exact"] for r in rows)
    model = pieces.PieceModel(PIECES)
    for text in odd_texts(7, 800):
        assert model.decode(model.encode(text)) == text
    docs = spark.createDataFrame([(1, "a  b\n漢"), (2, None)], "doc_id long, text string")
    back = pieces.decode_pieces(pieces.encode_pieces(docs, PIECES), PIECES)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {1: "a  b\n漢", 2: ""}


# --- language model ---------------------------------------------------------------------------


def lm_by_hand(rows, states, strength=500):
    def toks(t):
        return SPACE.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) + [None]

    train = [t for _, t, learn in rows if learn]
    c = Counter(w for t in train for w in toks(t))
    total, kinds = sum(c.values()), len(c)
    top = {w for w, _ in sorted(((w, n) for w, n in c.items() if w is not None), key=lambda x: -x[1])[:states]}
    arcs = Counter((a, b) for t in train for a, b in zip(["^", *toks(t)[:-1]], toks(t), strict=True) if (a in top or a == "^") and (b in top or b is None))
    own = Counter()
    for (a, _), n in arcs.items():
        own[a] += n
    out = {}
    for i, t, _ in rows:
        base = score = 0.0
        for a, b in zip(["^", *toks(t)[:-1]], toks(t), strict=True):
            p = (c[b] + 0.5) / (total + 0.5 * (kinds + 1))
            base += math.log10(p)
            n = c[None] if a == "^" else c[a]
            score += math.log10((arcs[a, b] + (strength + n - own[a]) * p) / (n + strength)) if a in top or a == "^" else math.log10(p)
        out[i] = (len(toks(t)), sum(c[b] > 0 for b in toks(t)), total, base, score)
    return out


def test_lm_scores_given_table(spark, sf, documents):
    rows = [(i, t, zlib.crc32(str(i).encode()) % 5 != 1) for i, t in documents]
    want = lm_by_hand(rows, 32_768)
    got = QUERIES["op1_lm_scores"](spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3] and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1)
        assert math.isclose(r["base_score"], w[3], rel_tol=1e-9) and math.isclose(r["score"], w[4], rel_tol=1e-9)
    unseen = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_lm_every_pair_has_an_arc(spark):
    from pyspark.sql import functions as F

    # More words than any fixed vocabulary; the pair of rare words comes three times, and in a text to be scored.
    many = [(i, " ".join(f"w{j} w{j}" for j in range(i * 100, i * 100 + 100)), True) for i in range(400)]
    rows = [*many, *((1000 + i, "seldom said", True) for i in range(2)), (2000, "Seldom said again", True), (3000, "seldom said", False), (3001, "said unheard", False)]
    checkpoint_root(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(4, "doc_id").checkpoint()
    want = lm_by_hand(rows, len(rows) * 1000)
    got = {r["doc_id"]: r for r in lm.lm_scores(docs, F.col("learn")).collect()}
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert math.isclose(got[i]["score"], w[4], rel_tol=1e-9) and got[i]["n_known"] == w[1]


def test_lm_probabilities_sum_to_one():
    hashes = np.array([int(lm.END), 11, 12, 13, 99], np.uint64)
    words = np.sort(hashes[:4])
    counts = (words, np.arange(1, 5))
    states = np.sort(np.append(words, lm.BEGIN))
    keys = np.sort(lm.arc(np.array([11, 11, 11], np.uint64), np.array([12, 13, lm.TOTAL], np.uint64)))
    model = lm.Automaton(counts, (keys, np.where(keys == lm.arc(np.uint64(11), lm.TOTAL), 2, 1)), states, 10, 4, 500.0)
    score = lambda *t: model.score(np.array(t, np.int32), np.zeros(1, np.int64), np.zeros(len(t), bool), hashes)[2][0]
    total = sum(10 ** (score(1, w) - score(1)) for w in range(5))
    assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_lm_odd_rows(spark):
    from pyspark.sql import functions as F

    got = lm.lm_scores(odd_documents(spark), F.lit(True)).collect()
    assert len(got) == 11 and min(r["n_tokens"] for r in got) == 1
    none = lm.lm_scores(odd_documents(spark), F.lit(False)).collect()
    assert all(r["score"] == 0 and r["n_known"] == 0 for r in none)
    assert lm.lm_scores(empty_documents(spark), F.lit(True)).count() == 0


# --- toxicity ---------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op9_toxicity"](spark, sf).join(common.table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    found = [r for r in rows if r["predicted"] == 1]
    toxic = [r for r in rows if r["toxic"] == 1]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert sum(r["toxic"] == 1 for r in found) >= 0.9 * len(found) and sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    for taught in (labels, labels.limit(0)):
        got = toxicity.toxicity_scores(odd_documents(spark), taught).collect()
        assert len(got) == 11 and all(0 <= r["score"] <= 1 for r in got) and {r["kept"] for r in got} == {"x"}
        assert len({r["score"] for r in got if r["text"] == PROSE}) == 1
    assert toxicity.toxicity_scores(empty_documents(spark), labels).count() == 0


def plain_features(text, weights):
    """The features by their definitions: one expression or loop for each, over the whole text."""
    text, letter = text or "", r"[^\W\d_]"
    low = text.lower()
    words = re.findall(letter + "+", low)
    kinds, n, chars = set(words), max(len(words), 1), max(len(text), 1)
    hit = {w: weights[w] for w in kinds if w in weights}
    begun = {w: max((weights.get(s, 0.0) for s in toxicity.stems(w)), default=0.0) for w in kinds if w not in hit}
    begun = {w: x for w, x in begun.items() if x > 0}
    at = [i for i, w in enumerate(words) if w in toxicity.SECOND_PERSON]
    spots = [i for i, w in enumerate(words) if w in hit or w in begun]
    gaps = [min(abs(i - j) for j in at) for i in spots] if at else []
    hidden = re.findall(rf"\S*{letter}[0-9@$!*.|_\-]+{letter}\S*", text)
    shown = ["".join(c for c in t.lower().translate(toxicity.STANDS_FOR) if c.isalpha()) for t in hidden]
    capitals = sum(c.isupper() for c in text) if low != text else 0
    large = sum(len(w) > 2 and w.isupper() for w in text.split()) if capitals > 0.1 * chars else 0
    share = lambda marks: sum(c in marks for c in text) / chars
    both = []
    for found in (hit, begun):
        times = {w: words.count(w) for w in found}
        both += [sum(times[w] * x for w, x in found.items()) / n, max(found.values(), default=0.0), sum(times.values()), len(found)]
    return [
        np.log1p(len(words)), *both, len(at) / n, sum(g <= 5 for g in gaps) / n, 1 / (1 + min(gaps)) if gaps else 0.0,
        capitals / chars, large / n, share("!"), share("?"), share(".,;:!?\"'()[]-"), share("#*$%&@|"), share("0123456789"),
        len(hidden) / n, sum(p in weights for p in shown), len(re.findall(rf"({letter})\1\1", low)) / n, sum(map(len, words)) / n, len(kinds) / n,
    ]


def prose_and_terms(spark, sf):
    texts = [r["text"] for r in common.table(spark, sf, "documents").select("text").collect()]
    kinds = sorted({w for t in texts for w in toxicity.WORD.findall((t or "").lower())})[::40]
    terms = kinds + [s for w in kinds[::2] for s in toxicity.stems(w)] + ["you", "idiot", "maß"]
    return texts, toxicity.Lexicon({t: 2 + i % 5 for i, t in enumerate(terms)}, {t: i % 9 for i, t in enumerate(terms)}, 40, 400)


def test_toxicity_features_as_plain(spark, sf):
    texts, lexicon = prose_and_terms(spark, sf)
    kinds = "aaaAbßéÉéİıǅⅧ²½٣中日ЖжΣς  .-_!?*@$|0134579\t\n\x1c\x85\u00a0\u2003\u200b\u0301“”«»¿…€😀"
    rng = np.random.default_rng(3)
    odd = ["".join(rng.choice(list(kinds[: rng.integers(2, len(kinds))]), rng.integers(1, 60))) for _ in range(3000)]
    odd += [None, "", "YOU 1d10t!!! Id-io-t you", "x y.z", "you idiooot", "-a-", "éééé 中中中", "a1b\x85c2d", " MASS maß"]
    for label in (None, 0, 1):
        weights = lexicon.weights(label)
        assert weights == {t: x for t in lexicon.toxic if (x := lexicon.weight(t, label)) > 0}
        begins = toxicity.beginnings(weights)
        for t in [*texts[:200], *odd]:
            assert toxicity.features(t, weights, begins) == plain_features(t, weights), t


def test_toxicity_features_cost(spark, sf):
    """Far below one expression for each feature; time in proportion to a run of marks."""
    texts, lexicon = prose_and_terms(spark, sf)
    weights = lexicon.weights()
    begins = toxicity.beginnings(weights)

    def seconds(fn):
        began = time.process_time()
        fn()
        return time.process_time() - began

    # The scans that an earlier version made of every text.
    hidden, thrice = re.compile(r"[^\s]*[^\W\d_][0-9@$!*.|_\-]+[^\W\d_][^\s]*"), re.compile(r"([^\W\d_])\1\1")
    earlier = lambda t: (toxicity.WORD.findall(t.lower()), hidden.findall(t), thrice.findall(t.lower()))
    scans = min(seconds(lambda: [earlier(t) for t in texts if t]) for _ in range(3))
    assert min(seconds(lambda: [toxicity.features(t, weights, begins) for t in texts]) for _ in range(3)) < 1.2 * scans
    assert seconds(lambda: toxicity.features("a" + "-" * 200_000, weights, begins)) < 2


def test_isotonic_rises():
    rng = np.random.default_rng(0)
    m = rng.normal(size=500)
    y = (rng.random(500) < 1 / (1 + np.exp(-3 * m))).astype(float)
    xs, ys = toxicity.isotonic(m, y)
    assert (np.diff(ys) >= 0).all() and (np.diff(xs) >= 0).all() and abs(np.interp(m, xs, ys).mean() - y.mean()) < 0.02


# --- pages ------------------------------------------------------------------------------------


def test_main_text_is_the_article(spark, sf):
    pages = common.table(spark, sf, "pages").collect()
    got = {r["page_id"]: r for r in QUERIES["op3_html_main_text"](spark, sf).collect()}
    assert len(got) == len(pages)
    for p in pages:
        inside = p["html"].split("<article>", 1)[1].split("</article>", 1)[0] if "<article>" in p["html"] else ""
        inside = re.sub(r"<[^>]*>|<[/a-z][^>]*$", " ", inside)
        assert got[p["page_id"]]["text"] == " ".join(html.unescape(inside).split())
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])


def test_blocks():
    page = "<body><script>var t='</p><p>x'</script><div class='a b'>one <b>two</b>three<br>four &amp; &lt;<!-- <p>no</p> --><p>five<p>six</div><li><a href='>'>seven</a>&am"
    assert [(b.path, b.text) for b in html.blocks_of(page)] == [
        (("body", "div", "a", "b"), "one twothree four & <"),
        (("body", "div", "a", "b", "p"), "five"),
        (("body", "div", "a", "b", "p"), "six"),
        (("body", "li"), "seven&am"),
    ]


def test_other_templates(spark):
    words = "the river ran past the old mill and on to the sea where ships lay at rest in the evening sun".split()
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    rows, want = [], {}
    for i in range(40):
        body = [say(rng.randint(15, 60)) for _ in range(5)]
        comments = "".join(f"<div class='comment'><p>{say(12)}</p></div>" for _ in range(3))
        side = f"<aside class='sidebar'><h3>{say(2)}</h3><ul><li><a href='#'>{say(3)}</a></li></ul></aside>"
        notice = f"<div class='cookie-notice'><p>{say(14)}</p></div>"
        article = "".join(f"<p>{b}</p>" for b in body)
        rows.append((i, "u", f"<html><body><header><a href='/'>{say(2)}</a></header>{notice}<main><article><h1>Title here</h1>{article}"
                             f"<section class='comments'>{comments}</section></article></main>{side}<footer><p>{say(5)}</p></footer></body></html>"))  # fmt: skip
        want[i] = " ".join(["Title here", *body])
    got = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert sum(got[i] == want[i] for i in want) >= 38


def test_odd_pages(spark):
    rows = [(None, None, None), (1, None, ""), (1, "u", "<p>a"), (1, "u", "<p>a"), (2, "u", "no tags"), (3, "u", "<!-- "), (4, "u", "<article><p>" + LONG + "</p></article>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = html.main_text(pages).collect()
    assert len(got) == 7 and all(r["text"] is not None and r["n_chars"] == len(r["text"]) for r in got)
    assert html.main_text(pages.limit(0)).count() == 0


# --- vectors ----------------------------------------------------------------------------------


def vectors_by_hand(rows, least=0.93):
    fine = [(i, l, np.array(v, float)) for i, v, l in rows if i is not None and l is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links, parent = Counter(), {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, (i, l, v) in enumerate(fine):
        for j, m, w in fine[:k]:
            if l == m and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= least:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (links[i], root(i)) for i, _, _ in rows if i is not None}


def dense_rows(seed=6):
    rng, rows = np.random.default_rng(seed), []
    centre = rng.normal(size=16)
    for i in range(420):
        v = centre + rng.normal(size=16) * 0.02 if i % 3 == 0 else rng.normal(size=16)
        if i % 10 == 9:
            v = np.array(rows[i - 4][1]) + rng.normal(size=16) * 0.03
        rows.append((i, [float(x) for x in np.float32(v)], i % 2))
    return rows


def test_near_vectors_dense_cluster(spark):
    rows = dense_rows()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = vectors_by_hand(rows)
    # Small shards: clusters are cut into parts, and searched part by part.
    for size in (2048, 100):
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(table, shard_rows=size).collect()}
        right = sum(got[i][0] for i in got) / sum(n for n, _ in want.values())
        assert got.keys() == want.keys() and (got == want if size == 2048 else right >= 0.9)


def links_by_product(rows, least=0.93):
    """As vectors_by_hand, for many rows of one width."""
    label, x = np.array([r[2] for r in rows]), np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= least) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    low = np.arange(len(rows))
    while True:
        new = np.minimum(low, np.where(near, low, len(rows)).min(axis=1))
        if (new == low).all():
            return {r[0]: (int(n), rows[i][0]) for r, n, i in zip(rows, near.sum(axis=1), low, strict=True)}
        low = new


def test_near_vectors_dense_cluster_over_many_centroids(spark):
    # About 40 sampled centres lie in one cluster whose pairs nearly all link, and 10 among other vectors.
    rng = np.random.default_rng(3)
    centre = rng.normal(size=64)
    centre /= np.linalg.norm(centre)
    dense = [centre + rng.normal(size=64) * 0.031 for _ in range(1600)]
    rows = [(i, [float(c) for c in np.float32(v)], 0) for i, v in enumerate([*dense, *rng.normal(size=(400, 64))])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = links_by_product(rows)
    assert np.mean([want[i][0] for i in range(1600)]) > 1400
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(table, shard_rows=40).collect()}
    assert got == want


def test_near_vectors_small_shards(spark):
    # Chance decides whether the vectors of a pair are at home in one shard.
    rng = np.random.default_rng(4)
    heart = rng.normal(size=(700, 16))
    noise = rng.normal(size=(2100, 16))
    rows = [(i, [float(c) for c in np.float32(heart[i % 700] + 0.22 * noise[i])], i % 700 % 2) for i in range(2100)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = links_by_product(rows)
    assert sum(n for n, _ in want.values()) > 1000
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(table, shard_rows=30).collect()}
    assert got == want
    rows = dense_rows()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_vectors(table, shard_rows=30).collect()}
    assert got == vectors_by_hand(rows)


def test_near_vectors_given_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in common.table(spark, sf, "embeddings").collect()]
    want = vectors_by_hand(rows)
    for r in QUERIES["op6_embedding_near_dedup"](spark, sf).collect():
        assert (r["n_links"], r["component_id"]) == want[r["vec_id"]] and r["kept"] == (r["vec_id"] == r["component_id"])


def test_near_vectors_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1),
            (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (10, [2.0, 0.1], 1), (11, [1.0, 0.0], 2), (12, [1.0], 1), (2, [1.0, 0.0], 1)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    got = defaultdict(list)
    for r in vectors.near_vectors(table).collect():
        got[r["vec_id"]].append((r["n_links"], r["component_id"]))
    assert got[1] == [(3, 1)] and got[2] == [(3, 1), (3, 1)] and got[10] == [(3, 1)]
    assert all(got[i] == [(0, i)] for i in (3, 4, 5, 6, 7, 8, 9, 11, 12)) and got[None] == [(0, None)]
    assert vectors.near_vectors(table.limit(0)).count() == 0
