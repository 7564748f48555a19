"""The conversation trie against a plain one in dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from sentrylake.llm import trie
from sentrylake.llm.trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, place string, n int, root string, size string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"t{len(role)}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0), key, (role, text)))
    own = {c: [t for _, _, t in sorted(x)] for c, x in own.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    top = {"n": 0, "first": None, "ends": [], "kids": {}, "depth": 0, "saved": 0, "parent": None}
    for c in sorted(seqs):
        node, path = top, [top]
        for t in seqs[c]:
            if t not in node["kids"]:
                node["kids"][t] = {"n": 0, "first": c, "ends": [], "kids": {}, "depth": node["depth"] + 1, "text": t[1], "parent": node}
            node = node["kids"][t]
            path.append(node)
        node["ends"].append(c)
        for x in path:
            x["n"] += 1
    if not seqs:
        return []
    top["first"] = min(seqs)
    order, out = [top], []
    for x in order:
        order.extend(x["kids"].values())
    for x in reversed(order):
        x["leaves"] = sum(k["leaves"] for k in x["kids"].values()) or 1
        x["saved"] = sum(k["saved"] for k in x["kids"].values()) + (x["n"] - 1) * len(x.get("text", ""))
        sha = hashlib.sha256(",".join(map(str, x["ends"])).encode()).hexdigest()
        out.append((x["first"], x["depth"], x["parent"] and x["parent"]["first"], x["n"], len(x["kids"]), x["leaves"], x["saved"], sha))
    return sorted(out, key=repr)


def check(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1, "y", None) for r in rows], SCHEMA).repartition(4)
    got = conversation_trie(table)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(rows)


def test_random_conversations(spark):
    draw = random.Random(5)
    rows = []
    for c in [*range(0, 330), *range(5000, 5040), 10**12]:
        for turn in range(draw.choice([0, 1, 1, 2, 3, 5, 9, 17])):
            rows.append((c, turn, draw.choice(["user", "assistant"]), draw.choice("aé𝄞") * draw.randint(0, 2)))
    check(spark, rows)


def test_hot_first_turn_long_conversation_and_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "MIN_SPLIT_ROWS", 5)
    monkeypatch.setattr(trie, "CHUNK_IDS", 3)
    rows = [(c, t, "user", "hello" if t == 0 else f"{c % 7}") for c in range(0, 40_000, 100) for t in range(2)]
    rows += [(7, t, "user", "again") for t in range(900)] + [(8, t, "user", "again") for t in range(901)]
    check(spark, rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (0, None, None, None), (0, 1, "user", "x" * 200_000), (0, 1, "user", "x" * 200_000), (0, 1, "a", "tie"), (0, 1, "b", "tie"),
        (1, 3, "user", None), (2, 1, "", ""), (100, 0, "us", "er"), (100, 0, "user", ""), (101, 5, "u", "ser"), (205, 1, "user", "no first conversation"),
    ]
    check(spark, rows)
    check(spark, rows[:1])


@pytest.mark.parametrize("n", [1, 2])
def test_turnless(spark, n):
    """Conversations of one turn that belong to a hundred without a first one may lose that turn."""
    check(spark, [(100 * i + 1, 0, "user", "gone") for i in range(1, 12 * n)])
