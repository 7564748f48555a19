"""The prefix trie of conversations, built by van Emde Boas recursion on their turns.

A block of level ``j`` is a stretch of ``2^j`` turns that starts at a multiple of ``2^j``. Going up, pairs of blocks
get names by content. Going down, every block is cut at half: the name of its root and of its first half is the
name of the cut prefix, at which the second half starts. Equal first halves under one root become one edge of the
upper trie; second halves are edges of the lower forest that their cut prefix roots. All blocks of a level are
cut by the same jobs, so the recursion takes as many rounds as the longest conversation's length has binary
digits. Totals are then summed by root from the lowest level up, and what a lower forest holds is added to all
edges of the upper trie that lead to it, from the highest level down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrylake.llm.common import cut
from sentrylake.operators.skew import attach_by_key

SHARED_TURNS = 6  # a rebuilt conversation takes fewer turns than this from its hundred's first
HUNDRED = 100
MIN_SPLIT_ROWS = 2_000
CHUNK_IDS = 50_000


def _name(*parts: Column | str) -> Column:
    """128 bits that stand for a sequence; names are as good as the sequences unless MD5 collides."""
    return F.unhex(F.md5(F.concat(*[F.col(p) if isinstance(p, str) else p for p in parts])))


# Names that are no hash.
ROOT, END = bytes(16), b"\xff" * 16


def _first_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % SHARED_TURNS


def numbered_turns(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their places, ``conv_id, part, place`` (from 0), ``token, size``, and turns per ``conv_id, part``.

    The rows are sorted over all tasks first and numbered within a task's part of a conversation, so a
    conversation of any length is split, and no group of rows is larger than a part.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    token = _name(F.lit("t"), F.length(role).cast("string"), F.lit(":"), role, text)
    rows = rows.where("conv_id IS NOT NULL")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", token.alias("token"), F.length(text).cast("long").alias("size"))
    spread = rows.repartitionByRange(F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("token"))
    spread = cut(spread.withColumn("part", F.spark_partition_id()), "turns")
    # One row per conversation and task that has some of its turns.
    shares = spread.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shares = cut(shares.withColumn("before", F.coalesce(before, F.lit(0))), "shares")
    own = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "token"))
    turns = spread.withColumn("own", own).join(shares.drop("n"), ["conv_id", "part"])
    return cut(turns.select("conv_id", "part", (F.col("before") + F.col("own") - 1).alias("place"), "token", "size"), "numbered"), shares


def rebuilt(rows: DataFrame) -> DataFrame:
    """Rebuilt conversations as ``conv_id, place, token, size``, each with an end mark after its last turn.

    Conversation c takes the first h = crc32(c) mod 6 turns of conversation c - c % 100 (all if it has fewer, none if
    it is not there), then its own turns after its first h.
    """
    turns, shares = numbered_turns(rows)
    h = _first_turns(F.col("conv_id"))
    heads = turns.where((F.col("place") < SHARED_TURNS - 1) & (F.col("conv_id") % HUNDRED == 0))
    # At most five turns a conversation, and at most 199 conversations that ask for them.
    heads = heads.groupBy(F.col("conv_id").alias("first")).agg(F.sort_array(F.collect_list(F.struct("place", "token", "size"))).alias("head"))
    asked = shares.groupBy("conv_id").agg(F.sum("n").alias("n_turns"))
    asked = asked.withColumns({"first": F.col("conv_id") - F.col("conv_id") % HUNDRED, "h": h}).join(heads, "first", "left")
    asked = cut(asked.withColumn("head", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int"))), "asked")
    taken = asked.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    last = F.size("head") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))
    ends = asked.select("conv_id", last.alias("place"), F.lit(END).alias("token"), F.lit(0).cast("long").alias("size"))
    back = shares.select("conv_id", "part").join(asked.select("conv_id", (F.col("h") - F.size("head")).alias("back")), "conv_id")
    own = turns.where(F.col("place") >= h).join(back, ["conv_id", "part"])
    own = own.select("conv_id", (F.col("place") - F.col("back")).alias("place"), "token", "size")
    return taken.unionByName(own).unionByName(ends).withColumn("place", F.col("place").cast("long"))


def _paired(blocks: DataFrame) -> DataFrame:
    """Blocks of the next level: ``conv_id, block, left, right`` with the names of the halves."""
    half = lambda side: F.max(F.when(F.col("block") % 2 == side, F.col("name")))
    return blocks.groupBy("conv_id", F.shiftright("block", 1).alias("block")).agg(half(0).alias("left"), half(1).alias("right"))


def _content(pairs: DataFrame) -> DataFrame:
    """A left half alone is named apart from the same half with another after it."""
    return pairs.select("conv_id", "block", _name(F.lit("b"), "left", F.coalesce("right", F.lit("").cast("binary"))).alias("name"))


def build(turns: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """The trie's edges, and for each level the edges with those of their halves.

    Returns ``edges, levels, whole``. ``edges``: ``root`` (the name of the node it leaves), ``edge`` (its own name), ``conv_id`` (the smallest member),
    ``place`` (the depth of the root) and ``n`` (members). End marks make edges as well. ``levels[j]`` has the edges of
    ``2^(j + 1)`` turns: ``root, edge, block, first`` and ``second``, the edges of its halves. ``whole`` has a name of
    the whole of each conversation, ``conv_id, name``.
    """
    tokens = turns.select("conv_id", F.col("place").alias("block"), F.col("token").alias("name"))
    longest = turns.agg(F.max("place")).first()[0]
    height = int(longest or 0).bit_length()
    pairs, blocks = [], tokens
    for j in range(height):
        pairs.append(cut(_paired(blocks), f"pairs{j}"))
        blocks = _content(pairs[-1])
    # All conversations are one block now; equal ones become one edge.
    whole = cut(blocks.select("conv_id", "name"), "whole")
    edges = whole.groupBy("name").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"))
    edges = edges.select(F.lit(ROOT).alias("root"), _name(F.lit("e"), F.lit(ROOT), "name").alias("edge"), "conv_id", F.lit(0).cast("long").alias("block"), "n")
    levels = []
    for j in reversed(range(height)):
        met = edges.join(pairs[j], ["conv_id", "block"])
        left = _name(F.lit("e"), "root", "left")
        met = met.withColumn("first", left).withColumn("second", F.when(F.col("right").isNotNull(), _name(F.lit("e"), "first", "right")))
        met = cut(met.select("root", "edge", "conv_id", "block", "n", "first", "second"), f"edges{j}")
        levels.append(met)
        upper = met.groupBy("root", F.col("first").alias("edge")).agg(F.min("conv_id").alias("conv_id"), F.min(F.col("block") * 2).alias("block"), F.sum("n").alias("n"))
        lower = met.where("second IS NOT NULL").select(F.col("first").alias("root"), F.col("second").alias("edge"), "conv_id", (F.col("block") * 2 + 1).alias("block"), "n")
        edges = upper.unionByName(lower)
    return edges.withColumnRenamed("block", "place"), levels[::-1], whole


def graft(values: DataFrame, levels: list[DataFrame], sums: list[str]) -> DataFrame:
    """For each edge ``edge`` the sums of ``values`` (``root, edge, place`` and ``sums``) over the edges that it leads to, itself included."""
    by_root = values.groupBy("root").agg(F.min("place").alias("block"), *[F.sum(c).alias(c) for c in sums])
    lower = []
    for j, level in enumerate(levels):
        below = cut(by_root, f"below{j}")
        uppers = level.where("second IS NOT NULL").select("root", F.col("first").alias("edge")).distinct()
        # The forest below a cut prefix, and the upper trie's edge that ends there.
        hung = uppers.join(below.where("block % 2 = 1").select(F.col("root").alias("edge"), *sums), "edge")
        lower.append(cut(hung, f"hung{j}"))
        by_root = below.where("block % 2 = 0").select("root", F.shiftright("block", 1).alias("block"), *sums)
        added = lower[-1].select("root", F.lit(None).cast("long").alias("block"), *sums)
        by_root = by_root.unionByName(added).groupBy("root").agg(F.max("block").alias("block"), *[F.sum(c).alias(c) for c in sums])
    more = None
    for j in reversed(range(len(levels))):
        parts = lower[j].select("edge", *sums)
        if more is not None:
            halves = levels[j].join(more, "edge")
            parts = parts.unionByName(halves.select(F.col("first").alias("edge"), *sums))
            parts = parts.unionByName(halves.where("second IS NOT NULL").select(F.col("second").alias("edge"), *sums))
        more = cut(parts.groupBy("edge").agg(*[F.sum(c).alias(c) for c in sums]), f"more{j}")
    own = values.select("edge", *sums)
    return (own if more is None else own.unionByName(more)).groupBy("edge").agg(*[F.sum(c).alias(c) for c in sums])


def id_digests(members: DataFrame) -> DataFrame:
    """SHA-256 of each group's ids (``name, conv_id``), ascending and joined by commas: ``conv_id`` (the first), ``ends_sha256``.

    The digest is sequential by nature. Ids are sorted over all tasks and joined to texts of bounded size there; the
    texts of a group then stream through one digest in their order, without being held.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids, size = None, [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([ids[0]]), pa.array([",".join(map(str, ids))])], names=["name", "first", "ids"])

        for batch in batches:
            for x, i in zip(batch["name"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if ids and (x != name or size > CHUNK_IDS):
                    yield flush()
                    ids, size = [], 0
                name = x
                ids.append(i)
                size += 1
        if ids:
            yield flush()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, sha = None, None, None
        as_rows = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["conv_id", "ends_sha256"])
        for batch in batches:
            done = []
            for x, i, ids in zip(batch["name"].to_pylist(), batch["first"].to_pylist(), batch["ids"], strict=True):
                if sha is not None and x == name:
                    sha.update(b",")
                else:
                    if sha is not None:
                        done.append((first, sha.hexdigest()))
                    name, first, sha = x, i, hashlib.sha256()
                sha.update(ids.as_py().encode())
            yield as_rows(done)
        if sha is not None:
            yield as_rows([(first, sha.hexdigest())])

    texts = members.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id").mapInArrow(join, "name binary, first long, ids string")
    return texts.repartition("name").sortWithinPartitions("name", "first").mapInArrow(digest, "conv_id long, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations (:func:`rebuilt`).

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` (nodes
    without children in the subtree), ``saved_tokens`` (over the subtree, members but one times code points of the
    node's last text) and ``ends_sha256`` (of the ids that end at the node). The root has depth 0 and no parent.

    A null role or text is empty. Turns come in order of their number, null first, and equal numbers in order of the
    MD5 of role and text; repeated rows are repeated turns. Rows without a conversation id belong to none and are left
    out. Conversations and texts may be of any length: no task or row holds a whole conversation or all members of a
    node. An empty table has no node; columns of other names are not read.
    """
    turns = cut(rebuilt(conversations.select("conv_id", "turn", "role", "text")), "rebuilt")
    edges, levels, whole = build(turns)
    # The last turn of an edge, by its smallest member and its place: one row each.
    last = turns.select("conv_id", "place", "size", (F.col("token") == END).alias("ending"))
    edges = cut(edges.join(last, ["conv_id", "place"]), "edges")
    # The edges that leave a node are its children and, if conversations end there, an end mark.
    nodes = edges.groupBy(F.col("root").alias("node")).agg(
        F.min("place").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n").alias("n_convs"),
        F.count_if(~F.col("ending")).alias("n_children"),
    )
    # An edge's smallest member is that of the node it leads to.
    into = edges.where(~F.col("ending")).select(F.col("root").alias("parent"), "edge", "conv_id", (F.col("place") + 1).alias("depth"), "size")
    nodes = cut(nodes.join(into, ["conv_id", "depth"], "left"), "nodes")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves")
    saved = F.coalesce((F.col("n_convs") - 1) * F.col("size"), F.lit(0)).cast("long").alias("saved_tokens")
    values = nodes.where("depth > 0").select(F.col("parent").alias("root"), "edge", (F.col("depth") - 1).alias("place"), leaf, saved)
    totals = graft(values, levels, ["n_leaves", "saved_tokens"])
    # The root, into which no edge leads, holds all.
    everything = nodes.select(leaf, saved).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    totals = totals.unionByName(everything.withColumn("edge", F.lit(None).cast("binary")))
    # Equal conversations end at one node; its end mark has the first of them as its smallest member.
    ends = id_digests(whole).join(edges.where("ending").select("conv_id", F.col("root").alias("node")), "conv_id").drop("conv_id")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("uses"))
    out = nodes.join(ends, "node", "left")
    out = out.join(totals.withColumnRenamed("edge", "into"), F.col("edge").eqNullSafe(F.col("into")))
    out = attach_by_key(out, parents, ["parent"], "uses", "node", "left", min_split_rows=MIN_SPLIT_ROWS)
    digest = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", digest)
