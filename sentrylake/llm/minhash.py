"""Near-duplicate groups of documents with DartMinHash signatures and banded joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sentrylake.llm.common import components, cut, roots, watched

_A, _B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
# Ends of the rank ranges in which darts are thrown; the same for all sets.
RANKS = [0.0, *(2.0**j for j in range(-5, 60, 2))]
CELL = 8.0  # the largest area of a cell


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each item repeated by its count, and the number of the repetition."""
    at = np.repeat(np.arange(len(counts)), counts)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)


class Shingler:
    """Word n-grams of texts (lower case) as distinct 64-bit hashes with counts."""

    def __init__(self, size: int = 5):
        self.size, self.known = size, {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        tokens = (text or "").lower().split()
        if not tokens:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        known = self.known
        if len(known) > 1_000_000:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        n = max(1, len(h) - self.size + 1)
        s = np.zeros(n, np.uint64)
        for j in range(min(self.size, len(h))):  # a text of fewer words is one shingle
            s = mix(s + h[j : j + n] * np.uint64(2 * j + 1) + _C)
        return np.unique(s, return_counts=True)


def darts(elements: np.ndarray, weights: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Darts at ranks ``RANKS[level]`` to ``RANKS[level + 1]``: owner (index of an element), rank, hash.

    Every element owns a plane of weight by rank on which darts fall as a Poisson process of rate 1 that
    depends on the element alone. The plane is cut into cells of one weight range [v, v + 1) by a rank range;
    the hash of (element, cell) gives the number of darts in the cell and where they fall, and a dart counts
    if it falls below the element's weight. So two sets see the same darts on what they share.
    """
    low, high = RANKS[level], RANKS[level + 1]
    pieces = max(1, round((high - low) / CELL))
    area = (high - low) / pieces
    at, cell = spread(np.ceil(weights).astype(np.int64) * pieces)
    v, piece = cell // pieces, cell % pieces
    seed = mix(elements[at] + mix((v * pieces + piece).astype(np.uint64) * np.uint64(64) + np.uint64(level)))
    u, count = unit(seed), np.zeros(len(at), np.int64)
    p = total = np.exp(-area)
    for j in range(1, 200):  # the inverse of the Poisson distribution
        more = u >= total
        if not more.any():
            break
        count += more
        p *= area / j
        total += p
    own, number = spread(count)
    dart = mix(seed[own] + (number.astype(np.uint64) + np.uint64(1)) * _C)
    owner = at[own]
    inside = v[own] + unit(mix(dart + np.uint64(1))) < weights[owner]
    rank = low + area * (piece[own] + unit(mix(dart + np.uint64(2))))
    return owner[inside], rank[inside], dart[inside]


def dart_minhash(sets: np.ndarray, elements: np.ndarray, weights: np.ndarray, n_sets: int, k: int) -> np.ndarray:
    """``k`` coordinates for each of many weighted sets; ``sets`` has the set of each element.

    A coordinate is the hash of the earliest dart that falls to it, so two sets agree there with the
    probability of their weighted Jaccard similarity. Ranges are taken in turn until every coordinate of a
    set has a dart; later ranges hold later darts only. Empty sets get zeros.
    """
    best, out = np.full(n_sets * k, np.inf), np.zeros(n_sets * k, np.uint64)
    for level in range(len(RANKS) - 1):
        if not len(elements):
            break
        owner, rank, dart = darts(elements, weights, level)
        key = sets[owner] * k + (mix(dart + np.uint64(3)) % np.uint64(k)).astype(np.int64)
        open_ = best[key] > RANKS[level]
        key, rank, dart = key[open_], rank[open_], dart[open_]
        np.minimum.at(best, key, rank)
        won = rank == best[key]
        out[key[won]] = dart[won]
        going = ~np.isfinite(best.reshape(n_sets, k)).all(axis=1)
        left = going[sets]
        sets, elements, weights = sets[left], elements[left], weights[left]
    return out.reshape(n_sets, k)


def similarity(a: tuple, b: tuple, counted: bool) -> float:
    """Jaccard similarity of two shingle sets, or of their counts; two empty sets are equal."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    if not counted:
        same = len(np.intersect1d(a[0], b[0], assume_unique=True))
        return same / (len(a[0]) + len(b[0]) - same)
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    same = np.minimum(a[1][i], b[1][j]).sum()
    return same / (a[1].sum() + b[1].sum() - same)


def _signatures(bands: int, rows: int, extra: int, shingle: int, counted: bool, elements_held: int = 200_000, sets_held: int = 64):
    k = bands * rows + extra

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle)

        def flush(ids, keys, parts):
            sets = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
            elements = np.concatenate([p[0] for p in parts])
            counts = np.concatenate([p[1] for p in parts])
            weights = counts.astype(np.float64) if counted else np.ones(len(counts))
            sig = dart_minhash(sets, elements, weights, len(parts), k)
            band = np.repeat(np.arange(bands, dtype=np.uint64)[None], len(parts), 0)
            for j in range(rows):
                band = mix(band * _C + sig[:, : bands * rows].reshape(len(parts), bands, rows)[:, :, j])
            nibbles = (sig & np.uint64(15)).reshape(len(parts), k // 16, 16)
            sketch = (nibbles << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64)
            size = np.array([p[1].sum() if counted else len(p[0]) for p in parts], np.int64)
            as_list = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.view(np.int64).ravel()), x.shape[1]).cast(pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.string()), pa.array(size), as_list(band), as_list(sketch)],
                names=["id", "m", "n", "bands", "sketch"],
            )

        for b in batches:
            ids, keys, parts, held = [], [], [], 0
            for i, m, text in zip(b["id"].to_pylist(), b["m"].to_pylist(), b["text"], strict=True):
                ids.append(i)
                keys.append(m)
                parts.append(shingler(text.as_py()))
                held += len(parts[-1][0])
                # Short texts get thousands of darts as well, so both numbers bound the memory.
                if held > elements_held or len(parts) == sets_held:
                    yield flush(ids, keys, parts)
                    ids, keys, parts, held = [], [], [], 0
            if parts:
                yield flush(ids, keys, parts)

    return run


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, counted: bool, least: float) -> DataFrame:
    """The pairs ``a, b`` whose texts have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, last, own = Shingler(shingle), None, None
        for batch in batches:
            ok = []
            for a, ta, tb in zip(batch["a"].to_pylist(), batch["ta"], batch["tb"], strict=True):
                if a != last:
                    last, own = a, shingler(ta.as_py())
                ok.append(similarity(own, shingler(tb.as_py()), counted) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "ta", "tb", "b")
    return both.mapInArrow(run, "a long, b long")


def _differing(x: Column, y: Column) -> Column:
    """Coordinates in which two sketches of four bits each differ."""
    d = x.bitwiseXOR(y)
    d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
    d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
    return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))


def _wide_sketches(texts: DataFrame, shingle: int, counted: bool, width: int) -> DataFrame:
    """Sketches of ``width`` coordinates, four bits each, of the texts that narrow ones leave open: ``node, wide``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner = _signatures(1, 16, width - 16, shingle, counted, sets_held=16)
        for batch in batches:
            named = pa.RecordBatch.from_arrays([batch["node"], pa.nulls(batch.num_rows, pa.string()), batch["text"]], names=["id", "m", "text"])
            for out in inner(iter([named])):
                yield pa.RecordBatch.from_arrays([out["id"], out["sketch"]], names=["node", "wide"])

    return texts.select("node", "text").mapInArrow(run, "node long, wide array<long>")


def _most_differing(k: int, threshold: float) -> int:
    """Two sets at the threshold differ in more of ``k`` coordinates of four bits with a probability of about 3e-6."""
    return int((1 - threshold) * 15 / 16 * k + 4.5 * (k * threshold * (1 - threshold)) ** 0.5)


# Ids made from texts, for rows that have none or share one with another text: above all real ids.
MADE_ID = 1 << 62
# Rows of a band and size that one task compares with those of another group.
SPLIT_ROWS = 4_096


def made_id(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(MADE_ID - 1)).bitwiseOR(F.lit(MADE_ID))


def near_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    shingle: int = 5,
    bands: int = 32,
    rows: int = 4,
    extra: int = 128,
    counted: bool = False,
    turns: int = 1,
    offers: int = 4,
    wide: int = 1024,
) -> DataFrame:
    """The groups of :func:`near_duplicates` by distinct text: ``m`` (MD5), ``first`` (smallest id), ``node``, ``component``.

    A text's node is its smallest id, or a number made from the text if it has none or another text has that id too; a
    component is its smallest node.
    """
    k = bands * rows + extra
    most, most_wide = _most_differing(k, threshold), _most_differing(wide, threshold)
    key = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.md5(key).alias("m"), key.alias("text"))
    sizes = Observation()
    measured = source.observe(sizes, F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    sigs = measured.mapInArrow(_signatures(bands, rows, extra, shingle, counted), "id long, m string, n long, bands array<long>, sketch array<long>")
    sigs = cut(sigs, "signatures")
    # Tables of one row for each text have at most so many.
    count, letters = sizes.get["rows"], sizes.get["bytes"] or 0
    firsts = sigs.groupBy("m").agg(F.min("id").alias("first"))
    # Of several texts with one smallest id one has it as its node.
    shared = firsts.groupBy("first").agg(F.min("m").alias("holder"), F.count("*").alias("n")).where("first IS NOT NULL AND n > 1")
    classes = firsts.join(shared.hint("merge"), "first", "left")
    own = F.when(F.col("first").isNotNull() & (F.col("holder").isNull() | (F.col("m") == F.col("holder"))), F.col("first"))
    classes = cut(classes.select("m", "first", F.coalesce(own, made_id(F.col("m"))).alias("node")), "classes", 48 * count)
    reps = sigs.groupBy("m").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    reps = cut(reps.join(classes.select("m", "node").hint("merge"), "m"), "nodes", (48 + 8 * bands + k // 2) * count)

    # Bands with two nodes or more.
    banded = reps.select("node", F.posexplode("bands").alias("pos", "band"))
    buckets = banded.groupBy("band").agg(F.min("node").alias("leader"), F.max("node").alias("_last")).where("leader < _last")
    members = cut(banded.join(buckets.drop("_last").hint("merge"), "band"), "members", 28 * bands * count)
    sketches = reps.select("node", "n", *[F.col("sketch")[j].alias(f"s{j}") for j in range(k // 16)])
    marks = [f"s{j}" for j in range(k // 16)]

    def side(suffix: str) -> DataFrame:
        return sketches.select([F.col(c).alias(c + suffix) for c in sketches.columns])

    def close(a: str, b: str) -> Column:
        differ = sum((_differing(F.col(c + a), F.col(c + b)) for c in marks), F.lit(0))
        sizes = F.least(f"n{a}", f"n{b}") >= F.greatest(f"n{a}", f"n{b}") * F.lit(threshold)
        return (differ <= most) & sizes

    near = members.select("node").distinct()
    wanted = reps.select("m", "node").join(near.hint("merge"), "node")
    texts = source.select("m", "text").join(wanted.hint("merge"), "m").groupBy("node").agg(F.first("text").alias("text"))
    texts = cut(texts, "texts", letters + 16 * count)

    def closest(offered: DataFrame) -> DataFrame:
        """Of pairs ``node, leader`` the closest by their sketches for each node, if it may be linked: ``a, b``."""
        both = offered.join(sketches.hint("merge"), "node").join(side("_l").withColumnRenamed("node_l", "leader").hint("merge"), "leader")
        differ = sum((_differing(F.col(c), F.col(c + "_l")) for c in marks), F.lit(0))
        best = both.where(close("", "_l")).groupBy("node").agg(F.min_by("leader", F.struct(differ, F.col("leader"))).alias("b"))
        return best.withColumnRenamed("node", "a")

    # One leader each: the closest of those it shares a band with. A leader is smaller, so these links are a forest.
    stars = closest(members.where("node <> leader").select("node", "leader").distinct())
    found = _verified(stars, texts, shingle, counted, threshold).toDF("node", "parent")
    groups = near.join(roots(found, count).hint("merge"), "node", "left")
    groups = cut(groups.select("node", F.coalesce("component", "node").alias("component")), "groups", 16 * count)

    def merged(groups: DataFrame, links: DataFrame, most: int) -> DataFrame:
        """Groups that the links ``a, b``, ``most`` at most, join: components are sought among groups, not among nodes."""
        of_a = groups.select(F.col("node").alias("a"), F.col("component").alias("u")).hint("merge")
        of_b = groups.select(F.col("node").alias("b"), F.col("component").alias("v")).hint("merge")
        between = links.join(of_a, "a").join(of_b, "b").where("u <> v").select("u", "v").distinct()
        new = components(between, "u", "v", most).toDF("component", "_new").hint("merge")
        return cut(groups.join(new, "component", "left").select("node", F.coalesce("_new", "component").alias("component")), "groups", 16 * count)

    def mixed_bands(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of bands that still hold more than one group, and each such band's most frequent group."""
        here = members.select("band", "pos", "node").join(groups.withColumnRenamed("component", "group").hint("merge"), "node")
        counts = here.groupBy("band", "group").count()
        top = counts.groupBy("band").agg(F.max_by("group", F.struct("count", "group")).alias("top"), F.count("*").alias("_n")).where("_n > 1")
        top = cut(top.drop("_n"), "tops", 16 * bands * count)
        return cut(here.join(top.hint("merge"), "band"), "mixed", 36 * bands * count), top

    # In a large group many are near to some, but not to one leader. So a few members of each band's largest group,
    # other ones each time, are offered to the nodes outside it, and each node is checked against the closest.
    for turn in range(turns):
        here, _ = mixed_bands(groups)
        picks = [F.min_by("node", F.xxhash64("node", F.lit(turn), F.lit(j))) for j in range(offers)]
        picked = here.where("group = top").groupBy("band").agg(F.array(*picks).alias("reps"))
        offered = here.where("group <> top").join(picked.hint("merge"), "band")
        offered = offered.select("node", F.explode("reps").alias("leader")).distinct()
        groups = merged(groups, _verified(closest(offered), texts, shingle, counted, threshold), count)

    # What is left: all of one group but the most frequent against the rest of the band. Groups whose members are alike
    # but not near enough would leave many pairs open, so these texts get wider sketches.
    here, _ = mixed_bands(groups)
    left = here.select("node").distinct()
    wider = _wide_sketches(texts.join(left.hint("merge"), "node"), shingle, counted, wide)
    wider = cut(wider.join(reps.select("node", "n", "bands", *[F.col("sketch")[j].alias(f"s{j}") for j in range(k // 16)]).hint("merge"), "node"), "wide", (16 + wide // 2 + 8 * bands + k // 2) * count)
    # Sizes of linked sets differ by less than one class of this width, so neighbouring classes do.
    width = float(np.log(1 / threshold) + 1e-9)
    here = here.join(wider.hint("merge"), "node").withColumn("size", F.floor(F.log(F.col("n") + F.lit(1e-9)) / width))
    # A hot band is split into parts that each meet all nodes outside its most frequent group.
    hottest = here.groupBy("band", "size").count().agg(F.max("count")).first()[0]
    parts = -(-(hottest or 1) // SPLIT_ROWS)
    few = here.where("group <> top")
    few = few.withColumn("size", F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)))
    few = few.select("band", "size", "top", *[F.col(c).alias(c + "_x") for c in ["node", "group", "n", "bands", "wide", *marks]])
    few = few.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    rest = here.drop("top").withColumn("part", F.pmod(F.hash("node"), F.lit(parts)))
    both_few = (F.col("group") == F.col("top")) | (F.col("node") > F.col("node_x"))
    # A pair that shares several bands is made in the first of them.
    first = F.lit(True)
    for j in range(bands - 1):
        first = first & ((F.col("pos") <= j) | (F.col("bands")[j] != F.col("bands_x")[j]))
    differ = F.aggregate(F.zip_with("wide", "wide_x", _differing), F.lit(0), lambda a, b: a + b)
    alike = (F.col("group") != F.col("group_x")) & both_few & close("", "_x") & first & (differ <= most_wide)
    pairs = few.join(rest.hint("merge"), ["band", "size", "part"]).where(alike)
    pairs = pairs.select(F.least("node", "node_x").alias("a"), F.greatest("node", "node_x").alias("b")).distinct()
    pairs, seen = watched(pairs, "pairs", F.count(F.lit(1)).alias("rows"))
    groups = merged(groups, _verified(pairs, texts, shingle, counted, threshold), seen["rows"])
    return classes.join(groups.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``class_id`` (smallest id of its group), ``kept``.

    Documents are linked if their sets of five-word windows (``shingle``; with ``counted``: the windows' counts)
    have a Jaccard similarity of 0.8 (``threshold``) or more; a group is what links reach. ``options`` are those of
    :func:`near_groups`. A pair at 0.8 shares one of 32 bands of 4 coordinates with probability 1 - 5e-8. Exact copies
    are one node from the start. Each node is first checked against the closest of the leaders (smallest nodes) that it
    shares bands with, and in ``turns`` more turns against the closest of some members of the groups it meets. Within a
    band, links are then sought only between nodes that are not in one group yet, by sketches, and checked on whole
    texts. So a large group of near copies costs about one check for each member, and no link between groups is lost.
    Equally close leaders: the smaller. Texts of any length are compared whole.

    Null and empty texts are copies of each other. Rows that share an id but not the text are documents of their own;
    their groups may have the same ``class_id``. A row without an id has a ``class_id`` only if a row with one is in its
    group. ``kept`` rows hold the text that stands for the group, in as many rows as the table repeats it under the
    same id; of a group without ids all rows of that text are kept. An empty table gives an empty one; columns of other
    names are not read.
    """
    classes = near_groups(docs, doc_id, text, **options)
    # A text with a made node may have a smaller id than its group's other nodes.
    made = classes.where(F.col("node") >= MADE_ID).groupBy("component").agg(F.min("first").alias("_least"))
    classes = classes.join(made.hint("merge"), "component", "left")
    classes = classes.select(
        "m",
        F.least(F.when(F.col("component") < MADE_ID, F.col("component")), "_least").alias("class_id"),
        F.when(F.col("node") == F.col("component"), F.struct("first")).alias("_stands"),
    )
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("m"))
    kept = F.col("_stands").isNotNull() & F.col("doc_id").eqNullSafe(F.col("_stands.first"))
    return rows.join(classes, "m").select("doc_id", "class_id", kept.alias("kept"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their near-duplicate group, one for each group, with all columns.

    Which one of several rows with the same id and text stays is left open where they differ in other columns only.
    """
    classes = near_groups(docs, doc_id, text, **options)
    stands = classes.where("node = component").select(F.col("m").alias("_m"), F.col("first").alias("_first"))
    key = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_m"), F.col(f"`{doc_id}`").cast("long").alias("_id"))
    row = row.join(stands.hint("merge"), "_m").where(F.col("_id").eqNullSafe(F.col("_first")))
    return row.groupBy("_m").agg(F.first("_row").alias("_row")).select("_row.*")
