"""Removal of repeated line runs with a suffix array over line ids, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sentrylake.llm.common import SPACE, cut, watched

PLACE = ["d", "t", "i"]


def _lines(docs: DataFrame, text: str) -> DataFrame:
    """One row per line with a word: row key ``d, t``, number ``i`` among these lines, ``i0`` among all."""
    body = F.coalesce(F.col(text), F.lit(""))
    split = F.transform(F.split(body, "\n", -1), lambda l, i: F.struct(l.alias("l"), i.alias("i0")))
    with_words = F.filter(split, lambda x: x["l"].rlike("[^\\x20\\x09-\\x0D]"))
    rows = docs.select("d", "t", F.posexplode(with_words).alias("i", "x"))
    return rows.select(
        *PLACE,
        F.col("x.i0").alias("i0"),
        F.xxhash64("x.l").alias("h"),
        F.hash("x.l").alias("g"),
        F.size(F.filter(F.split("x.l", SPACE), lambda w: w != "")).alias("w"),
    )


def _ranked(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is found at two places or more, with the first of them as the rank ``r``.

    The groups are reduced in every task before the shuffle, and the join back is one that Spark splits
    where a key is hot.
    """
    place = F.struct(*PLACE)
    ranks = rows.groupBy(*key).agg(F.min(place).alias("r"), F.max(place).alias("_last")).where("r < _last").drop("_last")
    return rows.join(ranks, key).drop(*key)


def _shift(rows: DataFrame, by: Column, **names: str) -> DataFrame:
    """Ranks keyed by the place ``by`` lines before their own."""
    return rows.select("d", "t", (F.col("i") - by).alias("i"), *[F.col(k).alias(v) for k, v in names.items()])


def suffix_ranks(lines: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Prefix doubling: ``(places, levels, n)``; n is the number of places.

    Level k ranks the blocks of 2^k lines that occur twice or more; two places have the same rank there
    just if their suffixes share a prefix of 2^k lines, that is, lie in one longest-common-prefix interval of
    that depth. A rank is the first place of its interval. A level is made from the one before by ranking
    pairs (rank here, rank 2^k lines on), and only repeated blocks go on, so levels shrink quickly.
    """
    first, seen = watched(_ranked(lines, ["h", "g"]).dropDuplicates(PLACE), "lines", F.count(F.lit(1)).alias("n"))
    n = seen["n"]
    level, levels, k = first.select(*PLACE, "r"), [], 0
    while not level.isEmpty():
        levels.append(level.withColumn("k", F.lit(k)))
        pairs = level.join(_shift(level, F.lit(1 << k), r="r2"), PLACE).withColumnRenamed("r", "r1")
        level, k = cut(_ranked(pairs, ["r1", "r2"]), "ranks", 40 * n), k + 1
    every = levels[0] if levels else level.withColumn("k", F.lit(0))
    for one in levels[1:]:
        every = every.unionByName(one)
    return first, every, n


def _least_runs(places: DataFrame, min_words: int) -> DataFrame:
    """For each place the shortest run of ``min_words`` words that starts there, and that ends there.

    Within a stretch of neighbouring repeated lines, b words come before a line and c up to its end. The run
    that starts at a line ends at the first line with c >= its b + min_words: read down the values of c and of
    those sums in falling order, and the last c seen is it. The other side is the mirror image.
    """
    by_doc = W.partitionBy("d", "t").orderBy("i")
    stretch = W.partitionBy("d", "t", "s").orderBy("i")
    p = places.withColumn("s", F.col("i") - F.row_number().over(by_doc))
    p = p.withColumn("c", F.sum(F.col("w").cast("long")).over(stretch)).withColumn("b", F.col("c") - F.col("w"))
    at = F.array(
        F.struct(F.col("c").alias("v"), F.lit(1).alias("side"), F.col("i").alias("mark"), F.lit(None).cast("int").alias("ask")),
        F.struct((F.col("b") + min_words).alias("v"), F.lit(0).alias("side"), F.lit(None).cast("int").alias("mark"), F.col("i").alias("ask")),
    )
    down = W.partitionBy("d", "t", "s").orderBy(F.desc("v"), F.desc("side")).rowsBetween(W.unboundedPreceding, 0)
    starts = p.select("d", "t", "s", F.inline(at)).withColumn("e", F.last("mark", ignorenulls=True).over(down))
    at = F.array(
        F.struct(F.col("b").alias("v"), F.lit(0).alias("side"), F.col("i").alias("mark"), F.lit(None).cast("int").alias("ask")),
        F.struct((F.col("c") - min_words).alias("v"), F.lit(1).alias("side"), F.lit(None).cast("int").alias("mark"), F.col("i").alias("ask")),
    )
    up = W.partitionBy("d", "t", "s").orderBy("v", "side").rowsBetween(W.unboundedPreceding, 0)
    ends = p.select("d", "t", "s", F.inline(at)).withColumn("a", F.last("mark", ignorenulls=True).over(up))
    one = starts.where("ask IS NOT NULL AND e IS NOT NULL").select("d", "t", F.col("ask").alias("i"), "e")
    two = ends.where("ask IS NOT NULL AND a IS NOT NULL").select("d", "t", F.col("a").alias("i"), F.col("ask").alias("e"))
    return one.unionAll(two).distinct()


def repeated_lines(docs: DataFrame, text: str = "text", min_words: int = 50) -> DataFrame:
    """Places of lines to delete: ``d, t, i0``; ``docs`` has the row key ``d, t``.

    A line goes if it lies in a run of lines with ``min_words`` words or more that also occurs earlier (by
    document, then line). Any such run is covered by the shortest long-enough runs that start and end within
    it, so those are looked up: a run of n lines is named by the ranks of the two blocks of 2^k lines, 2^k <= n,
    at its ends, and is a later copy if its name has an earlier place.
    """
    places, levels, count = suffix_ranks(_lines(docs, text))
    runs = _least_runs(places, min_words).withColumn("n", F.col("e") - F.col("i") + 1)
    # n < 2^31, and log2 is exact at powers of two.
    runs = runs.withColumn("k", F.floor(F.log2("n")).cast("int"))
    ranks = levels.select(*PLACE, "k", F.col("r").alias("r1"))
    runs = runs.join(ranks, [*PLACE, "k"])
    ranks = levels.select("d", "t", F.expr("i + shiftleft(1, k) - 1").alias("e"), "k", F.col("r").alias("r2"))
    runs = cut(runs.join(ranks, ["d", "t", "e", "k"]).select(*PLACE, "e", "n", "r1", "r2"), "runs", 2 * 72 * count)
    later = _ranked(runs, ["n", "r1", "r2"]).where(F.struct(*PLACE) > F.col("r"))
    gone = later.select("d", "t", F.explode(F.sequence("i", "e")).alias("i")).distinct()
    return gone.join(places.select(*PLACE, "i0"), PLACE).select("d", "t", "i0")


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """Every row of ``docs`` with ``text`` less its later copies of line runs, ``n_lines`` and ``n_removed``.

    Lines are compared whole, by 96 bits of hashes; lines without a word neither count nor go. Order is by
    ``doc_id`` (null first), then by a hash of the text for rows that share an id. Rows equal in both are one
    document for the comparison, and each gets its result. A null text stays null; an empty table gives an
    empty one. Other columns pass through, whatever their names; ``n_lines`` and ``n_removed`` are replaced.
    """
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    keyed = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("d"),
        F.xxhash64(F.col(text)).alias("t"),
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
    )
    body = keyed.select("d", "t", F.col(f"row.`{text}`").alias("text"))
    gone = repeated_lines(body, "text", min_words).groupBy("d", "t").agg(F.collect_set("i0").alias("gone"))
    has_word = lambda l: l.rlike("[^\\x20\\x09-\\x0D]")
    lines = F.split(F.col(f"row.`{text}`"), "\n", -1)
    left = F.array_join(F.filter(lines, lambda l, i: ~F.array_contains("gone", i)), "\n")
    out = keyed.join(gone, ["d", "t"], "left")
    return out.select(
        *[
            (F.when(F.col("gone").isNull(), F.col(f"row.`{c}`")).otherwise(left) if c == text else F.col(f"row.`{c}`")).alias(c)
            for c in others
        ],
        F.size(F.filter(F.coalesce(lines, F.array()), has_word)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
