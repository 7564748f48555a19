"""Helpers that the operators share: words, row keys, checkpoints and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sentrylake.session import materialize

# White space as the contracts have it: the blank and the characters 9 to 13.
SPACE = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Runs of characters other than white space, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, even where ``body`` uses it within a lambda."""
    return F.transform(F.array(value), body)[0]


# Bytes of rows that one task writes of a table of short rows.
TASK_BYTES = 4 << 20


def cut(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """The same rows, read back from the shared checkpoint folder.

    ``most``: bytes that the rows have at most, before compression. A small table is then written by few tasks, at least one
    for each core: where the folder is a local one, an executor starts processes to set the rights of each file and its folder.
    """
    if most is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-most // TASK_BYTES)))
    return materialize(df, name)


def watched(df: DataFrame, name: str, *metrics: Column, most: int | None = None) -> tuple[DataFrame, dict]:
    """``cut`` with metrics of the rows, counted by the job that writes them."""
    seen = Observation()
    df = cut(df.observe(seen, *metrics), name, most)
    return df, seen.get


def roots(parents: DataFrame, nodes: int | None = None) -> DataFrame:
    """``node, component`` of a forest given as ``node, parent`` with one row per node that has a parent.

    Each round links every node to its parent's parent, so it takes as many rounds as the depth has binary digits.
    ``nodes``: how many there are at most.
    """
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above")).hint("merge")
        step = parents.join(above, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"), "above")
        most = nodes if nodes is None else 24 * nodes
        step, seen = watched(step, "roots", F.count("above").alias("moved"), F.count(F.lit(1)).alias("n"), most=most)
        parents, nodes = step.drop("above"), seen["n"]
        if not seen["moved"]:
            return parents.withColumnRenamed("parent", "component")


def components(links: DataFrame, a: str = "a", b: str = "b", most: int | None = None) -> DataFrame:
    """Connected components of undirected links: ``node`` and ``component``, its smallest node.

    Every round links each node's larger neighbours to its smallest one, and then each node to the
    smallest of its not larger neighbours; a component ends as a star. Both steps keep the number of
    links and work without collecting a node's neighbours. Nodes without a link are not returned. ``most``: how many
    links there are at most.
    """
    spark = links.sparkSession
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    count = F.count(F.lit(1)).alias("n")
    edges, state = watched(edges, "links", count, most=most if most is None else 16 * most)
    n = state["n"]

    def stars(e: DataFrame) -> DataFrame:
        # Large star: both directions; every larger neighbour goes to the smallest of the neighbourhood.
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: each node's smallest neighbour takes the node and its other smaller neighbours.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return rest.unionAll(low.select("u", F.col("m").alias("v"))).distinct()

    mark = None
    while True:
        digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest")
        edges, state = watched(stars(edges), "links", count, digest, most=16 * n)
        if state == mark:
            break
        mark = state
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

