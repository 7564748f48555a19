"""An inverted index over stored threat intelligence: postings by term, kept up by the intel merge.

Beside the table lies ``<table>.terms`` with a row for each word of each entry: the damped count of the word, the length of
the entry's vector and the entry's id, in folders by segment and a hash of the term, sorted by term within a file. A merge
adds one segment with the postings of its own entries; entries that were known before are listed in
``<table>.replaced`` with the segment that replaced them, so nothing is rewritten until many segments have come together.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.operators.similarity import DEFAULT_MATCHES, MAX_MATCHES, WORD, damped, words_of
from sentrylake.session import materialize
from sentrylake.sources.writers import read_note, read_stored, remove_path, write_note, write_threat_intel

# Terms are spread over this many folders; a question opens those of its own terms.
TERM_FOLDERS = 64
# A merge that would make more segments than this writes one new segment for all entries instead.
MAX_SEGMENTS = 8

_POSTINGS = "term string, weight double, length double, id string, segment int, folder int"


def _folder(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(TERM_FOLDERS)).cast("int")


def postings(entries: DataFrame) -> DataFrame:
    """``term, weight, length, id``: one row per word of an entry, counted within the entry, so nothing is shuffled."""
    words = F.array_sort(words_of(F.coalesce("description", F.lit(""))))
    words = entries.select(F.col("id").cast("string").alias("id"), words.alias("words")).where(F.size("words") > 0)
    word = lambda at: F.element_at("words", at.cast("int"))
    # Where a run of equal words starts in the sorted list, and one place beyond the list.
    first = F.filter(F.sequence(F.lit(1), F.size("words")), lambda at: (at == 1) | (word(at) != word(F.greatest(at - 1, F.lit(1)))))
    runs = words.withColumn("first", F.array_append(first, F.size("words") + 1))
    weight = lambda at, i: damped(F.get("first", i + 1) - at)
    starts = F.slice("first", 1, F.size("first") - 1)
    runs = runs.select("id", F.transform(starts, lambda at, i: F.struct(word(at).alias("term"), weight(at, i).alias("weight"))).alias("terms"))
    # Before the words are listed: the list would otherwise have it computed for each word.
    runs = runs.withColumn("length", F.sqrt(F.aggregate("terms", F.lit(0.0), lambda sum_, t: sum_ + F.pow(t["weight"], 2))))
    # The inner form would have the optimiser filter by the size of the list first, with all of the above computed per word.
    return runs.select("id", "length", F.explode_outer("terms").alias("t")).select("t.term", "t.weight", "length", "id")


def _write_segment(entries: DataFrame, path: str, segment: int) -> None:
    """The segment's postings; a segment that was broken off is written anew."""
    rows = postings(entries).withColumn("folder", _folder(F.col("term")))
    # A very frequent term fills several files of its folder.
    rows = rows.hint("rebalance", "folder").sortWithinPartitions("folder", "term")
    rows.write.mode("overwrite").partitionBy("folder").parquet(f"{path}.terms/segment={segment}")


def index_intel(entries: DataFrame, path: str) -> str:
    """Merge entries (as ``load_threat_intel`` gives them) into the stored table and its index."""
    spark = entries.sparkSession
    entries = materialize(entries, "intel")
    stored = read_stored(spark, path, {"key_folder": "int"})
    state = read_note(spark, f"{path}.index") or {"segments": []}
    segments = state["segments"]
    segment = max(segments, default=-1) + 1
    known = None if stored is None else materialize(stored.select("id").join(entries.select("id"), "id", "left_semi"), "known")
    write_threat_intel(entries, path)
    if stored is not None and (not segments or len(segments) >= MAX_SEGMENTS):
        # All entries in one segment; the older ones are out of use as soon as the note says so.
        _write_segment(read_stored(spark, path, {"key_folder": "int"}), path, segment)
        write_note(spark, f"{path}.index", {"segments": [segment], "replaced": []})
        for old in segments:
            remove_path(spark, f"{path}.terms/segment={old}")
        return path
    _write_segment(entries, path, segment)
    replaced = state.get("replaced", [])
    if known is not None:
        known.select("id").write.mode("overwrite").parquet(f"{path}.replaced/segment={segment}")
        replaced = [*replaced, segment]
    write_note(spark, f"{path}.index", {"segments": [*segments, segment], "replaced": replaced})
    return path


def term_postings(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    """The valid postings of some terms; no other folder or row group of the index is read."""
    state = read_note(spark, f"{path}.index") or {"segments": [], "replaced": []}
    if not state["segments"] or not terms:
        return spark.createDataFrame([], _POSTINGS)
    folders = [r[0] for r in spark.createDataFrame([(t,) for t in terms], "term string").select(_folder(F.col("term"))).distinct().collect()]
    rows = spark.read.schema(_POSTINGS).parquet(f"{path}.terms")
    rows = rows.where(F.col("segment").isin(state["segments"]) & F.col("folder").isin(folders) & F.col("term").isin(terms))
    if state["replaced"]:
        gone = spark.read.schema("id string, segment int").parquet(f"{path}.replaced").where(F.col("segment").isin(state["replaced"]))
        gone = gone.groupBy("id").agg(F.max("segment").alias("_since"))
        rows = rows.join(gone, "id", "left").where("_since IS NULL OR segment >= _since").drop("_since")
    return rows


def match_indexed_intel(spark: SparkSession, path: str, query: str, top_k: int = DEFAULT_MATCHES) -> DataFrame:
    """``match_threat_intel`` over a stored table with its index: the same rows, from the postings of the query's terms.

    Two reads of these postings give how rare the terms are and the entries' scores; texts are read of the matches only.
    Entries with similarity 0, which fill up the list where too few match, are those with the smallest ids.
    """
    top_k = max(1, min(MAX_MATCHES, top_k))
    intel = read_stored(spark, path, {"key_folder": "int"})
    asked = Counter(re.findall(WORD, query.lower()))
    found = term_postings(spark, path, sorted(asked))
    n = intel.count()
    rare = {r["term"]: r["n"] for r in found.groupBy("term").agg(F.count("*").alias("n")).collect()}  # one row per asked term
    weights = {t: (1 + math.log(asked[t])) * math.log(n / d) for t, d in rare.items()}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    ids = intel.select("id", F.lit(0.0).alias("similarity"))
    if norm:
        # In the order of the terms, as the plain form adds them.
        weight = F.lit(0.0)
        for t in sorted(weights):
            weight = F.when(F.col("term") == t, F.lit(weights[t] / norm)).otherwise(weight)
        dots = F.sort_array(F.collect_list(F.struct("term", (F.col("weight") * weight).alias("x"))))  # at most one per asked term
        dot = F.aggregate(dots, F.lit(0.0), lambda a, p: a + p["x"])
        scored = found.groupBy("id").agg(dot.alias("dot"), F.first("length").alias("length"))
        scored = scored.select("id", F.round(F.coalesce(F.try_divide("dot", "length"), F.lit(0.0)), 4).alias("similarity"))
        ranked = scored.orderBy(F.desc("similarity"), "id").limit(top_k).collect()
        best = [(r["id"], r["similarity"]) for r in ranked if r["similarity"] > 0]
    else:
        best = []
    if len(best) < top_k:
        rest = ids.where(~F.col("id").isin([i for i, _ in best])).orderBy("id").limit(top_k - len(best))
        best += [(r["id"], 0.0) for r in rest.collect()]
    # At most twenty rows, whose folders are known.
    scores = spark.createDataFrame(best, "threat_id string, similarity double")
    chosen = intel.where(F.col("id").isin([i for i, _ in best])).select(F.col("id").alias("threat_id"), "description", "category", "severity", "mitre_attack")
    out = chosen.join(F.broadcast(scores), "threat_id")
    return out.select(
        "threat_id",
        "description",
        "similarity",
        F.coalesce("category", F.lit("unknown")).alias("category"),
        F.coalesce("severity", F.lit("unknown")).alias("severity"),
        "mitre_attack",
    ).orderBy(F.desc("similarity"), "threat_id")
