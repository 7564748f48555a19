"""Nearest vectors and nearest texts to a query.

The query is one vector or one text, so the table is scanned once, every row is scored where it
lies, and only each task's top rows travel.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.functions.scalar import clamp01, cosine_to
from sentrylake.functions.text import truncate_summary

# Default and largest number of matches.
DEFAULT_MATCHES = 5
MAX_MATCHES = 20

WORD = r"[a-z0-9]+"


def similar_events(
    vectors: DataFrame, query: list[float], k: int = 10, key: str = "event_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` vectors most similar to the query by cosine, the query's own row included."""
    scored = vectors.select(key, cosine_to(vector, query).alias("similarity"))
    return scored.orderBy(F.desc("similarity"), F.asc(key)).limit(k)


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def damped(n: Column) -> Column:
    return 1 + F.log(n.cast("double"))


def vector_length(words: Column) -> Column:
    """Norm of the damped word counts: sorted words are counted run by run in one pass."""
    closed = lambda a: a["sum"] + F.when(a["run"] > 0, F.pow(damped(a["run"]), 2)).otherwise(0.0)
    start = F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))

    def count(a: Column, word: Column) -> Column:
        same = a["word"] == word
        return F.struct(
            word.alias("word"),
            F.when(same, a["run"] + 1).otherwise(1).alias("run"),
            F.when(same, a["sum"]).otherwise(closed(a)).alias("sum"),
        )

    return F.sqrt(F.aggregate(F.array_sort(words), start, count, closed))


def _times(words: str, word: str) -> Column:
    return F.size(F.filter(words, lambda x: x == word))


def match_threat_intel(intel: DataFrame, query: str, top_k: int = DEFAULT_MATCHES) -> DataFrame:
    """The intelligence entries whose description is nearest to a text.

    Cosine of damped word counts, with the query's words weighted by how rare they are in the
    table (the lnc.ltc weighting of text retrieval). Rarity is only needed for the query's words, so
    the first pass counts those and the second scores each row by itself; whole texts count.
    """
    top_k = max(1, min(MAX_MATCHES, top_k))
    asked = Counter(re.findall(WORD, query.lower()))
    terms = sorted(asked)
    words = intel.withColumn("_words", words_of(F.col("description")))
    # The query's words within the text, with repeats.
    words = words.withColumn("_hits", F.filter("_words", lambda x: x.isin(terms)))
    seen_in = [F.count_if(F.array_contains("_hits", t)).alias(f"t{i}") for i, t in enumerate(terms)]
    n, *df = words.agg(F.count("*"), *seen_in).first()
    weights = {t: (1 + math.log(asked[t])) * math.log(n / d) for t, d in zip(terms, df) if d}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    score = F.lit(0.0)
    if norm:
        for t, w in weights.items():
            times = _times("_hits", t)
            score = score + F.when(times > 0, damped(times) * (w / norm)).otherwise(0.0)
        score = F.coalesce(F.try_divide(score, vector_length(F.col("_words"))), F.lit(0.0))
    return (
        words.select(
            F.col("id").alias("threat_id"),
            "description",
            F.round(score, 4).alias("similarity"),
            F.coalesce("category", F.lit("unknown")).alias("category"),
            F.coalesce("severity", F.lit("unknown")).alias("severity"),
            "mitre_attack",
        )
        .orderBy(F.desc("similarity"), F.asc("threat_id"))
        .limit(top_k)
    )


def intel_records(matches: DataFrame) -> DataFrame:
    """Matches as the assistant lists them: source, shortened summary, relevance."""
    return matches.select(
        F.col("category").alias("source"),
        truncate_summary("description").alias("summary"),
        clamp01("similarity").alias("relevance_score"),
    )
