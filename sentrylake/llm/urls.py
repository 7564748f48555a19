"""Verdicts on URLs by host and path rules, found by hash prefixes of host-suffix and path-prefix expressions."""

from __future__ import annotations

import json
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.operators.skew import attach_by_key

PREFIX_BYTES = 4
# Identical rows (same id and URL) are judged once and written again in runs of this many.
RUN = 10_000


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.translate(host, ".", "")) + 1


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, PREFIX_BYTES)


def _digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def rule_index(rules: DataFrame) -> DataFrame:
    """Rules by hash prefix: ``prefix`` and ``entries``, each with the full digest, its precedence and verdict.

    A longer rule (host and path together) goes before a shorter one, then the one with more host labels, then
    a block. Of several rules with the same host and path a block stays. The entries of a prefix are rules whose
    digests agree in 32 bits, so their number is one but for chance.
    """
    host, path = lower_ascii(F.coalesce("host", F.lit(""))), F.coalesce("path", F.lit(""))
    named = rules.select(host.alias("host"), path.alias("path"), (F.col("verdict") == "block").alias("blocks"))
    once = named.groupBy("host", "path").agg(F.max("blocks").alias("blocks"))
    rule = F.concat("host", "path")
    entry = F.struct(
        _digest(rule).alias("digest"),
        F.struct(
            F.length(rule).alias("length"),
            _labels(F.col("host")).alias("labels"),
            F.col("blocks"),
            rule.alias("rule"),
        ).alias("rank"),
    )
    return once.select(_prefix(_digest(rule)).alias("prefix"), entry.alias("entry")).groupBy("prefix").agg(F.collect_list("entry").alias("entries"))


def _shapes(rules: DataFrame) -> Column:
    """Label counts and path lengths that rules have, as a constant: no other expression can meet a rule.

    There are at most as many as label counts times path lengths, however many rules there are.
    """
    labels = _labels(F.coalesce("host", F.lit("")))
    rows = rules.select(labels.alias("k"), F.length(F.coalesce("path", F.lit(""))).alias("p")).distinct().collect()
    return F.from_json(F.lit(json.dumps([{"k": r["k"], "p": r["p"]} for r in sorted(rows)])), "array<struct<k:int,p:int>>")


def expressions(host: Column, path: Column, shapes: Column) -> Column:
    """Host suffixes at label borders, each followed by path prefixes, of the shapes that rules have."""
    fits = F.filter(shapes, lambda s: (s["k"] <= _labels(host)) & (s["p"] <= F.length(path)))
    return F.transform(fits, lambda s: F.concat(_suffix(host, s["k"]), F.substring(path, F.lit(1), s["p"])))


def _suffix(host: Column, labels: Column) -> Column:
    parts = F.split(host, r"\.", -1)
    return F.array_join(F.slice(parts, F.size(parts) - labels + 1, labels), ".")


def url_verdicts(
    pages: DataFrame,
    rules: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    default: str = "allow",
    broadcast_rules: int = 200_000,
) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict`` (``allow`` or ``block``). A rule fits its host and all subdomains if the
    URL's path starts with the rule's; of the fitting rules the longest decides, and without one ``default`` does.

    Each URL is expanded into the host suffixes and path prefixes that some rule could equal. Their SHA-256
    prefixes of four bytes are joined with those of the rules; a hit counts if the whole digests agree. Up to
    ``broadcast_rules`` rules (counted first, about 100 bytes each) are sent to all tasks; more are shuffled, with
    the expressions that many URLs share (a common host) split over several tasks.

    Rows are grouped by id and URL, so equal rows are judged once and come back as often as they occur. A null or
    malformed URL has an empty host and path and gets ``default``; ids may be null or repeated. URLs of any length
    are judged whole. Equally long rules: more host labels first, then a block. An empty table gives an empty one, an
    empty rule list gives ``default``; columns of other names are not read.
    """
    index = rule_index(rules)
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    rows = rows.groupBy("page_id", "url").agg(F.count("*").alias("n"))
    host, path = host_and_path(F.col("url"))
    wanted = rows.withColumns({"host": host, "path": path})
    wanted = wanted.withColumn("expression", F.explode_outer(expressions(F.col("host"), F.col("path"), _shapes(rules))))
    wanted = wanted.withColumn("digest", _digest(F.col("expression"))).drop("expression")
    wanted = wanted.withColumn("prefix", _prefix(F.col("digest")))
    if rules.count() <= broadcast_rules:
        met = wanted.join(F.broadcast(index), "prefix", "left")
    else:
        sizes = wanted.groupBy("prefix").agg(F.count("*").alias("uses"))
        met = attach_by_key(wanted, index, ["prefix"], "uses", "url", "left", sizes)
    sure = F.filter("entries", lambda e: e["digest"] == F.col("digest"))
    best = met.withColumn("rank", F.get(sure, F.lit(0))["rank"]).groupBy("page_id", "url").agg(F.first("n").alias("n"), F.max("rank").alias("rank"))
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / RUN)), lambda i: F.least(F.lit(RUN), F.col("n") - i * RUN))
    best = best.withColumn("run", F.explode(runs)).hint("rebalance")
    out = best.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("run"))))
    verdict = F.when(F.col("rank").isNull(), F.lit(default)).when(F.col("rank.blocks"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", host.alias("host"), path.alias("path"), F.col("rank.rule").alias("rule"), verdict.alias("verdict"))
