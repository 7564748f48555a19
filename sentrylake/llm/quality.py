"""Line-first quality rules, in native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.common import SPACE, SPACES, let, words

SYMBOLS = "#*$%&|<>"
# Openings of lines that carry notices instead of prose.
BOILERPLATE = (
    "licensed under|released under the|this work is licensed|all rights reserved|copyright \\(c\\)|terms of (use|service)|"
    "privacy policy|cookie policy|accept cookies|uses cookies|enable javascript|lorem ipsum|click here|sign up for|subscribe to"
)
NAVIGATION = "(?i)^[\\x20\\x09]*(home|menu|next|previous|back to top|log ?in|sign in|share|skip to content)[\\x20\\x09>|.]*$"


def symbol_count(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def line_fails(line: Column, symbols_per_word: float = 0.2, short: int = 4) -> Column:
    """The rules for one line that has a word.

    * punctuation: more than ``symbols_per_word`` symbols a word (bars between items count), or all in
      capitals over more than two words, or ``short`` words or fewer without an end mark;
    * navigation: a menu word alone in its line;
    * boilerplate: a licence, cookie or policy notice.
    """
    n = F.size(words(line))
    ends = line.rlike("[.!?:;…\"'”»)\\]][\\x20\\x09\\x0B-\\x0D]*$")
    return (
        (symbol_count(line) > n * F.lit(symbols_per_word))
        | ((n > 2) & (F.upper(line) == line) & (F.lower(line) != line))
        | ((n <= short) & ~ends)
        | line.rlike(NAVIGATION)
        | line.rlike("(?i)" + BOILERPLATE)
    )


def repeated_words(tokens: Column) -> Column:
    """Words of a text that lie in a three-word window found twice or more."""

    def covered(hashes: Column) -> Column:
        # Equal windows meet by sorting; their places, sorted again, each add the words not yet counted.
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            same = lambda x, j: (F.get(p, j - 1)["h"] == x["h"]) | (F.get(p, j + 1)["h"] == x["h"])
            return F.array_sort(F.transform(F.filter(p, lambda x, j: F.coalesce(same(x, j), F.lit(False))), lambda x: x["i"]))

        def total(at: Column) -> Column:
            return F.aggregate(
                F.transform(at, lambda x, j: F.coalesce(F.least(F.lit(3), F.get(at, j + 1) - x), F.lit(3))), F.lit(0), lambda s, x: s + x
            )

        return let(pairs, lambda p: let(places(p), total))

    def of(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
        counted = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
        return F.when(F.size(w) >= 4, counted).otherwise(0)

    return let(tokens, of)


def quality_rules(docs: DataFrame, text: str = "text", max_lost: float = 0.3, min_words: int = 50) -> DataFrame:
    """Adds the measures, ``clean_text`` (the lines that pass) and ``kept`` to every row.

    A document is kept if it has ``min_words`` words, at most half of them in repeated three-word
    windows, and its failing lines hold at most ``max_lost`` of its words. A null text has no words and is
    rejected, as is an empty one. Columns of the input that bear a new name are replaced; other columns,
    nulls in them and repeated rows pass through. No shuffle, no Python.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(body, "\n", -1)
    has_word = lambda l: l.rlike("[^\\x20\\x09-\\x0D]")
    with_words = F.filter(lines, has_word)
    # A row is worked on in three steps, each of which computes its arrays once.
    step = docs.withColumns(
        {
            "word_chars": F.length(F.translate(body, SPACES, "")).cast("long"),
            "n_symbols": symbol_count(body).cast("long"),
            "n_dup_lines": let(with_words, lambda l: F.size(l) - F.size(F.array_distinct(l))).cast("long"),
            "_words": let(words(body), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("r"))),
            "clean_text": let(lines, lambda ls: F.array_join(F.filter(ls, lambda l: ~(has_word(l) & line_fails(l))), "\n")),
        }
    )
    step = step.withColumns({"n_words": F.col("_words.n"), "n_repeat_words": F.col("_words.r")})
    left = F.size(F.filter(F.split("clean_text", SPACE), lambda w: w != "")).cast("long")
    step = step.withColumns({"n_lost_words": F.col("n_words") - left})
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return step.withColumns(
        {"base_failed": failed, "kept": ~failed & (F.col("n_lost_words") <= F.col("n_words") * F.lit(max_lost))}
    ).drop("_words")
