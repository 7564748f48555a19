"""Token counts by a map-side lookup in two tiers."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.tokens import BYTE_PATTERN, byte_letters, latin_pattern, tokenizer, unicode_pattern, worker_cache

MAX_CACHED = 600_000


class PreTokens:
    """Splits texts as the byte-level vocabulary's library does, special strings first."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.specials = [a.content for a in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        self.ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
        self.latin, self.beyond = latin_pattern(BYTE_PATTERN), re.compile("[^\\0-\\u024f]")
        self.any = unicode_pattern(BYTE_PATTERN)

    def __call__(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the number of special tokens."""
        if self.special and "<|" in text and self.special.search(text):
            spans = self.special.split(text)
            return [p for s in spans for p in self._split(s)], len(spans) - 1
        return self._split(text), 0

    def _split(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii.findall(text)
        return self.any.findall(text) if self.beyond.search(text) else self.latin.findall(text)


class Lengths(dict):
    """Tokens of a pre-token: a first tier of frequent ones, and what a worker has met besides."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.frequent, self.tokenize = frequent, tokenizer(path).model.tokenize

    def __missing__(self, p: str) -> int:
        if len(self) > MAX_CACHED:
            self.clear()
            self.update(self.frequent)
        n = self[p] = len(self.tokenize(byte_letters(p)))
        return n


def frequent_lengths(docs: DataFrame, path: str, sample_rows: int, max_terms: int) -> dict[str, int]:
    """Lengths of the pre-tokens most frequent in about ``sample_rows`` rows; a table of at most ``max_terms``.

    What it holds decides the speed alone, never a count.
    """
    rows = docs.count()
    share = min(1.0, sample_rows / max(rows, 1))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = PreTokens(path), Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(split(text.as_py() or "")[0])
        best = counts.most_common(max_terms)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())], names=["p", "n"])

    # One row per term that a task found often; a sample of fixed size has few of them.
    found = chosen.select("text").mapInArrow(run, "p string, n long").where("n >= 2")
    total: Counter = Counter()
    for row in found.toLocalIterator():
        total[row["p"]] += row["n"]
    tokenize = tokenizer(path).model.tokenize
    return {p: len(tokenize(byte_letters(p))) for p, _ in total.most_common(max_terms)}


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = 1024,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = 2_000,
    max_terms: int = 32_768,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``, as the library counts.

    Texts are split into pre-tokens and their lengths added up, all in one scan without a shuffle. Null texts
    are empty: 0 bytes and 0 tokens. Ids may be null or repeated, an empty table gives an empty one, and
    columns of other names are not read.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    spark = docs.sparkSession
    # At most max_terms short strings.
    shared, name = spark.sparkContext.broadcast(frequent_lengths(source, path, sample_rows, max_terms)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache()
        if cache.get("lengths for") != name:
            cache["lengths for"] = name
            cache["lengths"], cache["pre-tokens"] = Lengths(path, shared.value), PreTokens(path)
        get, split = cache["lengths"].__getitem__, cache["pre-tokens"]
        for batch in batches:
            sizes, tokens = [], []
            for cell in batch["text"]:
                body = cell.as_py() or ""
                parts, specials = split(body)
                sizes.append(len(body) if body.isascii() else len(body.encode("utf-8", "surrogatepass")))
                tokens.append(sum(map(get, parts)) + specials)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    counted = source.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
