"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.common import cut

WORD = re.compile(r"[^\W\d_]+")
NO_LETTER = re.compile(r"[\W\d_]")
# What may stand between two letters of a disguised word.
INNER = re.compile(r"[0-9@$!*.|_\-]+")
VISIBLE = re.compile(r"\S*")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
# Characters that stand for letters, and words for the one spoken to.
STANDS_FOR = str.maketrans("013457@$!|", "oieastasil")
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi vous votre vos du dich dir dein deine sie ihr usted ustedes tú ti".split())
STEMS = (4, 5, 6)
FEATURES = (
    "log_words", "word_density", "word_best", "word_hits", "word_kinds", "stem_density", "stem_best", "stem_hits", "stem_kinds",
    "second_person", "near_second_person", "nearest_second_person", "capitals", "capital_words", "exclamations", "questions",
    "punctuation", "symbols", "digits", "disguised", "disguised_hits", "stretched", "mean_word", "unique_words",
)


def stems(word: str) -> list[str]:
    """Beginnings of a word that leave two letters or more; marked so that they differ from words."""
    return [word[:n] + "-" for n in STEMS if len(word) >= n + 2]


def plain(token: str) -> str:
    return "".join(filter(str.isalpha, token.translate(STANDS_FOR)))


# Bytes of UTF-8; those from 128 on belong to characters beyond ASCII.
ASCII = bytes(range(128))
UPPER = bytes(range(65, 91))
MARKS = b".,;:!?\"'()[]-"
BLANKED = bytes(i if i > 127 or chr(i).isalpha() else 32 for i in range(256))
# Kinds of characters that are replaced one by one before the expression for words is the shorter way.
FEW_KINDS = 8


def coded(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def uncoded(code: bytes) -> str:
    return code.decode("utf-8", "surrogatepass")


def blanked(text: str) -> str:
    """The text with blanks for all that is no letter, so that its parts are what ``WORD`` finds.

    ASCII goes by a table of bytes; of the other characters only the kinds that occur are looked at.
    """
    if text.isascii():
        return coded(text).translate(BLANKED).decode("ascii")
    code = coded(text)
    kinds = NO_LETTER.findall("".join(set(uncoded(code.translate(None, ASCII)))))
    if len(kinds) > FEW_KINDS:
        return " ".join(WORD.findall(text))
    text = uncoded(code.translate(BLANKED))
    for c in kinds:
        text = text.replace(c, " ")
    return text


def stretches(text: str) -> int:
    """Letters that stand three times in a row, in a text from ``blanked``; most texts have none."""
    code = coded(text)
    x = np.frombuffer(code, np.uint8)
    same = x[1:] == x[:-1]
    thrice = same[1:] & same[:-1] & (x[2:] != 32)
    if thrice.any() or (not text.isascii() and STRETCHED.search(uncoded(code.translate(None, ASCII)))):
        return len(STRETCHED.findall(text))
    return 0


def disguised_words(text: str) -> list[str]:
    """Runs of visible characters with a letter, marks or digits, and a letter again."""
    found, end = [], 0
    for m in INNER.finditer(text):
        a, z = m.span()
        if end < a and text[z : z + 1].isalnum() and not NO_LETTER.match(text, z) and not NO_LETTER.match(text, a - 1):
            first, end = text[end:a].rsplit(None, 1)[-1], VISIBLE.match(text, a).end()
            found.append(first + text[a:end])
    return found


@dataclass
class Lexicon:
    """Terms (words, and stems ending in a hyphen) with the documents of either label they are in."""

    toxic: dict[str, int] = field(default_factory=dict)
    clean: dict[str, int] = field(default_factory=dict)
    n_toxic: int = 0
    n_clean: int = 0
    least: float = 1.5

    def weight(self, term: str, label: int | None = None) -> float:
        """Log odds of a term, at least 0; without the document at hand if its label is given."""
        t, c, n, m = self.toxic[term], self.clean.get(term, 0), self.n_toxic, self.n_clean
        if label == 1:
            t, n = t - 1, n - 1
        elif label == 0:
            c, m = max(c - 1, 0), m - 1
        w = np.log((t + 0.5) / (n + 1)) - np.log((c + 0.5) / (m + 1))
        return float(w) if w > self.least and t > 0 else 0.0

    def weights(self, label: int | None = None) -> dict[str, float]:
        """The terms with a weight above 0, for texts with this label or without one."""
        found = {t: self.weight(t, label) for t in self.toxic}
        return {t: x for t, x in found.items() if x > 0}


def beginnings(weights: dict[str, float]) -> frozenset[str]:
    """First letters of the stems among the terms; a word that begins otherwise has no such stem."""
    return frozenset(t[: STEMS[0]] for t in weights if t.endswith("-"))


def features(text: str | None, weights: dict[str, float], begins: frozenset[str]) -> list[float]:
    """The dense features of one text, by the weights of terms (all above 0) and their ``beginnings``."""
    text = text or ""
    low = text.lower()
    spaced = blanked(low)
    words = spaced.split()
    n, chars = max(len(words), 1), max(len(text), 1)
    kinds = set(words)
    hit = {w: weights[w] for w in kinds if w in weights}
    stem_hit = {}
    for w in kinds:
        if w[: STEMS[0]] in begins and len(w) >= STEMS[0] + 2 and w not in hit:
            best = max((weights[s] for s in stems(w) if s in weights), default=0.0)
            if best > 0:
                stem_hit[w] = best
    marked = hit.keys() | stem_hit.keys()
    counts = Counter(filter(marked.__contains__, words)) if marked else Counter()
    addressed = kinds & SECOND_PERSON
    at = list(compress(range(len(words)), map(addressed.__contains__, words))) if addressed else []
    near = nearest = 0.0
    if at and marked:
        places = np.array(list(compress(range(len(words)), map(marked.__contains__, words))))
        spot = np.searchsorted(at, places)
        a = np.array([-(10**6), *at, 10**6])
        gap = np.minimum(places - a[spot], a[spot + 1] - places)
        near, nearest = float((gap <= 5).sum()), 1.0 / (1.0 + float(gap.min()))
    disguised = disguised_words(text)
    found = sum(plain(t.lower()) in weights for t in disguised)
    code = coded(text)
    capitals = len(code) - len(code.translate(None, UPPER)) if low != text else 0
    if low != text and not text.isascii():
        capitals += sum(map(str.isupper, uncoded(code.translate(None, ASCII))))
    marks = len(code) - len(code.translate(None, MARKS))
    return [
        np.log1p(len(words)),
        sum(counts[w] * x for w, x in hit.items()) / n,
        max(hit.values(), default=0.0),
        sum(counts[w] for w in hit),
        len(hit),
        sum(counts[w] * x for w, x in stem_hit.items()) / n,
        max(stem_hit.values(), default=0.0),
        sum(counts[w] for w in stem_hit),
        len(stem_hit),
        len(at) / n,
        near / n,
        nearest,
        capitals / chars,
        sum(1 for w in text.split() if len(w) > 2 and w.isupper()) / n if capitals > 0.1 * chars else 0.0,
        text.count("!") / chars,
        text.count("?") / chars,
        marks / chars,
        sum(map(text.count, "#*$%&@|")) / chars,
        sum(map(text.count, "0123456789")) / chars,
        len(disguised) / n,
        found,
        stretches(spaced) / n,
        (len(spaced) - spaced.count(" ")) / n,
        len(kinds) / n,
    ]


@dataclass
class Trees:
    """Boosted trees of one depth on binned features; a tree is a heap of (feature, bin) with leaf values."""

    edges: list[np.ndarray]
    base: float
    splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins, out, rows = self.binned(x), np.full(len(x), self.base), np.arange(len(x))
        for feature, cut_at, leaf in self.splits:
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                node = 2 * node + 1 + (bins[rows, feature[node]] > cut_at[node])
            out += leaf[node - (len(leaf) - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; a thousandth of it keeps the order within a step of the calibration."""
        m = self.margin(x)
        p = 1 / (1 + np.exp(-m))
        if self.steps is None:
            return p
        return 0.999 * np.interp(m, *self.steps) + 0.001 * p


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss with histograms."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(x.shape[1])]
    edges = [e if len(e) > 1 else np.unique(np.append(e, (x[:, j].min() + x[:, j].max()) / 2)) for j, e in enumerate(edges)]
    rate_y = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model = Trees(edges, float(np.log(rate_y / (1 - rate_y))), [])
    b, (n, k) = model.binned(x), x.shape
    width = bins + 1
    cell = b + np.arange(k) * width
    margin = np.full(n, model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, cut_at = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, width, np.int64)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (k * width) + cell).ravel()
            size = count * k * width
            gs = np.bincount(at, np.repeat(g, k), size).reshape(count, k, width).cumsum(axis=2)
            hs = np.bincount(at, np.repeat(h, k), size).reshape(count, k, width).cumsum(axis=2)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
            gain[(hs < 0.5) | (ht - hs < 0.5)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            good = gain.reshape(count, -1)[np.arange(count), best] > 1e-6
            feature[first : first + count] = np.where(good, best // width, 0)
            cut_at[first : first + count] = np.where(good, best % width, width)
            node = 2 * node + 1 + (b[np.arange(n), feature[node]] > cut_at[node])
        leaves = node - (2**depth - 1)
        value = rate * np.bincount(leaves, g, 2**depth) / (np.bincount(leaves, h, 2**depth) + ridge)
        model.splits.append((feature, cut_at, value))
        margin += value[leaves]
    return model


def isotonic(m: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the rising step function nearest to ``y``, as points to interpolate."""
    order = np.argsort(m, kind="stable")
    blocks: list[list[float]] = []  # sum, weight, first and last margin
    for value, target in zip(m[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([target, 1.0, value, value])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w
            blocks[-1][3] = last
    xs = [v for s, w, a, z in blocks for v in (a, z)]
    ys = [v for s, w, a, z in blocks for v in ((s + 0.02) / (w + 0.04),) * 2]
    return np.array(xs), np.maximum.accumulate(np.array(ys))


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    """Rows of which no label is used; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(True))


def learn_lexicon(sample: DataFrame, max_terms: int) -> Lexicon:
    """Terms of the labelled rows: counted in tasks, reduced on the cluster, at most ``max_terms`` kept."""

    def terms_of(text: str | None) -> set[str]:
        kinds = set(blanked((text or "").lower()).split())
        return kinds | {s for w in kinds for s in stems(w)}

    def count(label: int, wanted: set[str] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()
            for batch in batches:
                for text, toxic in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
                    if toxic == label:
                        terms = terms_of(text.as_py())
                        counts.update(terms & wanted if wanted is not None else terms)
                if len(counts) > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()))], names=["term", "n"])
                    counts.clear()
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

        rows = sample.select("text", "toxic").mapInArrow(run, "term string, n long")
        return rows.groupBy("term").agg(F.sum("n").alias("n"))

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    often = count(1, None).where("n >= 2").orderBy(F.desc("n"), "term").limit(10 * max_terms)
    toxic = {r["term"]: r["n"] for r in often.collect()}
    clean = {r["term"]: r["n"] for r in count(0, set(toxic)).collect()} if toxic else {}
    lexicon = Lexicon(toxic, clean, sizes.get(1, 0), sizes.get(0, 0))
    strong = [t for t in toxic if lexicon.weight(t) > 0]
    strong = sorted(strong, key=lambda t: (-toxic[t] * lexicon.weight(t), t))[:max_terms]
    return Lexicon({t: toxic[t] for t in strong}, {t: clean[t] for t in strong if t in clean}, lexicon.n_toxic, lexicon.n_clean)


def learn(sample: DataFrame, max_terms: int = 4000) -> tuple[Lexicon, Trees | None]:
    """A lexicon and calibrated trees from labelled rows ``text, toxic``; no trees if a label is missing.

    A training row's features leave the row itself out of the lexicon's counts, so they look like those of
    an unseen row. Every fourth row calibrates trees grown on the others.
    """
    lexicon = learn_lexicon(sample, max_terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {}
        for batch in batches:
            labels = batch["toxic"].to_pylist()
            for y in set(labels) - tables.keys():
                weights = lexicon.weights(y)
                tables[y] = weights, beginnings(weights)
            rows = [features(t.as_py(), *tables[y]) for t, y in zip(batch["text"], labels, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["toxic"], pa.array(rows, pa.list_(pa.float64()))], names=["id", "y", "x"])

    # At most as many rows as the sample has, of two dozen numbers each.
    rows = sample.mapInArrow(run, "id long, y int, x array<double>").toPandas().sort_values("id", kind="stable")
    if rows["y"].nunique() < 2:
        return lexicon, None
    x, y = np.array(rows["x"].tolist()), rows["y"].to_numpy(float)
    fourth = np.arange(len(y)) % 4 == 3
    grow = ~fourth if len(set(y[~fourth])) == 2 else np.ones(len(y), bool)
    trees = boost(x[grow], y[grow])
    if len(set(y[fourth])) == 2:
        trees.steps = isotonic(trees.margin(x[fourth]), y[fourth])
    return lexicon, trees


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", max_rows: int = 20_000, limit: float = 0.7
) -> DataFrame:
    """Every row of ``docs`` with ``held_out``, ``score`` (0 to 1) and ``predicted`` (score >= ``limit``).

    Labels are taken from rows that are not held out; at most ``max_rows`` of them, those with the smallest
    hashes of their ids, fit the model. Scores use the text alone, so copies get one score; a null text is an
    empty one. Without rows of both labels all scores are 0. An id with several labels counts with the largest; a
    null id or label teaches nothing. Other columns pass through; the three new ones are replaced.
    """
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    ids = docs.select(F.col(doc_id).cast("long").alias("id"))
    known = known.join(ids.distinct(), "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    # The chosen ids are bounded by max_rows, so they may be broadcast.
    sample = cut(texts.join(F.broadcast(cut(known, "known")), "id").repartition(32, F.xxhash64("id", "text")), "labelled")
    lexicon, trees = learn(sample)
    weights = lexicon.weights()
    spark = docs.sparkSession
    # Plain values: broadcasts name classes instead of sending them.
    fields = lambda x: x and {f: getattr(x, f) for f in x.__dataclass_fields__}
    model = spark.sparkContext.broadcast((weights, beginnings(weights), fields(trees)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, begins, grown = model.value
        trees = grown and Trees(**grown)
        for batch in batches:
            cells = batch.column(batch.schema.get_field_index("_text")).to_pylist()
            if trees is None or not cells:
                scores = np.zeros(len(cells))
            else:
                scores = trees.score(np.array([features(t, weights, begins) for t in cells]))
            keep = [c for c in batch.schema.names if c != "_text"]
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(scores)], names=[*keep, "_score"])

    others = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(text).alias("_text"))
    kinds = row.select("row").schema.add("_score", "double")
    scored = row.mapInArrow(run, kinds)
    return scored.select(
        *[F.col(f"row.`{c}`").alias(c) for c in others],
        held_out(F.col(f"row.`{doc_id}`")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= limit).cast("int").alias("predicted"),
    )
