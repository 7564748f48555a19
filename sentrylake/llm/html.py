"""Main text of web pages: a recurrent network labels every text block in the context of its page."""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>?|<[a-zA-Z/][^<]*$", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[a-z]+")
# How HTML treats elements.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template svg iframe object canvas textarea select math".split())
CLOSED_BY_BLOCK = frozenset(("p",))
ALIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Words in class names that the training pages use for either kind of block.
CONTENT_NAMES = "content post entry story main body text page".split()
OTHER_NAMES = (
    "nav menu header footer sidebar aside ad ads advert advertisement banner promo sponsor cookie consent notice alert popup newsletter "
    "subscribe form login search comment comments reply discussion related share social breadcrumb breadcrumbs widget toolbar copyright"
).split()
PATH_DIMS, WORD_DIMS, DENSE = 96, 24, 8


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: float  # share of its characters inside links


def blocks_of(page: str | None) -> list[Block]:
    """Runs of text between block-level tags, in order, with the elements above them.

    References are decoded, white space runs become one blank. Scripts, styles and the like hold no text. Unclosed
    elements end where HTML ends them; a tag that the page breaks off in is dropped.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    path: tuple[str, ...] = ()
    parts: list[str] = []
    links, depth, at = 0, 0, 0

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(path, text, min(1.0, links / len(text))))
            parts.clear()
        links = 0

    def pop_to(index: int) -> None:
        nonlocal path
        del stack[index:]
        path = tuple(n for _, names in stack for n in names)

    for_all = TAG.finditer(page)
    for m in for_all:
        start = m.start()
        if start < at:  # within a hidden element
            continue
        if start > at:
            piece = unescape(page[at:start])
            parts.append(piece)
            links += len(piece.strip()) if depth else 0
        at = m.end()
        if not m[2]:
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name == "a":
            depth = 0 if closing else 1
            continue
        if name == "br" or name in INLINE:
            if name == "br":
                parts.append(" ")
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop_to(i)
                    break
            continue
        if name in VOID:
            continue
        if name in HIDDEN:
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        ends = ALIKE.get(name, ())
        while stack and (stack[-1][0] in CLOSED_BY_BLOCK or stack[-1][0] in ends):
            stack.pop()
        named = [w for g in NAMES.findall(m[3]) for w in PART.findall((g[0] or g[1] or g[2]).lower())] if m[3] else []
        stack.append((name, (name, *named)))
        pop_to(len(stack))
    if at < len(page):
        parts.append(unescape(page[at:]))
    flush()
    return out


class Features:
    """Input vectors of blocks: hashed names of the elements above, hashed words, and a few measures."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.buckets: dict[str, int] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        v = self.paths.get(path)
        if v is None:
            if len(self.paths) > 50_000:
                self.paths.clear()
            v = np.zeros(PATH_DIMS, np.float32)
            for j, name in enumerate(path):
                for token in (name, f"{name}^") if j >= len(path) - 2 else (name,):
                    h = zlib.crc32(token.encode())
                    v[h % PATH_DIMS] += 1.0 if h & 0x10000 else -1.0
            v = self.paths[path] = np.clip(v, -3, 3)
        return v

    def __call__(self, blocks: list[Block]) -> np.ndarray:
        n, buckets = len(blocks), self.buckets
        if len(buckets) > 500_000:
            buckets.clear()
        ids: list[int] = []
        sizes = np.zeros(n, np.int64)
        dense = np.zeros((n, DENSE), np.float32)
        for i, b in enumerate(blocks):
            words = b.text.lower().split()
            sizes[i] = len(words)
            for w in words:
                k = buckets.get(w)
                if k is None:
                    k = buckets[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_DIMS
                ids.append(k)
            t = b.text
            dense[i] = (
                np.log1p(len(words)) / 4, b.linked, t[-1] in ".!?:;\"'…", t.count(",") / (len(words) + 1), "©" in t,
                len(words) <= 3, i / n, (n - i) / n,
            )
        hashed = np.bincount(np.array(ids, np.int64) + np.repeat(np.arange(n) * WORD_DIMS, sizes), minlength=n * WORD_DIMS)
        hashed = hashed.reshape(n, WORD_DIMS) / np.maximum(sizes, 1)[:, None]
        return np.concatenate([np.stack([self.path(b.path) for b in blocks]), hashed.astype(np.float32), dense], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Labeller:
    """A bidirectional LSTM over the blocks of pages, with one output for "main text" per block."""

    def __init__(self, inputs: int, hidden: int = 20, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for d in "fb":
            self.p["wx" + d] = rng.normal(0, 1 / np.sqrt(inputs), (inputs, 4 * hidden)).astype(np.float32)
            self.p["wh" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)
            self.p["b" + d] = np.zeros(4 * hidden, np.float32)
            self.p["b" + d][hidden : 2 * hidden] = 1
        self.p["wo"] = rng.normal(0, 0.3, (2 * hidden, 1)).astype(np.float32)
        self.p["ws"] = rng.normal(0, 0.05, (inputs, 1)).astype(np.float32)  # straight from a block to its label
        self.p["bo"] = np.zeros(1, np.float32)

    def _walk(self, x: np.ndarray, mask: np.ndarray, d: str):
        b, t, _ = x.shape
        k, wh = self.hidden, self.p["wh" + d]
        # One hyperbolic tangent serves all gates: sigmoid(z) = tanh(z / 2) / 2 + 1 / 2.
        half = np.repeat(np.array([0.5, 1.0], np.float32), [3 * k, k])
        step = np.ascontiguousarray(x.transpose(1, 0, 2)).reshape(t * b, -1) @ (self.p["wx" + d] * half) + self.p["b" + d] * half
        step, wh = step.reshape(t, b, 4 * k), wh * half
        h, c = np.zeros((b, k), np.float32), np.zeros((b, k), np.float32)
        hs, cs, masks = np.zeros((t, b, k), np.float32), np.zeros((t, b, k), np.float32), mask.T[:, :, None]
        for s in range(t) if d == "f" else range(t - 1, -1, -1):
            z = step[s]
            z += h @ wh
            np.tanh(z, out=z)
            gate = z[:, : 3 * k]
            gate *= 0.5
            gate += 0.5
            c = masks[s] * (z[:, k : 2 * k] * c + z[:, :k] * z[:, 3 * k :])
            h = z[:, 2 * k : 3 * k] * np.tanh(c)
            hs[s], cs[s] = h, c
        return hs.transpose(1, 0, 2), cs.transpose(1, 0, 2), step.transpose(1, 0, 2)

    def logits(self, x: np.ndarray, mask: np.ndarray):
        f, b = self._walk(x, mask, "f"), self._walk(x, mask, "b")
        return (np.concatenate([f[0], b[0]], 2) @ self.p["wo"] + x @ self.p["ws"] + self.p["bo"])[:, :, 0], f, b

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        out, f, b = self.logits(x, mask)
        d = ((sigmoid(out) - y) * mask / max(mask.sum(), 1))[:, :, None].astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        hs = np.concatenate([f[0], b[0]], 2)
        flat, flat_d = x.reshape(-1, x.shape[2]), d.reshape(-1, 1)
        g["wo"], g["ws"], g["bo"] = hs.reshape(-1, hs.shape[2]).T @ flat_d, flat.T @ flat_d, d.sum(axis=(0, 1))
        dh_all, k, t = d @ self.p["wo"].T, self.hidden, x.shape[1]
        for name, (h_all, c_all, gates), part in (("f", f, slice(0, k)), ("b", b, slice(k, 2 * k))):
            dh, dc = np.zeros((len(x), k), np.float32), np.zeros((len(x), k), np.float32)
            dz_all = np.zeros(gates.shape, np.float32)
            step = -1 if name == "f" else 1
            for s in range(t - 1, -1, -1) if name == "f" else range(t):
                before = s + step
                inside = 0 <= before < t
                c_before = c_all[:, before] if inside else np.zeros_like(dc)
                h_before = h_all[:, before] if inside else np.zeros_like(dh)
                i, fg, o, u = (gates[:, s, j * k : (j + 1) * k] for j in range(4))
                tc, m = np.tanh(c_all[:, s]), mask[:, s, None]
                dh = dh + dh_all[:, s, part]
                dc = (dc + dh * o * (1 - tc**2)) * m
                dz = np.concatenate([dc * u * i * (1 - i), dc * c_before * fg * (1 - fg), dh * tc * o * (1 - o), dc * i * (1 - u**2)], 1)
                dz_all[:, s] = dz
                g["wh" + name] += h_before.T @ dz
                dh, dc = dz @ self.p["wh" + name].T, dc * fg
            g["wx" + name], g["b" + name] = flat.T @ dz_all.reshape(-1, 4 * k), dz_all.sum(axis=(0, 1))
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int, rate: float = 0.01, batch: int = 24, seed: int = 5) -> None:
        """Adam on the cross entropy of the labels."""
        rng = np.random.default_rng(seed)
        m, v, step = {k: np.zeros_like(p) for k, p in self.p.items()}, {k: np.zeros_like(p) for k, p in self.p.items()}, 0
        by_length = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        batches = [by_length[a : a + batch] for a in range(0, len(pages), batch)]
        for epoch in range(epochs):
            for j in rng.permutation(len(batches)):
                x, mask, y = padded([pages[i] for i in batches[j]])
                step += 1
                for k, g in self.gradients(x, mask, y).items():
                    np.clip(g, -1, 1, out=g)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.p[k] -= rate * (1 - epoch / epochs / 1.2) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)

    def labels(self, pages: list[np.ndarray], cells: int = 4096) -> list[np.ndarray]:
        """Whether each block is main text; pages of like length are labelled together."""
        out: list = [np.zeros(0, bool) for _ in pages]
        order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if len(pages[i])]
        while order:
            n = max(1, cells // len(pages[order[0]]))
            some, order = order[:n], order[n:]
            x, mask, _ = padded([(pages[i], np.zeros(len(pages[i]))) for i in some])
            z = self.logits(x, mask)[0]
            for r, i in enumerate(some):
                out[i] = z[r, : len(pages[i])] > 0
        return out


def padded(pages: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t = max(len(y) for _, y in pages)
    x = np.zeros((len(pages), t, pages[0][0].shape[1]), np.float32)
    mask, y = np.zeros((len(pages), t), np.float32), np.zeros((len(pages), t), np.float32)
    for i, (a, b) in enumerate(pages):
        x[i, : len(b)], mask[i, : len(b)], y[i, : len(b)] = a, 1, b
    return x, mask, y


def marked(blocks: list[Block]) -> np.ndarray | None:
    """Labels that a page's own elements give: what is in an article, but in no part of other purpose there."""
    if not any("article" in b.path or "main" in b.path for b in blocks):
        return None
    other = set(OTHER_NAMES)
    has_article = any("article" in b.path for b in blocks)
    inside = [b.path[b.path.index("article" if has_article else "main") :] if ("article" if has_article else "main") in b.path else () for b in blocks]
    return np.array([bool(p) and not other.intersection(p) for p in inside], np.float32)


def made_pages(texts: list[str], count: int, rng: np.random.Generator) -> list[tuple[list[Block], np.ndarray]]:
    """Pages put together from the texts of real ones: main text and other parts in varied elements and order."""

    def sentence(longest: int) -> str:
        words = texts[rng.integers(len(texts))].split()
        n = int(rng.integers(1, longest + 1))
        at = int(rng.integers(max(1, len(words) - n)))
        return " ".join(words[at : at + n])

    def pick(options):
        return options[int(rng.integers(len(options)))]

    def other(base: tuple[str, ...]) -> list[Block]:
        name = pick(OTHER_NAMES)
        tag = pick(["div", "div", "section", "ul", "aside", "nav", "footer", "header", "form"])
        top = base + ((tag, name) if rng.random() < 0.85 or tag in ("div", "section", "ul") else (tag,))
        if rng.random() < 0.4:
            top += (pick(["div", "ul", "section"]), *([pick(OTHER_NAMES + ["item", "box", "inner", "list"])] if rng.random() < 0.5 else []))
        leaf = pick([("p",), ("li",), (), ("div",), ("h", "p"), ("ul", "li"), ("label",)])
        leaf = tuple(pick(["h2", "h3", "h4"]) if t == "h" else t for t in leaf)
        linked = pick([0.0, 0.0, 1.0])
        longest = pick([4, 12, 40, 80])
        sign = "© " if name in ("footer", "copyright") and rng.random() < 0.5 else ""
        return [Block(top + leaf, sign + sentence(longest), linked) for _ in range(int(rng.integers(1, 9)))]

    def content(base: tuple[str, ...]) -> list[Block]:
        out = [Block((*base, pick(["h1", "h1", "h2"])), sentence(14), 0.0)] if rng.random() < 0.8 else []
        for _ in range(int(rng.integers(1, 14))):
            leaf = pick([("p",)] * 6 + [("h2",), ("ul", "li"), ("blockquote", "p"), ("p",), ("pre",), ("table", "tr", "td"), ("div",), ()])
            out.append(Block(base + leaf, sentence(pick([6, 30, 150, 400])), pick([0.0] * 6 + [0.2])))
        return out

    pages = []
    for _ in range(count):
        root = ("html", "body")
        if rng.random() < 0.5:
            root += ("div", *([pick(["page", "wrapper", "container", "site", "main"])] if rng.random() < 0.7 else []))
        main = root + pick(
            [("article",)] * 4 + [("main",), ("main", "article")] + [("div", pick(CONTENT_NAMES)), ("section", pick(CONTENT_NAMES)), ("div", "article")]
        )
        if rng.random() < 0.3:
            main += ("div", pick(CONTENT_NAMES))
        parts = [(b, 0.0) for b in [Block(("html", "head", "title"), sentence(12), 0.0)]]
        for _ in range(int(rng.integers(0, 4))):
            parts += [(b, 0.0) for b in other(root)]
        body = [(b, 1.0) for b in content(main)]
        for _ in range(int(rng.integers(0, 3))):  # parts of other purpose inside the article, and its end
            at = int(rng.integers(1, len(body) + 1))
            body[at:at] = [(b, 0.0) for b in other(main)]
        parts += body
        for _ in range(int(rng.integers(0, 4))):
            parts += [(b, 0.0) for b in other(root)]
        pages.append(([b for b, _ in parts], np.array([y for _, y in parts], np.float32)))
    return pages


def learn_labeller(pages: list[str], made: int = 3000, epochs: int = 10, seed: int = 3) -> Labeller:
    """A labeller from a bounded sample of pages: those that mark their article, and pages made from their texts."""
    features, rng = Features(), np.random.default_rng(seed)
    parsed = [b for b in map(blocks_of, pages) if b]
    texts = [b.text for bs in parsed for b in bs] or ["text"]
    examples = [(bs, y) for bs in parsed if (y := marked(bs)) is not None] + made_pages(texts, made, rng)
    model = Labeller(PATH_DIMS + WORD_DIMS + DENSE)
    # Long pages are learned from in stretches.
    cut = [(features(bs), y) for bs, y in examples]
    cut = [(x[a : a + 60], y[a : a + 60]) for x, y in cut for a in range(0, len(y), 60)]
    model.fit(cut, epochs)
    return model


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", train_pages: int = 300) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars``; the blocks labelled main text, one blank between.

    The labeller learns from at most ``train_pages`` pages, those with the smallest hashes of their ids. A null
    or empty page, and one without main text, has an empty text. Ids and addresses may be null or repeated; an
    empty table gives an empty one; columns of other names are not read. Pages are labelled whole.
    """
    spark = pages.sparkSession
    source = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    # The ids are picked first, so tasks send short rows; there are train_pages of them.
    ids = source.where("html IS NOT NULL").select(F.xxhash64("page_id").alias("_pick")).distinct().orderBy("_pick").limit(train_pages)
    sample = source.where("html IS NOT NULL").join(F.broadcast(ids), F.xxhash64("page_id") == F.col("_pick"))
    sample = sample.orderBy(F.xxhash64("page_id"), F.xxhash64("html")).select("html").limit(train_pages)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = learn_labeller([h.as_py() for b in batches for h in b["html"]])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model.p)], pa.binary())], names=["model"])

    # One task fits the model to the sample, of at most train_pages pages.
    fitted = Labeller(PATH_DIMS + WORD_DIMS + DENSE).p
    for row in sample.mapInArrow(learn, "model binary").collect():
        fitted = pickle.loads(row["model"])
    model = spark.sparkContext.broadcast(fitted)  # plain arrays: broadcasts name classes instead of sending them

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller, features = Labeller(PATH_DIMS + WORD_DIMS + DENSE), Features()
        labeller.p = model.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                blocks = [blocks_of(h.as_py()) for h in batch["html"]]
                inputs = [features(b) if b else np.zeros((0, 1), np.float32) for b in blocks]
                labels = labeller.labels(inputs)
                texts = [" ".join(b.text for b, y in zip(bs, ys, strict=True) if y) for bs, ys in zip(blocks, labels, strict=True)]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch["page_id"], batch["url"], pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"]
                )

    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")
