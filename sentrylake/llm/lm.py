"""Language-model scores from a weighted backoff automaton whose arcs are counted over the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentrylake.llm.common import cut

# Hashes that stand for the end of a text, its beginning, and "all arcs of a state".
END, BEGIN, TOTAL = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b"\nend", b"\nbegin", b"\ntotal"))
_A, _B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
CHUNK = 6_000_000  # tokens that a task holds before it sends what it has counted


def arc(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The name of an arc: a 64-bit hash of its state and word."""
    x = state * _C + word
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of ``wanted`` in a sorted table, 0 where it has none."""
    if not len(keys):
        return np.zeros(len(wanted), values.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], values.dtype.type(0))


class Reader(dict):
    """Texts as numbers of their tokens, given in order of appearance; ``hashes`` has the hash of each number.

    Tokens are words between white space, A to Z in lower case, then the end, whose number is 0.
    """

    def __init__(self):
        super().__init__()
        self.found = [int(END)]
        self._hashes = np.zeros(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self.found.append(xxhash.xxh64_intdigest(word))
        n = self[word] = len(self.found) - 1
        return n

    def __call__(self, text: str | None) -> np.ndarray:
        # Bytes are lowered in A-Z alone, and split at the blank and the characters 9 to 13.
        tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
        out = np.zeros(len(tokens) + 1, np.int32)
        out[:-1] = np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))
        return out

    @property
    def hashes(self) -> np.ndarray:
        have = len(self._hashes)
        if have < len(self.found):
            self._hashes = np.concatenate([self._hashes, np.array(self.found[have:], np.uint64)])
        return self._hashes


def found_arcs(tokens: np.ndarray, starts: np.ndarray, hashes: np.ndarray, states: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of texts where the automaton may have an arc, and the state and word there, as numbers; -1 is the
    state at a beginning. Only states follow states; the end follows too, but nothing follows it. Without a list
    of states every word is one."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts] = -1
    if states is None:
        return np.arange(len(tokens)), before, tokens
    is_state = look_up(states, np.ones(len(states), bool), hashes)
    inside = np.flatnonzero(((before < 0) | (is_state[before] & (before > 0))) & is_state[tokens])
    return inside, before[inside], tokens[inside]


def state_hash(hashes: np.ndarray, state: np.ndarray) -> np.ndarray:
    return np.where(state < 0, BEGIN, hashes[state])


def counted_arcs(tokens: np.ndarray, starts: np.ndarray, learned: np.ndarray, hashes: np.ndarray):
    """Arcs found in texts: names, counts in the texts to learn from, and whether another text has them."""
    _, state, word = found_arcs(tokens, starts, hashes, None)
    n = len(hashes)
    codes = (state.astype(np.int64) + 1) * n + word
    del state
    # Sorted in two shares, so that no place is held for each token.
    (taught, counts), (others, _) = (np.unique(codes[share], return_counts=True) for share in (learned, ~learned))
    only = others[~_in_sorted(taught, others)]
    other = np.concatenate([_in_sorted(others, taught), np.ones(len(only), bool)])
    codes = np.concatenate([taught, only])
    names = arc(state_hash(hashes, codes // n - 1), hashes[codes % n])
    return names, np.concatenate([counts, np.zeros(len(only), np.int64)]), other


def _in_sorted(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    return look_up(table, np.ones(len(table), bool), wanted)


def _counting(buckets: int, arcs: bool):
    """Per task: keys (tokens, or arcs) with counts, as a row of packed numbers for each bucket of keys. A count
    is doubled, and odd if a text that is not learned from has the key."""
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()

        def flush(reader, parts, flags):
            tokens, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
            learned = np.repeat(np.array(flags), sizes)
            if not arcs:
                keys = reader.hashes
                counts = np.bincount(tokens[learned], minlength=len(keys))
                other = np.bincount(tokens[~learned], minlength=len(keys)) > 0
            else:
                keys, counts, other = counted_arcs(tokens, np.cumsum(sizes) - sizes, learned, reader.hashes)
            bucket = (keys % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((keys, bucket))
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            rows = [(j, order[a:b]) for j, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([j for j, _ in rows], pa.int32()),
                    pa.array([block] * len(rows), pa.int32()),
                    pa.array([keys[i].tobytes() for _, i in rows], pa.binary()),
                    pa.array([packed(2 * counts[i] + other[i]) for _, i in rows], pa.binary()),
                ],
                schema=schema,
            )

        reader, parts, flags, held = Reader(), [], [], 0
        for batch in batches:
            for text, learn in zip(batch["text"], batch["learn"].to_pylist(), strict=True):
                parts.append(reader(text.as_py()))
                flags.append(learn)
                held += len(parts[-1])
                if held > CHUNK:
                    yield flush(reader, parts, flags)
                    reader, parts, flags, held = Reader(), [], [], 0
        if parts:
            yield flush(reader, parts, flags)

    return run, "bucket int, block int, keys binary, counts binary"


def packed(counts: np.ndarray) -> bytes:
    top = counts.max(initial=0)
    return counts.astype("<u1" if top < 2**8 else "<u2" if top < 2**16 else "<u4" if top < 2**32 else "<u8").tobytes()


def unpack(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = np.frombuffer(keys, np.uint64)
    return k, np.frombuffer(counts, f"<u{len(counts) // max(len(k), 1) or 1}").astype(np.int64)


def _totals():
    """Per bucket: sums the counts of all blocks and answers each block with the sums of its keys. A sum of 1 is
    left out where only a text that is learned from has the key: the reader knows that it was seen, so it is 1.

    A key is found once for each block that has it, whatever its frequency, so buckets are even. A row of
    block -1 has the bucket's sum and number of distinct keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(blocks, keys, counts):
            sizes = np.array([len(k) for k in keys])
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            flat = np.concatenate(counts)
            sums = np.bincount(at, flat >> 1, len(distinct)).astype(np.int64)
            replies = []
            for block, k, c, own in zip(blocks, keys, counts, np.split(at, np.cumsum(sizes)[:-1]), strict=True):
                found = sums[own]
                some = (found > 1) | ((found == 1) & (c & 1 == 1))
                replies.append((block, k[some].tobytes(), packed(found[some])))
            empty = [None] * len(replies)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*[r[0] for r in replies], -1], pa.int32()),
                    pa.array([*[r[1] for r in replies], None], pa.binary()),
                    pa.array([*[r[2] for r in replies], None], pa.binary()),
                    pa.array([*empty, int(sums.sum())], pa.int64()),
                    pa.array([*empty, int((sums > 0).sum())], pa.int64()),
                ],
                names=["block", "keys", "counts", "total", "distinct"],
            )

        last, blocks, keys, counts = None, [], [], []
        for batch in batches:  # sorted by bucket
            for bucket, block, k, c in zip(*(batch[n] for n in ("bucket", "block", "keys", "counts")), strict=True):
                if bucket.as_py() != last and blocks:
                    yield answer(blocks, keys, counts)
                    blocks, keys, counts = [], [], []
                last = bucket.as_py()
                own = unpack(k.as_py(), c.as_py())
                blocks.append(block.as_py())
                keys.append(own[0])
                counts.append(own[1])
        if blocks:
            yield answer(blocks, keys, counts)

    return run, "block int, keys binary, counts binary, total long, distinct long"


class Automaton:
    """A backoff automaton over a block's tokens.

    A state is a word, any or one of a given list. Its arcs are the words seen after it, with log10 probabilities; its failure arc
    leads to the root with a weight, where every word has its base probability, words never seen among them.
    With a count k of an arc, n of its state and r of the state's tokens without an arc of their own,
    P(w | state) = (k + (strength + r) P(w)) / (n + strength): a Dirichlet prior around the base. Where every word
    is a state, every token after one has an arc and r is 0.
    """

    def __init__(self, words, arcs, states, total: int, distinct: int, strength: float):
        self.words, self.arcs, self.states = words, arcs, states
        self.total, self.distinct, self.strength = total, distinct, strength
        self.texts = int(look_up(*words, np.array([END]))[0])

    def score(self, tokens: np.ndarray, starts: np.ndarray, learned: np.ndarray, hashes: np.ndarray):
        """Known tokens, base score and score of each of some texts.

        The traversal goes from left to right; the state it carries is given by the token before, so the
        states of the texts are written down first and the weights of their arcs added up in order.
        """
        c = look_up(*self.words, hashes)[tokens]
        c = np.maximum(c, learned)  # a text learned from has seen its own words
        p = (c + 0.5) / (self.total + 0.5 * (self.distinct + 1))
        q = p.copy()
        # Every token after a state or a beginning: an arc, or the failure arc and the root's.
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[starts] = -1
        after = np.arange(len(tokens))
        if self.states is not None:
            is_state = look_up(self.states, np.ones(len(self.states), bool), hashes)
            is_state[0] = False
            after = np.flatnonzero((before < 0) | is_state[before])
        kinds, at = np.unique(before[after], return_inverse=True)
        of_state = state_hash(hashes, kinds)
        n = np.where(kinds < 0, self.texts, look_up(*self.words, of_state))
        own = None if self.states is None else look_up(*self.arcs, arc(of_state, np.full(len(kinds), TOTAL)))
        inside, state, word = found_arcs(tokens, starts, hashes, self.states)
        k = np.zeros(len(tokens), np.int64)
        k[inside] = np.maximum(look_up(*self.arcs, arc(state_hash(hashes, state), hashes[word])), learned[inside])
        n = np.maximum(n[at], learned[after])
        rest = 0 if self.states is None else n - own[at]
        q[after] = (k[after] + (self.strength + rest) * p[after]) / (n + self.strength)
        add = lambda x: np.add.reduceat(x, starts)
        return add((c > 0).astype(np.int64)), add(np.log10(p)), add(np.log10(q))


def _scoring(total: int, distinct: int, strength: float, held: int = 400_000):
    def table(parts):
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        k, c = (np.concatenate(x) for x in zip(*parts, strict=True))
        k, first = np.unique(k, return_index=True)
        return k, c[first]

    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, block, tables, model, texts, size = Reader(), None, ([], []), None, [], 0

        def scored(model, reader, texts):
            sizes = np.array([len(t) for _, _, t in texts])
            starts = np.cumsum(sizes) - sizes
            learned = np.repeat(np.array([flag for _, flag, _ in texts]), sizes)
            out = model.score(np.concatenate([t for _, _, t in texts]), starts, learned, reader.hashes)
            cols = ([doc for doc, _, _ in texts], sizes, *out)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        for batch in batches:  # by block: tables first, then its texts
            columns = (batch[n] for n in ("block", "kind", "doc_id", "learn", "text", "keys", "counts"))
            for b, kind, doc, learn, text, keys, counts in zip(*columns, strict=True):
                if b.as_py() != block:
                    if texts:
                        yield scored(model, reader, texts)
                    reader, block, tables, model, texts, size = Reader(), b.as_py(), ([], []), None, [], 0
                kind = kind.as_py()
                if kind < 2:
                    tables[kind].append(unpack(keys.as_py(), counts.as_py()))
                    continue
                if model is None:
                    model = Automaton(table(tables[0]), table(tables[1]), None, total, distinct, strength)
                    tables = ([], [])
                texts.append((doc.as_py(), learn.as_py(), reader(text.as_py())))
                size += len(texts[-1][2])
                if size > held:
                    yield scored(model, reader, texts)
                    texts, size = [], 0
        if texts:
            yield scored(model, reader, texts)

    return run


@contextmanager
def steady_splits(spark: SparkSession):
    """Files are split alike in every scan within, however many executors come and go."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def lm_scores(
    docs: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    strength: float = 500.0,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from the rows where ``learn`` holds. Every word and the beginning of a text are the states.
    Words are counted first, then the arcs: every pair of neighbours in the corpus. Neither table is ever in one
    place: tasks send packed counts to buckets of keys, and each block of texts gets back the entries it needs,
    which is what a traversal of its texts can touch. Nothing is broadcast.

    ``docs`` must be a scan or another source whose partitions are the same each time, since blocks are its
    partitions. Null texts are empty: their one token is the end. Ids may be null or repeated; every row is a
    document of its own. Words are told apart by 64-bit hashes. With nothing to learn from, every token has
    the probability 0.5 / 0.5. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    with steady_splits(spark):
        source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
        blocks = max(1, source.rdd.getNumPartitions())
        buckets = max(2 * blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))

        def tally(arcs: bool) -> DataFrame:
            run, schema = _counting(buckets, arcs)
            sent = source.select("text", "learn").mapInArrow(run, schema).repartition(buckets, "bucket").sortWithinPartitions("bucket")
            return cut(sent.mapInArrow(*_totals()), "tally")

        words, arcs = tally(False), tally(True)
        sizes = words.where("block = -1").agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
        total, distinct = sizes["n"] or 0, sizes["v"] or 0
        tables = [t.where("block >= 0").select("block", F.lit(kind).alias("kind"), "keys", "counts") for kind, t in enumerate((words, arcs))]
        texts = source.select(F.spark_partition_id().alias("block"), F.lit(2).alias("kind"), "doc_id", "text", "learn")
        every = texts.unionByName(tables[0].unionByName(tables[1]), allowMissingColumns=True)
        every = every.repartition(3 * blocks, "block").sortWithinPartitions("block", "kind")
        run = _scoring(total, distinct, strength)
        scores = every.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
        return cut(scores.withColumn("train_tokens", F.lit(total).cast("long")), "scores")
