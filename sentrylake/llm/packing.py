"""Best-fit packing of token sequences by linear grouping and few-size configurations."""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sentrylake.llm.common import cut
from sentrylake.llm.tokens import WordEncoder

# A run of equal bins: how many, and the lengths in each in order of place.
Run = tuple[int, tuple[int, ...]]


def groups_of(lengths: dict[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """Linear grouping: the items from long to short in groups of equal number; each has the length of its
    longest item and its items as ``[length, count]`` in falling order."""
    total = sum(lengths.values())
    share = -(-total // groups)
    out: list[tuple[int, list[list[int]]]] = []
    room = 0
    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            if not room:
                out.append((length, []))
                room = share
            take = min(left, room)
            out[-1][1].append([length, take])
            left, room = left - take, room - take
    return out


def _best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes that fits and is worth most."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes)
    for c in range(int(sizes.min()), capacity + 1):
        fit = order[: np.searchsorted(sizes[order], c, side="right")]
        worth = best[c - sizes[fit]] + values[fit]
        j = int(worth.argmax())
        best[c] = best[c - 1]
        if worth[j] > best[c - 1]:
            best[c], last[c] = worth[j], fit[j]
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= sizes[last[c]]
    return float(best[capacity]), pattern


def configurations(sizes: list[int], counts: list[int], capacity: int, rounds: int = 600) -> list[tuple[int, np.ndarray]]:
    """Patterns of few sizes with how often each is used: the linear relaxation by column generation
    (a revised simplex with a knapsack for the next column), rounded down."""
    s, d = np.array(sizes), np.array(counts, float)
    k = len(s)
    base = np.diag(capacity // s).astype(float)
    inverse = np.diag(1.0 / np.diag(base))
    used = inverse @ d
    for _ in range(rounds):
        worth, pattern = _best_pattern(s, inverse.sum(axis=0), capacity)
        if worth <= 1 + 1e-6:
            break
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        used = np.maximum(used - ratio[out] * step, 0)
        used[out] = ratio[out]
        base[:, out] = pattern
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    chosen = [(int(np.floor(used[j] + 1e-6)), base[:, j].astype(np.int64)) for j in range(k)]
    left = np.array(counts)
    out_runs = []
    for n, pattern in chosen:
        if n and pattern.any():
            n = min(n, int(min(left[pattern > 0] // pattern[pattern > 0])))
            if n:
                out_runs.append((n, pattern))
                left -= n * pattern
    return out_runs


def _substitute(groups: list, patterns: list[tuple[int, np.ndarray]]) -> list[Run]:
    """Actual items in the places of a group's size, long ones first."""
    runs: list[Run] = []
    for n, pattern in patterns:
        while n:
            lengths: list[int] = []
            times = n
            for g in np.flatnonzero(pattern):
                need, items = int(pattern[g]), groups[g][1]
                if items[0][1] >= need:
                    times = min(times, items[0][1] // need)
                    lengths += [items[0][0]] * need
                else:  # the end of one length and the start of the next
                    times, at = 1, 0
                    while need:
                        take = min(need, items[at][1])
                        lengths += [items[at][0]] * take
                        need, at = need - take, at + 1
            need_of = Counter()
            for g in np.flatnonzero(pattern):
                need_of[g] = int(pattern[g]) * times
            for g, need in need_of.items():
                items = groups[g][1]
                while need:
                    take = min(need, items[0][1])
                    items[0][1] -= take
                    need -= take
                    if not items[0][1]:
                        items.pop(0)
            runs.append((times, tuple(lengths)))
            n -= times
    return runs


def best_fit(runs: list[Run], lengths: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing: each item, longest first, into the bin with the least room that takes it.

    Equal bins and equal items are handled together: the fullest bins that have room get as many items of
    the length as they take, one bin after the other.
    """
    by_room: dict[int, list[Run]] = defaultdict(list)
    for n, items in runs:
        by_room[capacity - sum(items)].append((n, items))
    rooms = sorted(by_room)
    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            if at == len(rooms):
                n, items = left, ()
            else:
                n, items = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
            each = min(room // length, left)
            bins = min(n, left // each)
            rest = [(bins, (*items, *[length] * each)), (n - bins, items)] if items else [(bins, (*items, *[length] * each))]
            left -= bins * each
            for m, filled in rest:
                if m:
                    r = capacity - sum(filled)
                    if r not in by_room:
                        bisect.insort(rooms, r)
                    by_room[r].append((m, filled))
    return [run for r in rooms for run in by_room[r]]


def plan(lengths: dict[int, int], capacity: int, groups: int = 96, large: int | None = None) -> list[Run]:
    """Bins for a histogram of lengths, as runs of equal bins."""
    large = capacity // 3 if large is None else large
    big = {n: c for n, c in lengths.items() if large < n < capacity}
    small = {n: c for n, c in lengths.items() if n <= large}
    runs: list[Run] = [(lengths[capacity], (capacity,))] if lengths.get(capacity) else []
    if big:
        # Patterns are used a whole number of times, so groups of few items would lose much in rounding.
        grouped = groups_of(big, max(4, min(groups, sum(big.values()) // 50)))
        # Groups that round to one size are one size.
        sizes: list[int] = []
        items: list[list[list[int]]] = []
        for size, own in grouped:
            if sizes and sizes[-1] == size:
                items[-1] += own
            else:
                sizes.append(size)
                items.append(own)
        counts = [sum(c for _, c in own) for own in items]
        named = list(zip(sizes, items, strict=True))
        for n, lengths in _substitute(named, configurations(sizes, counts, capacity)):
            # Rounding leaves room that may be too little for any short item: unless the actual items fill
            # a bin, its shortest one is fitted anew, into the least room that takes it.
            loose = sum(lengths) < capacity and len(lengths) > 1
            runs.append((n, lengths[:-1] if loose else lengths))
            if loose:
                small[lengths[-1]] = small.get(lengths[-1], 0) + n
        for _, own in named:  # what the rounding left over is fitted with the small ones
            for length, count in own:
                small[length] = small.get(length, 0) + count
    runs = best_fit(runs, small, capacity)
    # Where few items leave the patterns much rounding, the bins that are not full are fitted anew if that takes fewer.
    full = [run for run in runs if sum(run[1]) == capacity]
    loose: Counter = Counter()
    for n, lengths_in in runs:
        if sum(lengths_in) < capacity:
            for length in lengths_in:
                loose[length] += n
    again = best_fit(full, loose, capacity)
    return min(runs, again, key=lambda rs: sum(n for n, _ in rs))


def token_pieces(docs: DataFrame, path: str, capacity: int, end: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece; ids of a text and ``end`` after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tail = WordEncoder(path), end.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc, ids in zip(part["doc_id"].to_pylist(), encoder.encode(part["text"].to_pylist()), strict=True):
                    ids += tail
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[start : start + 4 * capacity]
                        rows.append((doc, piece, start // 4, len(own) // 4, zlib.crc32(own)))
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int, groups: int = 96) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    The plan needs only how often each length occurs, at most ``capacity`` numbers, so it is made on the
    driver at any size. It says how many places each run of equal bins has for a length; a row finds its place
    by its rank among the rows of its length. Ranks are counted within hashed parts of a length, so that a
    frequent length is no single task's work. Rows that share everything may swap places.
    """
    pieces = cut(pieces, "pieces")
    spark = pieces.sparkSession
    found = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan(found, capacity, groups) if found else []
    places, first, used = [], 0, Counter()
    for n, items in runs:
        offset = 0
        for length, times in Counter(items).items():  # equal lengths are neighbours
            places.append((length, used[length], used[length] + n * times, first, times, offset))
            used[length] += n * times
            offset += length * times
        first += n
    names = ["length", "low", "high", "first", "times", "base"]
    # An Arrow table becomes a local relation: rows would start plain Python workers beside those for Arrow, on every executor.
    columns = list(zip(*places, strict=True)) or [()] * len(names)
    places_df = spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names=names))
    # At most a few entries for each length, whatever the number of rows.
    parts = 256
    part = F.pmod(F.xxhash64(*[c for c in pieces.columns]), F.lit(parts))
    rows = pieces.withColumn("_part", part)
    sizes = rows.groupBy("length", "_part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("length", "_part", F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(W.partitionBy("length", "_part").orderBy(*pieces.columns)) - 1
    ranked = rows.withColumn("_own", own).join(sizes, ["length", "_part"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_own")).drop("_part", "_own", "_before")
    on = (ranked["length"] == places_df["length"]) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high"))
    placed = ranked.join(F.broadcast(places_df), on).drop(places_df["length"])
    at = F.col("_rank") - F.col("low")
    return placed.select(
        *pieces.columns,
        (F.col("first") + F.floor(at / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("base") + at % F.col("times") * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(
    docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, groups: int = 96, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Cuts documents into pieces of at most ``capacity`` tokens and packs these into few sequences.

    Each text is encoded whole and followed by the id ``end``; a null or empty text is that id alone. Only
    longer documents are cut. Repeated rows are packed each for itself, and null ids are kept. An empty table
    gives an empty one; columns of other names are not read.
    """
    return pack(token_pieces(docs, path, capacity, end, doc_id, text), capacity, groups)
