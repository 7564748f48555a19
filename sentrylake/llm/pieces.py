"""SentencePiece vocabularies: encoding with an Aho-Corasick automaton and Viterbi, and decoding."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrylake.llm.tokens import worker_cache

MARK = "▁"  # stands for a blank
MAX_CACHED = 600_000


class PieceModel:
    """The pieces of a SentencePiece model file with their scores, and the segmentation they imply.

    A text is written with marks for blanks and one mark before it. Its segmentation is the sequence of pieces
    with the greatest sum of scores (of equal ones, that whose last piece is longest, and so on before it); a
    character that no piece covers becomes its UTF-8 bytes, each a byte piece. Pieces hold a mark only at their
    start, unless they are marks alone, so the best segmentation of a text is that of its words, which are
    looked up in a cache.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = [0] * 256
        self.bytes_of: dict[int, int] = {}
        self.unknown = model.unk_id()
        self.scores: dict[str, tuple[float, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)], self.bytes_of[i] = i, int(piece[3:5], 16)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.automaton.add_word(piece, (len(piece), model.get_score(i), i))
                self.scores[piece] = (model.get_score(i), i)
                if MARK in piece[1:] and piece.strip(MARK):
                    raise ValueError("a piece spans words")
        self.automaton.make_automaton()
        # Dearer than any path over pieces of one character.
        self.penalty = 10.0 * min(s for s, _ in self.scores.values()) - 1e6
        self.word = regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.known: dict[str, bytes] = {}

    def viterbi(self, word: str) -> list[int]:
        """Ids of the best segmentation, in one pass: at each place the automaton's matches, found by
        following output links, relax the best score of what ends there."""
        n, penalty = len(word), self.penalty
        best, last = [0.0] * (n + 1), [None] * (n + 1)
        done = 0
        for end, (length, score, i) in self.automaton.iter(word):
            while done < end:  # places where nothing ends
                done += 1
                if last[done] is None:
                    best[done], last[done] = best[done - 1] + penalty, (1, -1)
            end += 1
            total = best[end - length] + score
            if last[end] is None or total > best[end] or (total == best[end] and length > last[end][0]):
                best[end], last[end] = total, (length, i)
        while done < n:
            done += 1
            if last[done] is None:
                best[done], last[done] = best[done - 1] + penalty, (1, -1)
        out: list[int] = []
        at = n
        while at:
            length, i = last[at]
            if i >= 0:
                out.append(i)
            else:
                out += [self.byte_ids[b] for b in reversed(word[at - 1].encode("utf-8", "surrogatepass"))]
            at -= length
        return out[::-1]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit numbers; none for an empty text."""
        if not text:
            return b""
        words = self.word.findall(MARK + text.replace(" ", MARK))
        known = self.known
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) > MAX_CACHED:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = array("I", self.viterbi(w)).tobytes()
            return b"".join(map(known.__getitem__, words))

    def decode(self, ids: bytes) -> str:
        """The text of the ids: the inverse of ``encode``, unless the text has the mark itself."""
        out, pending, pieces, bytes_of = [], bytearray(), self.pieces, self.bytes_of
        for i in memoryview(ids).cast("I"):
            b = bytes_of.get(i)
            if b is not None:
                pending.append(b)
                continue
            if pending:
                out.append(pending.decode("utf-8", "surrogatepass"))
                pending.clear()
            out.append(pieces[i])
        if pending:
            out.append(pending.decode("utf-8", "surrogatepass"))
        return "".join(out).replace(MARK, " ")[1:]


def piece_model(path: str) -> PieceModel:
    cache = worker_cache()
    if ("pieces", path) not in cache:
        cache["pieces", path] = PieceModel(path)
    return cache["pieces", path]


def encode_pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (packed little-endian 32-bit numbers) of every row; null and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            ids = [model.encode(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, ids binary")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            texts = [model.decode(i.as_py() or b"") for i in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trips(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every text encoded and decoded again: ``doc_id, n_chars, n_pieces, ids_crc32, exact``.

    ``exact`` tells whether decoding gives the text back, which fails only where a text holds the mark U+2581.
    Null texts are empty. Rows with null or repeated ids each have their own result; an empty table gives an
    empty one, and columns of other names are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            rows = []
            for doc, cell in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                body = cell.as_py() or ""
                ids = model.encode(body)
                rows.append((doc, len(body), len(ids) // 4, zlib.crc32(ids), model.decode(ids) == body))
            cols = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            names = ["doc_id", "n_chars", "n_pieces", "ids_crc32", "exact"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_chars long, n_pieces long, ids_crc32 long, exact boolean")
