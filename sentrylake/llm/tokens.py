"""Tokenizers in tasks: word caches that live as long as a Python worker."""

from __future__ import annotations

import re
import sys
import types
import unicodedata
from array import array

import regex

# The patterns that the two vocabularies split texts with.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MAX_CACHED = 600_000


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_cache() -> dict:
    """A dictionary that outlives a task: code shipped by value has no module of its own to keep one in."""
    return sys.modules.setdefault("_sentrylake_worker", types.ModuleType("_sentrylake_worker")).__dict__


def tokenizer(path: str):
    cache = worker_cache()
    if ("tokenizer", path) not in cache:
        from tokenizers import Tokenizer

        cache["tokenizer", path] = Tokenizer.from_file(path)
    return cache["tokenizer", path]


# Unicode's White_Space, which the library means by \s; Python's \s has the separators 28 to 31 besides.
WHITE = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def unicode_pattern(text: str) -> regex.Pattern:
    return regex.compile(text.replace(r"[^\s", "[^" + WHITE).replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))


def _latin_class(*kinds: str) -> str:
    return "".join(re.escape(chr(i)) for i in range(0x250) if unicodedata.category(chr(i))[0] in kinds)


def latin_pattern(text: str) -> re.Pattern:
    """The same for texts below U+0250, where the classes can be spelt out; twice as fast."""
    text = text.replace(r"\p{L}", _latin_class("L")).replace(r"\p{N}", _latin_class("N"))
    for outer in (_latin_class("L"), _latin_class("N")):
        text = text.replace(f" ?{outer}+", f" ?[{outer}]+")
    return re.compile(text.replace(r"[^\s", "[^" + WHITE).replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))


def _letters() -> dict[int, int]:
    """Byte-level vocabularies write a byte as the character of its number if that is a visible one, the
    others in turn as the characters from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + n for n, b in enumerate(hidden)}


BYTE_LETTERS = _letters()


def byte_letters(word: str) -> str:
    return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(BYTE_LETTERS)


class WordEncoder:
    """Ids of texts under a vocabulary of whole words (lower case, white space dropped), piece by piece.

    Texts are normalised and split into pre-tokens here; the library's model encodes each new one, and the
    ids are kept as bytes.
    """

    def __init__(self, path: str):
        cache = worker_cache()
        if ("words", path) not in cache:
            t = tokenizer(path)
            specials = {a.content: t.token_to_id(a.content) for a in t.get_added_tokens_decoder().values()}
            cache["words", path] = ({}, specials)
        self.known, self.specials = cache["words", path]
        self.library = tokenizer(path)
        self.ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
        self.latin, self.beyond = latin_pattern(WORD_PATTERN), re.compile("[^\0-\u024f]")
        self.split = unicode_pattern(WORD_PATTERN)
        self.special = re.compile("|".join(map(re.escape, self.specials)))

    def pretokens(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii.findall(text.lower())
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if not self.beyond.search(text):
            return self.latin.findall(text.lower())
        # Character by character where a final sigma would come out otherwise.
        return self.split.findall("".join(map(str.lower, text)) if "Σ" in text else text.lower())

    def learn(self, tokens: set[str]) -> None:
        new = tokens.difference(self.known)
        if len(self.known) + len(new) > MAX_CACHED:
            self.known.clear()
            new = tokens
        known, tokenize = self.known, self.library.model.tokenize
        for p in new:
            known[p] = array("I", [t.id for t in tokenize(p if p.isascii() and p.isalnum() else byte_letters(p))]).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        parts: list[list[list[str]]] = []
        for text in texts:
            text = text or ""
            special = "<|" in text and self.special.search(text)
            # Special strings are found before anything else, and end the words around them.
            spans = self.special.split(text) if special else [text]
            parts.append([self.pretokens(s) for s in spans])
        self.learn({p for spans in parts for s in spans for p in set(s)})
        get, out = self.known.__getitem__, []
        for text, spans in zip(texts, parts, strict=True):
            if len(spans) == 1:
                out.append(b"".join(map(get, spans[0])))
                continue
            between = [array("I", [self.specials[m]]).tobytes() for m in self.special.findall(text)]
            out.append(b"".join(b"".join(map(get, s)) + x for s, x in zip(spans, [*between, b""], strict=True)))
        return out
