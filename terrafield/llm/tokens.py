"""Tokenizer access for executors: whole-text results of a library, at the price of a dictionary look-up.

A text is cut where the tokenizer itself always cuts (white space), and the ids of each
distinct piece are kept in a bounded per-worker cache; misses go to the library in one
batch. A text for which such cutting could differ from the library (special strings, odd
white space, letters whose lower case depends on their place) goes to the library whole,
so results equal the library's for every text.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Entries a worker keeps per cache; some 150 bytes each.
CACHE_ENTRIES = 1_200_000
#: Longer pieces are encoded each time they occur, so that a cache's bytes stay bounded.
LONGEST_KEPT = 64


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def special_strings(path: str) -> list[str]:
    return [t.content for t in load_tokenizer(path).get_added_tokens_decoder().values()]


def _byte_letters() -> dict[int, int]:
    """The printable letter that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}


_LETTERS = _byte_letters()
#: Words of ASCII and Latin-1 letters: every rule set agrees on what is a letter there, and none of them composes further.
_PLAIN = re.compile("[\0-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")


def _piece_tokens(model, piece: str):
    return model.tokenize(piece.encode().decode("latin-1").translate(_LETTERS))


def _library_ids(tokenizer, texts: list[str]) -> list[list[int]]:
    return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class RecentCache:
    """A dictionary of bounded size that keeps what was used lately.

    Look-ups go to ``new``. When that holds half the size, ``turn`` makes it the old generation; what
    is still used moves up from there, and the rest goes at the next turn.
    """

    __slots__ = ("half", "make", "new", "old")

    def __init__(self, size: int, make=dict):
        """``make`` gives an empty (or pre-filled) dictionary for a generation."""
        self.half, self.make, self.new, self.old = size // 2, make, make(), {}

    def turn(self) -> None:
        if len(self.new) > self.half:
            self.old, self.new = self.new, self.make()

    def lift(self, key):
        """The value of a key of the old generation, moved up; None if it is not there."""
        value = self.old.get(key)
        if value is not None:
            self.new[key] = value
        return value


class _Learning(dict):
    """A cache's generation that learns what it lacks, so that a whole text is one mapped look-up."""

    __slots__ = ("learn",)

    def __missing__(self, key: str):
        return self.learn(key)


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordEncoder:
    """Ids of whole texts under a tokenizer whose pre-tokens never hold white space (word BPE)."""

    #: White space to Python's split() but not to the tokenizer, or the reverse; and letters with context-dependent case.
    ODD = re.compile("[\x1c-\x1f\x85᠎​⁠﻿Σ]")
    PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        self.tokenizer = load_tokenizer(path)
        self.specials = special_strings(path)
        self.words, self.pieces = RecentCache(entries, self._generation), RecentCache(entries)

    def _generation(self) -> _Learning:
        out = _Learning()
        out.learn = self._learn_one
        return out

    def _learn_one(self, word: str) -> bytes:
        known = self.words.lift(word)
        if known is None:
            known = self._ids_of(word)
            if len(word) <= LONGEST_KEPT:
                self.words.new[word] = known
        return known

    def _whole(self, text: str) -> bytes:
        return np.array(_library_ids(self.tokenizer, [text])[0], dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        known = self.pieces.new.get(piece)
        if known is None and (known := self.pieces.lift(piece)) is None:
            known = array("I", [t.id for t in _piece_tokens(self.tokenizer.model, piece)]).tobytes()
            if len(piece) <= LONGEST_KEPT:
                self.pieces.new[piece] = known
        return known

    def _ids_of(self, word: str) -> bytes:
        """Ids of a word: by pieces where a plain split is safe, else from the library's whole chain."""
        if not (word.isascii() or _PLAIN.fullmatch(word)):
            return self._whole(word)
        word = word.lower()
        if word.isalpha():
            return self._piece(word)
        return b"".join([self._piece(p) for p in self.PIECES.findall(word)])

    def _learn(self, missing: list[str]) -> dict[str, bytes]:
        """Ids of words not yet known; those that are not plain go to the library in one batch."""
        found, strange = {}, []
        for word in missing:
            if word.isascii() or _PLAIN.fullmatch(word):
                found[word] = self._ids_of(word)
            else:
                strange.append(word)
        for word, ids in zip(strange, _library_ids(self.tokenizer, strange)):
            found[word] = array("I", ids).tobytes()
        return found

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """For each text its ids, as little-endian unsigned 32-bit integers."""
        self.words.turn()
        self.pieces.turn()
        new, out = self.words.new, []
        get = new.__getitem__
        for text in texts:
            if any(s in text for s in self.specials):
                out.append(self._whole(text))
            elif _is_latin(text):
                out.append(self._whole(text) if any(c in text for c in "\x1c\x1d\x1e\x1f\x85") else b"".join(map(get, text.split())))
            elif self.ODD.search(text):
                out.append(self._whole(text))
            else:  # what is not Latin goes to the library, a text's words at a time
                words = text.split()
                found = self._learn([w for w in set(words) if w not in new and self.words.lift(w) is None])
                new.update((w, ids) for w, ids in found.items() if len(w) <= LONGEST_KEPT)
                out.append(b"".join([found[w] if w in found else new[w] for w in words]))
        return out


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """This worker's encoder: its cache lives on from task to task."""
    return WordEncoder(path)


class ByteCounter:
    """Token counts of whole texts under a byte-level BPE: a frequent table first, then a worker cache."""

    #: A space with white space before it and white space or the end behind it: there a cut before each space is not the tokenizer's.
    ODD = re.compile(r"\s (?:\s|\Z)|[\x1c-\x1f]")
    SEPARATORS, BEFORE = "\x1c\x1d\x1e\x1f", " \n\t\r\x0b\x0c\x85\xa0"
    PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")

    def __init__(self, path: str, frequent: dict[str, int] | None = None, entries: int = CACHE_ENTRIES):
        self.tokenizer = load_tokenizer(path)
        self.specials = special_strings(path)
        self.frequent = frequent or {}
        #: Every generation of chunks starts as the frequent table.
        self.chunks, self.pieces = RecentCache(entries, self._generation), RecentCache(entries)

    def _generation(self) -> _Learning:
        out = _Learning(self.frequent)
        out.learn = self._learn_one
        return out

    def _learn_one(self, chunk: str) -> int:
        known = self.chunks.lift(chunk)
        if known is None:
            known = self._length(chunk) if chunk.isascii() or _PLAIN.fullmatch(chunk) else len(_library_ids(self.tokenizer, [chunk])[0])
            if len(chunk) <= LONGEST_KEPT:
                self.chunks.new[chunk] = known
        return known

    def _piece(self, piece: str) -> int:
        known = self.pieces.new.get(piece)
        if known is None and (known := self.pieces.lift(piece)) is None:
            known = len(_piece_tokens(self.tokenizer.model, piece))
            if len(piece) <= LONGEST_KEPT:
                self.pieces.new[piece] = known
        return known

    def _length(self, chunk: str) -> int:
        """The tokens of a plain chunk, by pieces; one of letters behind a space is one piece."""
        if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
            return self._piece(chunk)
        return sum([self._piece(p) for p in self.PIECES.findall(chunk)])

    def chunks_of(self, text: str) -> list[str] | None:
        """The text cut before each space; None if that may differ from the tokenizer's own cuts."""
        if any(s in text for s in self.specials):
            return None
        if (any(c + " " in text for c in self.BEFORE) or any(c in text for c in self.SEPARATORS) or not _is_latin(text)) and self.ODD.search(text):
            return None
        return text.replace(" ", "\0 ").split("\0") if "\0" not in text else None

    def _learn(self, missing: list[str]) -> dict[str, int]:
        found, strange = {}, []
        for chunk in missing:
            if chunk.isascii() or _PLAIN.fullmatch(chunk):
                found[chunk] = self._length(chunk)
            else:
                strange.append(chunk)
        for chunk, ids in zip(strange, _library_ids(self.tokenizer, strange)):
            found[chunk] = len(ids)
        return found

    def count_batch(self, texts: list[str]) -> list[int]:
        self.chunks.turn()
        self.pieces.turn()
        new, out = self.chunks.new, []
        get = new.__getitem__
        for text in texts:
            chunks = self.chunks_of(text)
            if chunks is None:
                out.append(len(_library_ids(self.tokenizer, [text])[0]))
            elif _is_latin(text):
                out.append(sum(map(get, chunks)))
            else:
                found = self._learn([c for c in set(chunks) if c not in new and self.chunks.lift(c) is None])
                new.update((c, n) for c, n in found.items() if len(c) <= LONGEST_KEPT)
                out.append(sum([found[c] if c in found else new[c] for c in chunks]))
        return out


_counters: dict[tuple[str, str], ByteCounter] = {}


def byte_counter(path: str, frequent: dict[str, int], key: str) -> ByteCounter:
    """This worker's counter for the frequent table that ``key`` names: its cache lives on from task to task."""
    if (path, key) not in _counters:
        _counters.clear()
        _counters[path, key] = ByteCounter(path, frequent)
    return _counters[path, key]


class ByteEncoder(ByteCounter):
    """Ids of whole texts under a byte-level BPE, as little-endian unsigned 32-bit integers; its caches hold ids where a counter's hold lengths."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        super().__init__(path, None, entries)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", ids).tobytes() for ids in _library_ids(self.tokenizer, texts)]

    def _learn_one(self, chunk: str) -> bytes:
        known = self.chunks.lift(chunk)
        if known is None:
            known = self._ids_of(chunk) if chunk.isascii() or _PLAIN.fullmatch(chunk) else self._whole([chunk])[0]
            if len(chunk) <= LONGEST_KEPT:
                self.chunks.new[chunk] = known
        return known

    def _piece_ids(self, piece: str) -> bytes:
        known = self.pieces.new.get(piece)
        if known is None and (known := self.pieces.lift(piece)) is None:
            known = array("I", [t.id for t in _piece_tokens(self.tokenizer.model, piece)]).tobytes()
            if len(piece) <= LONGEST_KEPT:
                self.pieces.new[piece] = known
        return known

    def _ids_of(self, chunk: str) -> bytes:
        if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
            return self._piece_ids(chunk)
        return b"".join([self._piece_ids(p) for p in self.PIECES.findall(chunk)])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        self.chunks.turn()
        self.pieces.turn()
        new, out = self.chunks.new, []
        get = new.__getitem__
        for text in texts:
            chunks = self.chunks_of(text)
            if chunks is None:
                out.append(self._whole([text])[0])
            elif _is_latin(text):
                out.append(b"".join(map(get, chunks)))
            else:  # what is not Latin goes to the library, a text's chunks at a time
                strange = [c for c in set(chunks) if c not in new and self.chunks.lift(c) is None and not (c.isascii() or _PLAIN.fullmatch(c))]
                found = dict(zip(strange, self._whole(strange)))
                new.update((c, ids) for c, ids in found.items() if len(c) <= LONGEST_KEPT)
                out.append(b"".join([found[c] if c in found else new[c] for c in chunks]))
        return out


@lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    """This worker's encoder: its cache lives on from task to task."""
    return ByteEncoder(path)
