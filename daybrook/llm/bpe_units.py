"""Exact encoding of whole texts through the tokenizers library, one unit (white space and the word after it) at a time.

Where white space follows anything else, no token reaches across: byte-level BPE with the usual pattern starts a new
piece there, and a tokenizer that drops white space sees separate words. So a text's ids are its units' ids, and each
distinct unit is encoded once per worker and kept in a two-generation cache bounded in bytes. Texts with white space beyond
ASCII, for which that rule would need more care, are encoded whole by the library.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

CACHE_BYTES = 128 << 20  # per worker and vocabulary, both generations
ENTRY_BYTES = 200  # a unit's key, its ids and its share of the table, about

_UNIT = re.compile(rb"\s*\S+|\s+")
_ODD_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_ODD_LEADS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")
_UNEVEN = (b"\t", b"\r", b"\x0b", b"\x0c", b"  ", b" \n", b"\n ", b"\n\n")
# Latin letters and the marks that may follow them are two pieces under any edition of the letter tables; an apostrophe may
# begin a contraction and "<" a special token, so these two are left to the library
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'<")
# the byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on, in order
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BLANK = BYTE_CHARS[32]
_ENCODERS: dict = {}


def encoder(path: str, spaces: bool, cache_bytes: int | None = None) -> "UnitEncoder":
    """The worker's encoder for a vocabulary file. ``spaces``: white space takes part in tokens."""
    if (path, spaces, cache_bytes) not in _ENCODERS:
        _ENCODERS[path, spaces, cache_bytes] = UnitEncoder(path, spaces, cache_bytes)
    return _ENCODERS[path, spaces, cache_bytes]


class _Cache(dict):
    """Ids by unit. A key that is missing is encoded; of two generations the older one goes when the younger is full."""

    def __init__(self, encode, entries: int):
        super().__init__()
        self.encode, self.entries, self.old = encode, entries, {}

    def __missing__(self, key):
        ids = self.old.get(key)
        if ids is None:
            ids = self.encode(key)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = ids
        return ids


def after_blank(key: bytes) -> bytes:
    """The unit of a key that follows a blank: a key that starts a line carries its line end instead."""
    return key if key[:1] == b"\n" else b" " + key


class UnitEncoder:
    def __init__(self, path: str, spaces: bool, cache_bytes: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.spaces = spaces
        entries = (cache_bytes or CACHE_BYTES) // ENTRY_BYTES // 2
        # nearly all units of a text follow a blank, or stand alone where white space does not count
        self.common = _Cache(self._after_blank if spaces else self._alone, entries * 7 // 8)
        self.others = _Cache(self._alone, entries // 8) if spaces else self.common
        self.marks = _Cache(lambda marks: self.library([marks])[0], 1000)

    def library(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit words, straight from the library."""
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def separable(self, text: bytes) -> bool:
        """Is every white space of the text ASCII, or irrelevant?"""
        return not self.spaces or text.isascii() or not (any(lead in text for lead in _ODD_LEADS) and _ODD_SPACE.search(text))

    def single_spaced(self, text: bytes) -> bool:
        """Does no white space but blanks and line ends occur, and none beside another?"""
        return not any(white in text for white in _UNEVEN)

    def even(self, text: bytes) -> bool:
        """Is every white space of the text one blank or line end between two words, or irrelevant?"""
        return not self.spaces or self.single_spaced(text) and not text[-1:].isspace()

    def split(self, text: bytes) -> list[bytes]:
        """Units whose ids, joined, are the ids of a separable text."""
        if not self.spaces:
            return text.split()
        if not self.even(text):
            return _UNIT.findall(text)
        head, *keys = self.keys(text)
        return [head, *map(after_blank, keys)]

    def keys(self, text: bytes) -> list[bytes]:
        """The first unit and the keys of the others (``after_blank``), of a text whose white space is even."""
        return text.replace(b"\n", b" \n").split(b" ")

    def ids(self, units: list[bytes]) -> list[bytes]:
        """Ids of each unit."""
        return [self.common[u[1:]] if u[:1] == b" " and u[1:2] != b"\n" and self.spaces else self.others[u] for u in units]

    def even_ids(self, text: bytes) -> list[bytes]:
        """Ids of each unit of a text whose white space is even."""
        if not self.spaces:
            return list(map(self.common.__getitem__, text.split()))
        head, *keys = self.keys(text)
        return [self.others[head], *map(self.common.__getitem__, keys)]

    def _after_blank(self, key: bytes) -> bytes:
        """Ids of the unit of a key (``after_blank``)."""
        word = key.rstrip(_MARKS)
        if word.isalpha():  # ASCII letters stand for themselves
            if len(word) < len(key):  # the word may be known without its marks
                return self.common[word] + self.marks[key[len(word):]]
            return self._tokens(_BLANK + word.decode())
        if key[:1] == b"\n" and len(key) > 1:  # a line end before anything else is a piece of its own
            return self.marks[b"\n"] + self.others[key[1:]]
        if not _LETTERS.fullmatch(word):
            return self.library([after_blank(key)])[0]
        if len(word) < len(key):
            return self.common[word] + self.marks[key[len(word):]]
        return self._tokens(_BLANK + word.decode("latin-1").translate(BYTE_CHARS))

    def _alone(self, unit: bytes) -> bytes:
        """Ids of a unit with no white space before it, or with any."""
        word = unit.rstrip(_MARKS)
        if not _LETTERS.fullmatch(word):
            return self.library([unit])[0]
        if len(word) < len(unit):
            return (self.others if self.spaces else self.common)[word] + self.marks[unit[len(word):]]
        if not self.spaces:
            word = word.lower() if word.isalpha() else word.decode().lower().encode()
        return self._tokens(word.decode() if word.isalpha() else word.decode("latin-1").translate(BYTE_CHARS))

    def _tokens(self, letters: str) -> bytes:
        """Ids of one piece, so the library's model alone decides."""
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def encode(self, text: bytes) -> bytes:
        """Ids of the whole text as little-endian 32-bit words."""
        if not self.separable(text):
            return self.library([text])[0]
        return b"".join(self.even_ids(text) if self.even(text) else self.ids(self.split(text)))
