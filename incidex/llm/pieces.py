"""Cutting text at places no token crosses, and remembering what was encoded.

A cut before blank, tab or line end whose left neighbour is no white space is
safe for word-wise tokenizers: their pre-tokenizers let white space only begin
a word, and a run of white space is never divided there.  Texts of any length
become short pieces, and a piece that returns need not be encoded again.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import numpy as np

# every character besides blank, tab and line end that some engine takes for white space
_ODD = [0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010),
        0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]
_ODD_CHARS = [chr(c) for c in _ODD]
_RUNS = ["\t", "\r", "\0", "  ", " \n", "\n ", "\n\n"]
_PLAIN = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
_CAREFUL = re.compile("(?<=[^ \\t\\n\\r%s])(?=[ \\t\\n\\r])" % "".join(_ODD_CHARS))
_WORDS = re.compile(r"[^ \t\n\r]+")


def safe_pieces(text: str) -> list[str]:
    """Pieces whose concatenation is ``text``; each may be encoded on its own."""
    if any(c in text for c in _ODD_CHARS):
        return [x for x in _CAREFUL.split(text) if x]
    if any(c in text for c in _RUNS):
        return _PLAIN.findall(text)
    pieces = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return pieces if pieces[0] else pieces[1:]


class Slots(dict):
    """Numbers pieces in the order they are first met; ``new`` lists those not yet encoded."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


def blank_free_pieces(text: str) -> list[str]:
    """Pieces between blanks, tabs and line ends, for tokenizers that drop white space."""
    return _WORDS.findall(text)


def by_bytes(pieces, limit: int):
    """Lists of consecutive pieces of about ``limit`` bytes each (a longer piece is alone)."""
    batch, size = [], 0
    for p in pieces:
        n = len(p) if p.isascii() else len(p.encode())
        if batch and size + n > limit:
            yield batch
            batch, size = [], 0
        batch.append(p)
        size += n
    if batch:
        yield batch


def gather(values: np.ndarray, begin: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[begin:begin + number]`` of every range, joined, and where each ends (from 0)."""
    ends = np.concatenate([[0], np.cumsum(number)])
    return values[np.repeat(begin - ends[:-1], number) + np.arange(ends[-1])], ends


class PieceStore:
    """Token ids of texts, piece by piece; what is remembered stays under ``budget`` bytes.

    ``cut`` splits a text; ``learn`` encodes a list of new pieces and returns
    all their ids and where each piece's ids end (from 0).  Past the budget,
    pieces met once are forgotten and the most frequent others are kept, at
    most three quarters of the budget; their counts are halved, so old favourites fade.
    """

    ENTRY_BYTES = 160    # dictionary entry, string header and slot number of a piece, about

    def __init__(self, cut: Callable, learn: Callable, budget: int = 64 << 20):
        self.cut, self.learn, self.budget = cut, learn, budget
        self._start(Slots(), np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), 0)

    def _start(self, slots, ends, flat, hits, chars):
        self.slots = slots
        self.ends = ends            # slot s: flat[ends[s]:ends[s + 1]]
        self.flat = flat
        self.hits = hits
        self.chars = chars

    @property
    def nbytes(self) -> int:
        return self.ENTRY_BYTES * len(self.slots) + 2 * self.chars + self.flat.nbytes + self.ends.nbytes + self.hits.nbytes

    def _shrink(self):
        pieces = list(self.slots)
        size = self.ENTRY_BYTES + 16 + 2 * np.fromiter(map(len, pieces), np.int64, len(pieces)) + 4 * np.diff(self.ends)
        order = np.argsort(-self.hits, kind="stable")
        order = order[(np.cumsum(size[order]) <= 3 * self.budget // 4) & (self.hits[order] > 1)]
        begin = self.ends[order]
        flat, ends = gather(self.flat, begin, self.ends[order + 1] - begin)
        slots = Slots()
        for s in order.tolist():
            slots[pieces[s]]
        slots.new = []
        self._start(slots, ends, flat, (self.hits[order] + 1) // 2, sum(map(len, slots)))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids end (from 0), and the ids, one text after the other."""
        if self.nbytes > self.budget:
            self._shrink()
        cut = [self.cut(t) if t else [] for t in texts]
        sizes = np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(np.int64)
        slots = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(cut)), np.int64, sizes[-1])
        if self.slots.new:
            flat, ends = self.learn(self.slots.new)
            self.chars += sum(map(len, self.slots.new))
            self.ends = np.concatenate([self.ends, ends[1:] + self.ends[-1]])
            self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
            self.slots.new = []
        self.hits = np.bincount(slots, minlength=len(self.slots)) + np.append(
            self.hits, np.zeros(len(self.slots) - len(self.hits), np.int64))
        begin = self.ends[slots]
        ids, ends = gather(self.flat, begin, self.ends[slots + 1] - begin)
        return ends[sizes], ids


def texts_by_size(texts, limit: int):
    """Lists of consecutive texts of an Arrow array, of about ``limit`` characters each."""
    part, size = [], 0
    for t in texts:
        t = t.as_py()
        part.append(t)
        size += len(t or "")
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part
