"""Splitting texts at places that no tokenizer of the byte-level family joins, so that equal parts are encoded once.

The pattern of those tokenizers lets a piece hold white space only at its start or as a run of its own.  So a text
may be cut wherever white space follows something else: each part is a run of white space with what follows it up to
the next.  That holds for blanks, tabs and line ends as long as no other kind of white space stands beside them;
texts with other kinds are one part.  Likewise a part may be cut between a letter and the marks behind it.

Only for the patterns in SPLITS is that so: texts go whole to tokenizers with others.
"""

from __future__ import annotations

import gc
import re
from itertools import chain

import numpy as np

from ._common import gathered

#: Patterns of which the above holds (fixed values): that of the byte-level family, as written for two engines.
SPLITS = frozenset({
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
})

_PART = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
#: Other white space, and what some call so.
_OTHER = [chr(c) for c in (0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)]
_SLOW = ["  ", " \n", "\n ", "\n\n", "\t", "\r"]

_MARKS = ".,;:!?$%&#*|()\"-"

#: A part as a key: a string stands for itself behind a blank, or for itself if it begins with a line end; a tuple
#: holds a part that is taken as it is.
Key = str | tuple[str]


def keys(text: str) -> list[Key]:
    """The parts of a text, as keys."""
    has = text.__contains__
    if any(map(has, _OTHER)):
        return [(text,)]
    if any(map(has, _SLOW)):
        return [x[1:] if x[0] == " " and len(x) > 1 and x[1] not in " \n\t\r" else (x,) for x in _PART.findall(text)]
    words: list[Key] = text.replace("\n", " \n").split(" ")
    words[0] = (words[0],)
    return words


def part(key: Key) -> str:
    """What a key stands for."""
    return key[0] if isinstance(key, tuple) else key if key[:1] == "\n" else " " + key


def cut(whole: str) -> tuple[str, str]:
    """A part as what ends in a letter, and the marks behind it; or whole, with nothing behind it."""
    core = whole.rstrip(_MARKS)
    return (core, whole[len(core) :]) if core != whole and core[-1:].isalpha() else (whole, "")


#: Bytes that Python's objects and numpy's arrays take for a part, beside its characters.
ENTRY = 260


class PartCache(dict):
    """Numbers for parts, and the ids of each; encode(list of new strings) gives a list of sequences of ids.

    A part that ends in a letter is encoded, one with marks behind it is put together from that and the marks, which are
    parts themselves.  It holds about so many bytes at most, and starts anew when a batch begins beyond that.  Where
    parts is false, or a text holds one of the strings in whole, that text is one part."""

    def __init__(self, encode, most: int = 200 << 20, parts: bool = True, whole: tuple[str, ...] = ()):
        super().__init__()
        self.encode, self.most, self.parts, self.whole = encode, most, parts, whole
        self._clear()

    def _clear(self) -> None:
        self.clear()
        self.new: list[Key] = []
        self.held = 0
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, key: Key) -> int:
        k = self[key] = len(self)
        self.new.append(key)
        return k

    def _add(self, numbers: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        """The ids of these parts, one behind the other."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[numbers], self.lengths[numbers] = self.used + np.cumsum(lengths) - lengths, lengths
        self.used += len(ids)

    def _settle(self) -> None:
        if not self.new:
            return
        first = len(self) - len(self.new)
        strings, own, joined, held = [], [], [], 0
        for k, key in enumerate(self.new, first):  # it grows meanwhile
            alone = isinstance(key, tuple)
            string = key[0] if alone else key if key[:1] == "\n" else " " + key
            held += len(string)
            if self.parts:
                core, marks = cut(string)
                if marks:
                    joined.append((k, self[(core,) if alone else core if key[:1] == "\n" else core[1:]], self[(marks,)]))
                    continue
            strings.append(string)
            own.append(k)
        self.held += held + ENTRY * len(self.new)
        self.new = []
        more = np.zeros(len(self) - first, np.int64)
        self.starts, self.lengths = np.concatenate([self.starts, more]), np.concatenate([self.lengths, more])
        ids = self.encode(strings)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self._add(np.array(own, np.int64), np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths)
        if joined:
            whole, *both = np.array(joined, np.int64).T
            both = np.stack(both, axis=1)
            lengths = self.lengths[both]
            self._add(whole, gathered(self.flat, self.starts[both].ravel(), lengths.ravel()), lengths.sum(axis=1))

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind the other, and how many each has."""
        collects = gc.isenabled()
        gc.disable()  # nothing here is a cycle, and each pass of the collector would go through the whole cache
        try:
            return self._encoded(texts)
        finally:
            if collects:
                gc.enable()

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.held > self.most:
            self._clear()
        get, numbers, counts = self.__getitem__, [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = keys(text) if self.parts and not any(map(text.__contains__, self.whole)) else [(text,)]
            counts[i] = len(own)
            numbers.append(np.fromiter(map(get, own), np.int64, len(own)))
        self._settle()
        numbers = np.concatenate([*numbers, np.zeros(0, np.int64)])
        if not len(numbers):
            return np.zeros(0, np.uint32), counts
        lengths = self.lengths[numbers]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return gathered(self.flat, self.starts[numbers], lengths), np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])
