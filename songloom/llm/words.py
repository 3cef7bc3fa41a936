"""Words and n-grams of many texts at once, as numpy arrays over the bytes of an Arrow column.

A word is a run of bytes other than ASCII white space (9 to 13 and 32). In UTF-8 those bytes never
occur inside another character, so byte runs and character runs are the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # working memory follows this, not the size of an Arrow batch
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    global _powers, _inverses
    if len(_powers) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        size = max(n, CHUNK_BYTES + 4096)
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE)], dtype=np.uint64)
            _inverses = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, inverse)], dtype=np.uint64)
    return _powers, _inverses


@dataclass
class Words:
    """``data`` holds all texts, each followed by a newline; text i is ``data[begin[i]:end[i]]``.

    Word j is ``data[start[j]:stop[j]]``; those of text i are ``first[i]`` to ``first[i + 1] - 1``.
    """

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash for each word, of ``data`` (for example lower-cased) if given."""
        data = self.data if data is None else data
        if not len(self.start):
            return np.zeros(0, np.uint64)
        powers, inverses = _powers_up_to(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * powers[: len(data)], out=sums[1:])
        return mix((sums[self.stop] - sums[self.start]) * inverses[self.start])

    def of_word(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.begin)), np.diff(self.first))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per byte over each text."""
        sums = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=sums[1:])
        return sums[self.end] - sums[self.begin]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    return np.frombuffer(data or b"", np.uint8), offsets


def word_chunks(column: pa.Array) -> Iterator[tuple[int, Words]]:
    """Consecutive slices of a string column, about a chunk of bytes each: (first row, its words)."""
    data, offsets = text_bytes(column)
    n, row = len(column), 0
    while row < n:
        upto = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        upto = min(max(upto, row + 1), n)
        yield row, split_words(data[offsets[row] : offsets[upto]], offsets[row : upto + 1] - offsets[row])
        row = upto


def split_words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(offsets) - 1
    begin = offsets[:-1] + np.arange(n)
    end = offsets[1:] + np.arange(n)
    data = np.full(len(raw) + n, 10, np.uint8)
    inside = np.ones(len(data), bool)
    inside[end] = False
    data[inside] = raw
    letter = ~IS_SPACE[data]
    edge = np.diff(np.r_[False, letter].astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.r_[np.searchsorted(start, begin), len(start)]
    return Words(data, begin, end, start, stop, first)


def shingle_sets(words: Words, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its lower-cased ``width``-word shingles.

    A text with fewer words has its whole sequence as one shingle; one without words an empty set.
    """
    hashes = words.hashes(LOWER[words.data])
    rolled = _rolled(hashes, width)
    sets = []
    for i in range(len(words.begin)):
        a, b = words.first[i], words.first[i + 1]
        if b - a >= width:
            sets.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            sets.append(_rolled(hashes[a:b], int(b - a))[:1] ^ np.uint64(b - a))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive values; the last ``width - 1`` places mean nothing."""
    out = hashes.copy()
    for k in range(1, width):
        out = mix(out * _BASE)
        out[: max(0, len(out) - k)] += hashes[k:]
    return mix(out)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all full windows of consecutive values."""
    return _rolled(hashes, width)[: max(0, len(hashes) - width + 1)]
