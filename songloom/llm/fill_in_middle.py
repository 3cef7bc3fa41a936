"""Fill-in-middle transformation of whole texts, with cuts at token boundaries.

A token is a word with the ASCII white space before it, or the white space that ends the text. The
offsets at which tokens end, in code points, form one boundary set for each text, kept like a Roaring
bitmap: the upper 16 bits choose a container, and a container holds the lower bits as a sorted array,
a bitmap or runs, whichever takes the least space. Cumulative cardinalities of the containers, and of
the words or runs inside them, turn "where does token k end" into two searches: one for the container
and one inside it (``BoundarySet.select``).

Which texts are transformed, the form and the two cuts follow from a SHA-256 digest of a seed and the
document's id alone, so reruns agree. ``restored`` rebuilds the exact text from an output and its form.

Null texts count as empty; empty texts, and texts that hold a marker, stay plain. Rows that repeat an
id or a text are transformed one by one; a null id is drawn for like an empty one. Each row is a task's
own work, however long its text is, and nothing is shuffled. Other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songloom.llm.common import lean, pick
from songloom.llm.words import IS_SPACE, Words, word_chunks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
PLAIN_PERCENT, SPM_PERCENT = 50, 80
_LOW = 1 << 16
_ARRAY_MOST = 4096


@dataclass
class _Array:
    values: np.ndarray

    def select(self, k: int) -> int:
        return int(self.values[k])


@dataclass
class _Bitmap:
    words: np.ndarray  # 1,024 of 64 bits
    before: np.ndarray  # values before each word

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.unpackbits(self.words[at : at + 1].view(np.uint8), bitorder="little")
        return at * 64 + int(np.flatnonzero(bits)[k - int(self.before[at])])


@dataclass
class _Runs:
    starts: np.ndarray
    before: np.ndarray  # values before each run

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])


def _container(low: np.ndarray) -> _Array | _Bitmap | _Runs:
    """The smallest of the three: two bytes a value, four a run, or 8 KB."""
    first = np.flatnonzero(np.r_[True, np.diff(low) != 1])
    if 2 + 4 * len(first) < min(2 * len(low), _LOW // 8):
        return _Runs(low[first], first)
    if len(low) <= _ARRAY_MOST:
        return _Array(low.astype(np.uint16))
    bits = np.zeros(_LOW, np.uint8)
    bits[low] = 1
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    counts = np.bitwise_count(words).astype(np.int64)
    return _Bitmap(words, np.cumsum(counts) - counts)


class BoundarySet:
    """A set of offsets, given in ascending order, that answers which one is the k-th."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> 16
        first = np.flatnonzero(np.r_[len(offsets) > 0, np.diff(high) != 0])
        self.keys = high[first]
        self.before = first
        self.size = len(offsets)
        self.containers = [_container(part & (_LOW - 1)) for part in np.split(offsets, first[1:])] if self.size else []

    def select(self, k: int) -> int:
        """The k-th offset, counted from 0."""
        if not 0 <= k < self.size:
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return (int(self.keys[at]) << 16) + self.containers[at].select(k - int(self.before[at]))


def _token_ends(words: Words) -> Iterator[np.ndarray]:
    """For each text the offsets, in code points, at which its tokens end."""
    points = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum((words.data & 0xC0) != 0x80, out=points[1:])
    for i, (begin, end) in enumerate(zip(words.begin, words.end)):
        stops = words.stop[words.first[i] : words.first[i + 1]]
        if end > begin and IS_SPACE[words.data[end - 1]]:
            stops = np.r_[stops, end]
        yield points[stops] - points[begin]


def transformed(text: str, ends: BoundarySet, draws: list[int]) -> tuple:
    """``(form, prefix_chars, middle_chars, output)`` of one text for its four draws."""
    first, second, plain, order = draws
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or plain % 100 >= PLAIN_PERCENT:
        return "plain", None, None, text
    units = sorted(draw % (ends.size + 1) for draw in (first, second))
    low, high = (ends.select(k - 1) if k else 0 for k in units)
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if order % 100 < SPM_PERCENT:
        return "spm", low, high - low, "".join([SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle])
    return "psm", low, high - low, "".join([PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle])


@lean
def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, words in word_chunks(batch["text"]):
            ends = [BoundarySet(e) for e in _token_ends(words)]
            part = batch.slice(row, len(ends))
            made = [transformed(t.as_py(), e, d.as_py()) for t, e, d in zip(part["text"], ends, part["draws"])]
            forms, prefixes, middles, outputs = zip(*made)
            yield pa.RecordBatch.from_pydict({
                "doc_id": part["doc_id"],
                "n": pa.array([e.size for e in ends], pa.int64()),
                "form": pa.array(forms, pa.string()),
                "prefix_chars": pa.array(prefixes, pa.int64()),
                "middle_chars": pa.array(middles, pa.int64()),
                "output": pa.array(outputs, pa.string()),
            })


def draws(doc_id: Column, seed: int) -> Column:
    """The first four 32-bit groups of the digest of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def fill_in_middle(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` for every row; ``n`` counts its tokens."""
    given = pick(documents, doc_id=id_col, text=text_col)
    given = given.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), draws(F.col("doc_id"), seed).alias("draws"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(_rows, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. No piece holds a marker, so each is met once."""

    def pieces(first: str, second: str) -> tuple[Column, Column, Column]:
        before, after = (F.split_part(output, F.lit(second), F.lit(k)) for k in (1, 2))
        closing, middle = (F.split_part(after, F.lit(MIDDLE), F.lit(k)) for k in (1, 2))
        return F.split_part(before, F.lit(first), F.lit(2)), closing, middle

    prefix, suffix, middle = pieces(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = pieces(SUFFIX, PREFIX)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)
