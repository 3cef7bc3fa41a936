"""Quality rules: fixed limits on a text's form, then a log-likelihood ratio between two corpora.

Hashed byte n-grams of all texts, and of the texts a caller trusts, give two multinomials over
``BUCKETS`` buckets. The trusted one gets ``PRIOR`` counts more, dealt in proportion to all texts, so that
few trusted texts move no ratio far, and none at all give every text score 0. A text's score is the mean over its n-grams of the log of their ratio, so that
length drops out; below ``THRESHOLD`` the text reads unlike the trusted ones. The counts cover every
text and grow with the corpus; only the table of ratios, whose size is fixed, passes the driver.

Words are runs of characters other than ASCII white space. Null counts as empty: no words, which
fails the rules. Texts too short for an n-gram score 0. Rows without an id are scored as all others
but can't be trusted ones. Copies and repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songloom.llm.common import lean, pick
from songloom.llm.words import Words, mix, windows, word_chunks

SYMBOLS = "#*$%&|<>"  # fixed by the rules
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 10, 20, 5  # fixed by the rules
GRAM, BUCKETS = 4, 1 << 16
THRESHOLD = -0.15
PRIOR = 16 * BUCKETS  # n-grams of all texts that the trusted ones are filled up with
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
MEASURE_SCHEMA = (
    "doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"
)


def grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte n-grams (a newline ends each text), and how many each text has."""
    data = words.data.astype(np.uint32)
    windows_ = max(0, len(data) - GRAM + 1)
    value = np.zeros(windows_, np.uint32)
    for k in range(GRAM):
        value |= data[k : k + windows_] << np.uint32(8 * k)
    beyond = np.zeros(len(data), bool)
    for back in range(GRAM - 1):  # these would reach into the next text
        at = words.end - back
        beyond[at[at >= words.begin]] = True
    buckets = (value * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return buckets[~beyond[:windows_]], np.maximum(words.end - words.begin - (GRAM - 2), 0)


def repeated_words(words: Words) -> np.ndarray:
    """For each text the words covered by windows that occur twice or more in it."""
    n = len(words.begin)
    of_word = words.of_word()
    hashes = windows(words.hashes(), WINDOW)
    begins = np.flatnonzero(of_word[: len(hashes)] == of_word[WINDOW - 1 :]) if len(hashes) else np.zeros(0, np.int64)
    keyed = mix(hashes[begins] + of_word[begins].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, which, counts = np.unique(keyed, return_inverse=True, return_counts=True)
    twice = begins[counts[which] > 1]
    edge = np.zeros(len(of_word) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    covered = np.cumsum(edge)[:-1] > 0
    return np.bincount(of_word[covered], minlength=n)


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


@lean
def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, words in word_chunks(batch["text"]):
            total += np.bincount(grams(words)[0], minlength=BUCKETS)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(seen, pa.int32()), "n": pa.array(total[seen], pa.int64())})


def gram_counts(texts: DataFrame) -> DataFrame:
    """``(bucket, n)`` over all texts: each task sends at most one row for each bucket."""
    rows = texts.select("text").mapInArrow(_gram_counts, "bucket int, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def _both_counts(documents: DataFrame, trusted: DataFrame) -> np.ndarray:
    """The counts of all texts and of the trusted ones, for each bucket."""
    raw = gram_counts(documents).select("bucket", "n", F.lit(0).cast("long").alias("t"))
    target = gram_counts(trusted).select("bucket", F.lit(0).cast("long").alias("n"), F.col("n").alias("t"))
    counts = np.zeros((2, BUCKETS))
    both = raw.union(target).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    for bucket, n, t in both.collect():  # at most BUCKETS rows
        counts[:, bucket] = (n, t)
    return counts


def smoothed_log_ratios(documents: DataFrame, trusted: DataFrame) -> np.ndarray:
    """``log(trusted / raw)`` for each bucket, the trusted texts, part of all, filled up with ``PRIOR`` raw counts.

    Without trusted texts all ratios are 0, and so are those of buckets that no text has.
    """
    raw, target = _both_counts(documents, trusted)
    seen = raw > 0
    ratios = np.zeros(BUCKETS)
    ratios[seen] = np.log((target[seen] / raw[seen] * raw.sum() + PRIOR) / (target.sum() + PRIOR))
    return ratios.astype(np.float32)


def _measures(ratios: np.ndarray):
    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in word_chunks(batch["text"]):
                n = len(words.begin)
                letter = np.zeros(len(words.data) + 1, np.int8)
                letter[words.start] = 1
                letter[words.stop] -= 1
                head = (words.data & 0xC0) != 0x80
                buckets, number = grams(words)
                owner = np.repeat(np.arange(n), number)
                total = np.bincount(owner, weights=ratios[buckets], minlength=n)
                raw = words.data.tobytes()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch["doc_id"].slice(row, n),
                    "n_words": pa.array(np.diff(words.first), pa.int64()),
                    "word_chars": pa.array(words.per_text(head & (np.cumsum(letter)[:-1] > 0)), pa.int64()),
                    "n_symbols": pa.array(words.per_text(_IS_SYMBOL[words.data]), pa.int64()),
                    "n_dup_lines": pa.array([repeated_lines(raw[a:b]) for a, b in zip(words.begin, words.end)], pa.int64()),
                    "n_repeat_words": pa.array(repeated_words(words), pa.int64()),
                    "score": pa.array(total / np.maximum(number, 1), pa.float64()),
                })

    return rows


def quality_verdicts(
    documents: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row for each document: the measures, ``base_failed``, ``score`` and ``kept``.

    ``trusted_ids`` has one column, the ids of documents to take as the target.
    """
    given = pick(documents, doc_id=id_col, text=text_col)
    # Merged at every size: whether the ids would fit a broadcast says nothing about larger tables.
    ids = trusted_ids.toDF("doc_id").filter("doc_id is not null").hint("merge")
    ratios = smoothed_log_ratios(given, given.join(ids, "doc_id", "left_semi"))
    schema = MEASURE_SCHEMA.format(id=given.schema["doc_id"].dataType.simpleString())
    measured = given.mapInArrow(_measures(ratios), schema)
    repeats = F.lit(100) * F.col("n_repeat_words") > F.lit(MOST_REPEATED_PERCENT) * F.col("n_words")
    failed = (F.col("n_words") < LEAST_WORDS) | repeats
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))
