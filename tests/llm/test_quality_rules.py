"""Quality rules against a plain recomputation, and separation of planted junk."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from songloom.llm.quality_rules import BUCKETS, PRIOR, grams, quality_verdicts, smoothed_log_ratios
from songloom.llm.words import word_chunks

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(i, i + 5))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(2)
    good = ["the", "winding", "river", "of", "stones", "naïve", "was", "here"]
    rows = []
    for i in range(400):
        words = r.choices(good, k=r.randint(10, 60))
        if i % 4 == 0:
            words = [w + r.choice(["***", "$$$", "###"]) for w in words]
        if i % 7 == 0:
            words = words[:6] * 4
        rows.append((i, "".join(w + r.choice([" ", " ", "\n", " \t", " x "]) for w in words)))
    rows += [(-1, None), (-2, ""), (-3, "\n\n \n"), (-4, "x"), (None, "a b c d e " * 50), (5, rows[5][1])]
    rows.append((900, "long words " + " ".join(r.choices(good, k=200_000))))
    rows.append((901, "same line\nsame line\n same line\n\n\nsame line\r\nsame line"))
    return rows, spark.createDataFrame([(i, t, 3, "s") for i, t in rows], "doc_id long, text string, n_words int, score string")


def test_measures_equal_plain_ones(spark, corpus):
    rows, frame = corpus
    trusted = spark.createDataFrame([(i,) for i in range(400) if i % 4] + [(900,), (None,)], "doc_id long")
    got = quality_verdicts(frame, trusted).collect()
    found = Counter((g.doc_id, g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) for g in got)
    assert found == Counter((i, *plain(t)) for i, t in rows)
    for g in got:
        if g.doc_id is not None and 0 <= g.doc_id < 400 and not g.base_failed:
            assert g.kept == (g.doc_id % 4 != 0), g
        assert not (g.base_failed and g.kept)


def test_ratios_count_everything(spark):
    texts = ["abcd", "abc", "", "abcdabcd", "é"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    ratios = smoothed_log_ratios(frame, frame.filter("text = 'abcd'"))
    each = []
    for _, words in word_chunks(pa.array(texts)):
        found, number = grams(words)
        assert number.tolist() == [2, 1, 0, 6, 0]
        each += np.split(found, np.cumsum(number)[:-1])
    raw, target = Counter(np.concatenate(each).tolist()), Counter(each[0].tolist())
    want = np.zeros(BUCKETS)
    for bucket, n in raw.items():
        filled = target[bucket] + PRIOR * n / raw.total()  # trusted counts and as many raw ones as the prior has
        want[bucket] = math.log(filled / (target.total() + PRIOR)) - math.log(n / raw.total())
    assert np.allclose(ratios, want, atol=1e-6)

    documents = frame.select(F.hash("text").alias("doc_id"), "text")
    trusted = documents.filter("text = 'abcd'").select("doc_id")
    scores = {r.doc_id: r.score for r in quality_verdicts(documents, trusted).collect()}
    hashes = {r.text: r.doc_id for r in documents.collect()}
    for text, found in zip(texts, each):
        assert abs(scores[hashes[text]] - (want[found].mean() if len(found) else 0)) < 1e-6


def test_empty_table_and_no_trusted(spark, corpus):
    none = spark.createDataFrame([], "doc_id long")
    assert quality_verdicts(spark.createDataFrame([], "doc_id long, text string"), none).count() == 0
    assert quality_verdicts(corpus[1], none).count() == len(corpus[0])


def test_verdicts_with_few_and_no_trusted(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").orderBy("doc_id").collect()
    good = [r.doc_id for r in labels if r.quality == 1 and r.toxic == 0]
    poor = {r.doc_id for r in labels if r.quality == 0}
    for trusted in ([-5], good[:20], good[:100], good):
        got = quality_verdicts(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id long")).collect()
        fine = [g for g in got if not g.base_failed]
        clean = [g.kept for g in fine if g.doc_id in set(good)]
        assert np.mean(clean) > 0.99, len(trusted)
        if not set(trusted) & set(good):
            assert all(g.score == 0 and g.kept != g.base_failed for g in got)
    assert np.mean([g.kept for g in got if g.doc_id in poor]) < 0.2
