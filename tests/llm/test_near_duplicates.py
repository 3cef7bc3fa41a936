"""Near-duplicate classes against all pairs compared by brute force."""

import random
from math import comb

from songloom.llm.near_duplicates import (
    CHUNK, CHUNKS, GUARANTEED, MAX_DISTANCE, VALUES, keep_one_of_each, near_duplicate_classes, signature, signature_keys,
)
import numpy as np


def brute(rows, width):
    sets = {}
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = [x for x in low.replace("\t", " ").replace("\n", " ").split(" ") if x]
        grams = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)}
        sets[i] = grams if w else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                shared = len(sets[a] & sets[b])
                if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def made():
    r = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = [(0, ""), (1, None), (2, " \n\t "), (3, "one"), (4, "ONE"), (5, "one two"), (6, "é ß"), (7, "É ß")]
    common = [r.choice(vocabulary) for _ in range(60)]
    for group in range(12):
        base = [r.choice(vocabulary) for _ in range(r.choice([5, 30, 120]))] + common
        for _ in range(8):
            copy = [x if r.random() > 0.04 else r.choice(vocabulary) for x in base]
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + k, "same words again and again " * 3) for k in range(40)]
    rows.append((len(rows), " ".join(r.choice(vocabulary) for _ in range(30000))))
    return rows


def test_classes_equal_all_pairs(spark):
    rows = made()
    frame = spark.createDataFrame([(i, t, "x", i) for i, t in rows], "doc_id long, text string, n string, sig long")
    for width in (2, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicate_classes(frame, width=width).collect()}
        assert got == brute(rows, width)


def test_exact_mode_loses_no_link(spark):
    rows = made()
    r = random.Random(11)
    base = [f"v{k}" for k in range(300)]
    # Chains and pairs just at the threshold, and passages that many documents share without being near.
    for k in range(60):
        cut = r.randrange(280)
        rows.append((len(rows), " ".join(base[:cut] + [f"u{k}x{j}" for j in range(r.choice([10, 28, 29, 30, 31, 60]))] + base[cut:])))
    rows += [(len(rows) + k, " ".join(base[100:160] + [f"p{k}q{j}" for j in range(200)])) for k in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 2)
    lossy = near_duplicate_classes(frame, width=2, distance=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in lossy} != want
    got = near_duplicate_classes(frame, width=2, exact=True, distance=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    empty = spark.createDataFrame([(1, None), (2, ""), (None, "a b")], frame.schema)
    assert sorted(tuple(r) for r in near_duplicate_classes(empty, exact=True).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_pairs_in_reach_share_a_key():
    r = np.random.default_rng(1)
    a = r.integers(0, 256, (300, VALUES), dtype=np.uint8)
    b = a.copy()
    for row in b:
        row[r.choice(VALUES, GUARANTEED, replace=False)] += 1
    assert all(set(x) & set(y) for x, y in zip(signature_keys(a), signature_keys(b)))


def test_the_guarantee_reaches_the_threshold():
    assert MAX_DISTANCE == GUARANTEED
    # Links at the least similarity that lie beyond it: the tail of as many draws.
    tail = sum(comb(VALUES, k) * 0.2**k * 0.8 ** (VALUES - k) for k in range(MAX_DISTANCE + 1, VALUES + 1))
    assert tail < 2e-5


def test_signatures_estimate_similarity():
    r = np.random.default_rng(2)
    differing = []
    for _ in range(200):
        values = np.unique(r.integers(0, 1 << 63, 900, dtype=np.uint64))
        differing.append((signature(values[:800]) != signature(values[100:])).sum())
    expected = VALUES * (1 - 700 / 900) * 255 / 256
    assert abs(np.mean(differing) - expected) < 1 and np.std(differing) < 5
    assert VALUES == CHUNK * CHUNKS


def test_empty_null_and_repeated_ids(spark):
    schema = "doc_id long, text string"
    assert near_duplicate_classes(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c"), (1, "a b c"), (2, "a b c"), (None, "a b c"), (3, "a b c d e f g")]
    frame = spark.createDataFrame(rows, schema)
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicate_classes(frame).collect())
    assert got == [(1, 1, True), (2, 1, False), (3, 3, True)]
    kept = sorted(keep_one_of_each(frame).collect(), key=str)
    assert [r.doc_id for r in kept] == [1, 3, None]


def test_an_id_with_several_texts(spark):
    long = " ".join(f"w{k}" for k in range(80))
    near, small = long + " more", " ".join(f"v{k}" for k in range(40))
    rows = [(1, None), (1, ""), (1, small), (1, long), (1, long), (1, " \n"), (2, near), (2, None), (3, small), (4, small + " x"), (4, "")]
    for some in (rows, rows[::-1]):
        frame = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicate_classes(frame).collect())
        assert got == [(1, 76, 1), (2, 77, 1), (3, 36, 3), (4, 37, 3)]
        assert sorted(tuple(r) for r in keep_one_of_each(frame).collect()) == [(1, long), (3, small)]
