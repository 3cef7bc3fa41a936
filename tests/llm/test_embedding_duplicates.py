"""Links and classes against brute force, with large groups of copies and vectors that take no part."""

import numpy as np
import pytest

from songloom.llm import embedding_duplicates as ed
from songloom.llm.embedding_duplicates import embedding_classes, near_pairs, unit_rows


def brute(ids, vectors, threshold=0.9):
    units = vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]
    linked = units @ units.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.arange(len(ids))
    while True:
        new = np.minimum(label, np.where(linked, label, len(ids)).min(axis=1))
        if np.array_equal(new, label):
            return {int(i): (int(n), int(ids[m])) for i, n, m in zip(ids, linked.sum(axis=1), label)}
        label = new


def classes(frame, **more):
    rows = embedding_classes(frame, **more).collect()
    assert len(rows) == len({r.vec_id for r in rows}) and all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return {r.vec_id: (r.n_links, r.component_id) for r in rows}


def corpus(r, length=24):
    loose = r.normal(size=(500, length))
    group = r.normal(size=length) + 0.02 * r.normal(size=(900, length))  # a third are near copies of one
    chain = np.cumsum(0.15 * r.normal(size=(200, length)), axis=0) + 3 * r.normal(size=length)
    pairs = loose[:150] * r.uniform(0.1, 9, size=(150, 1)) + 0.2 * r.normal(size=(150, length))
    equal = np.repeat(loose[200:204], 100, axis=0)
    spread = 4 * r.normal(size=length) + r.uniform(0.2, 1.2, size=(400, 1)) * r.normal(size=(400, length))
    return np.concatenate([loose, group, chain, pairs, equal, spread])


@pytest.mark.parametrize("tile", [64, 8192])
def test_all_links(spark, monkeypatch, tile):
    monkeypatch.setattr(ed, "TILE_ROWS", tile)
    r = np.random.default_rng(12)
    vectors = corpus(r).astype(np.float32)
    ids = r.permutation(len(vectors)) * 3 - 100
    order = np.argsort(ids)
    frame = spark.createDataFrame([(int(i), v.tolist(), 1, 2) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>, label int, n int")
    want = brute(ids[order], vectors[order].astype(float))
    assert classes(frame) == want
    assert sum(n for n, _ in want.values()) > 500_000


def test_bad_vectors_lengths_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [3.0, 4.0]), (2, [6.0, 8.0]), (3, [4.0, -3.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [None, 1.0]), (8, [inf, 1.0]),
        (9, []), (10, [1.0, 2.0, 3.0]), (11, [1.0, 2.0, 3.1]), (None, [3.0, 4.0]), (12, [1e300, 1e300]), (13, [1e-300, 1e-300]),
        (14, [3.0, 4.0]), (15, [0.0, 0.0]), (15, [-1.0, 0.0]), (15, [-1.0, -0.0]),
    ]
    got = classes(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    alone = {i: (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 15)}
    group = {i: (4, 1) for i in (1, 2, 12, 13, 14)}  # 3:4 and 1:1 have a cosine of 0.99
    assert got == alone | group | {10: (1, 10), 11: (1, 10)}


def test_the_threshold_itself(spark):
    # The cosine of (1, 0, 0, 0) and (9, 1, 3, 3) is 9 / 10; a little less is no link.
    vectors = [[1, 0, 0, 0], [9, 1, 3, 3], [0, 0, 0, 1], [0, 1, 18**0.5, 9 - 1e-10]]
    rows = [(i + 1, [float(x) for x in v]) for i, v in enumerate(vectors)]
    assert classes(spark.createDataFrame(rows, "vec_id long, embedding array<double>")) == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4)}


def test_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert classes(spark.createDataFrame([], schema)) == {}
    assert classes(spark.createDataFrame([(1, None), (2, [0.0])], schema)) == {1: (0, 1), 2: (0, 2)}
    with pytest.raises(ValueError):
        embedding_classes(spark.createDataFrame([], schema), threshold=0)


@pytest.mark.parametrize("threshold", [0.3, 0.9])
def test_no_pair_is_stopped_too_early(threshold):
    r = np.random.default_rng(1)
    left, right = (unit_rows(r.normal(size=(n, 12)) * np.linspace(3, 0.1, 12)) for n in (700, 300))
    found = {(int(i), int(j)) for a, b, _ in near_pairs(left, right, threshold, False) for i, j in zip(a, b)}
    assert found == {(int(i), int(j)) for i, j in zip(*np.nonzero(left @ right.T >= threshold - ed.SLACK))}
    same = {(int(i), int(j)) for a, b, _ in near_pairs(left, left, threshold, True) for i, j in zip(a, b)}
    assert same == {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(left @ left.T >= threshold - ed.SLACK, 1)))}
