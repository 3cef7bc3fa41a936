"""Neighbours against brute force: recall, order, ties, and rows that take no part."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from songloom.llm.nearest import (
    calibrated_visits, fit_tree, leaf_sizes, nearest_neighbours, tree_of, usable_vectors,
)

SCHEMA = "vec_id long, embedding array<float>, leaf int"


def brute(ids, vectors, query, k):
    score = (vectors[query] * vectors).sum(axis=1)
    order = [i for i in np.lexsort((ids, -score)) if i != query][:k]
    return [(int(ids[i]), score[i]) for i in order]


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(4)
    centers = r.normal(size=(12, 16))
    vectors = (centers[r.integers(0, 12, 3000)] + 0.3 * r.normal(size=(3000, 16))).astype(np.float32)
    vectors[1000:2000] = 3 * vectors[1000]  # a third of all rows are one long vector
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    bad = [
        (4000, None, 1), (4020, [0.0] * 16, 1), (4040, [float("nan")] + [1.0] * 15, 1), (4060, [None] + [1.0] * 15, 1),
        (4080, [float("inf")] * 16, 1), (4100, [1.0] * 3, 1), (None, [1.0] * 16, 1), (20, rows[20][1], 1), (4120, [], 1),
    ]
    return np.arange(3000), vectors.astype(float), spark.createDataFrame(rows + bad, SCHEMA)


def test_recall_order_and_ties(table):
    ids, vectors, frame = table
    got = defaultdict(list)
    for g in nearest_neighbours(frame, frame.filter("vec_id % 20 = 0")).collect():
        got[g.query_id].append((g.rank, g.vec_id, g.score))
    assert sorted(got) == list(range(0, 3000, 20))
    hits = 0
    for query, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and query not in [f[1] for f in found]
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        true = brute(ids, vectors, query, 20)
        hits += len({f[1] for f in found} & {t[0] for t in true})
        exact = {i: (vectors[query] * vectors[i]).sum() for _, i, _ in found}
        assert all(np.isclose(s, exact[i], rtol=1e-13, atol=1e-13) for _, i, s in found)
    assert hits / (20 * len(got)) >= 0.95
    ties = {f[1] for f in got[1500]}
    assert ties == set(range(1000, 1020))


def test_fewer_candidates_than_asked(spark):
    rows = [(i, [1.0, float(i)], 1) for i in range(5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = nearest_neighbours(frame, frame.filter("vec_id = 0")).collect()
    assert sorted((g.rank, g.vec_id) for g in got) == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_queries_of_another_length(spark):
    rows = [(i, [1.0, float(i)] if i % 20 else [1.0, 2.0, 3.0], 1) for i in range(1, 200)] + [(400, [1.0, 0.5], 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = nearest_neighbours(frame, frame.filter("vec_id % 20 = 0"), 3).collect()
    assert sorted((g.query_id, g.rank, g.vec_id) for g in got) == [(400, 1, 199), (400, 2, 198), (400, 3, 197)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest_neighbours(empty, empty).count() == 0
    one = spark.createDataFrame([(20, [1.0, 2.0], 1)], SCHEMA)
    assert nearest_neighbours(one, one).count() == 0


def test_every_vector_has_a_leaf_and_walks_reach_all():
    r = np.random.default_rng(5)
    vectors = r.normal(size=(2500, 8))
    tree = fit_tree(vectors)
    assert len(tree.leaves) > 10
    leaf = tree.leaf_of(vectors)
    assert set(leaf) == set(range(len(tree.leaves)))
    assert sorted(tree.leaf_order(vectors[0], len(tree.leaves))) == list(range(len(tree.leaves)))
    assert tree.leaf_order(vectors[0], 5) == tree.leaf_order(vectors[0], 9)[:5]


def test_usable(table):
    assert usable_vectors(table[2]).count() == 3000


def test_outliers_beside_large_groups(spark):
    r = np.random.default_rng(6)
    centers = 10 * np.eye(16)
    vectors = (centers[r.integers(0, 8, 4000)] + 1e-3 * r.normal(size=(4000, 16))).tolist()
    vectors += (centers[[9, 9, 9, 12, 12]] * 40 + r.normal(size=(5, 16))).tolist()
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], SCHEMA)
    got = defaultdict(int)
    for g in nearest_neighbours(frame, frame.filter("vec_id % 20 = 0 or vec_id >= 4000")).collect():
        got[g.query_id] += 1
    assert len(got) == 205 and set(got.values()) == {20}


def test_leaves_follow_the_table(spark):
    r = np.random.default_rng(7)
    centers = r.normal(size=(600, 24))
    shares, counts = [], []
    for n in (20_000, 100_000):
        vectors = centers[r.integers(0, 600, n)] + 0.1 * r.normal(size=(n, 24))
        vectors[: n // 3] = vectors[0]  # one leaf that no split can cut
        frame = spark.createDataFrame(list(zip(range(n), vectors.tolist())), "vec_id long, embedding array<double>")
        usable = usable_vectors(frame)
        tree, indexed = tree_of(usable, vectors[r.choice(n, 2000, replace=False)])
        held = leaf_sizes(tree, indexed)
        assert held.sum() == n
        asked = usable.filter(f"vec_id >= {n // 3} and vec_id % 50 = 0")
        visits = calibrated_visits(tree, indexed, asked, 20, 0.98)
        queries = r.choice(np.arange(n // 3, n), 100, replace=False)
        orders = [tree.leaf_order(vectors[q], visits, held, 21) for q in queries]
        shares.append(np.median([held[o].sum() / n for o in orders]))
        counts.append(len(tree.leaves))
        leaf, hits = tree.leaf_of(vectors), 0
        for q, order in zip(queries, orders):
            true = [i for i, _ in brute(np.arange(n), vectors, q, 20)]
            hits += sum(leaf[i] in order for i in true)
        assert hits / 2000 >= 0.95
        assert np.sort(held)[-2] <= 1600  # near SPLIT_ROWS, but for the copies
    # 2,000 fitted vectors alone would leave the part of the table that a query reads as it is.
    assert counts[1] > 4 * counts[0] and shares[1] < 0.1 and shares[1] < shares[0] / 2


def test_split_leaves_give_the_same_neighbours(spark):
    r = np.random.default_rng(8)
    centers = r.normal(size=(30, 12))
    vectors = centers[r.integers(0, 30, 6000)] + 0.2 * r.normal(size=(6000, 12))
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>, below int")
    got = defaultdict(set)
    for g in nearest_neighbours(frame, frame.filter("vec_id % 20 = 0"), fit_rows=300).collect():
        got[g.query_id].add(g.vec_id)
    hits = sum(len(got[q] & {i for i, _ in brute(np.arange(6000), vectors, q, 20)}) for q in range(0, 6000, 20))
    assert len(got) == 300 and hits / 6000 >= 0.95
