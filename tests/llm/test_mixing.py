"""Mixing: targets by hand, rates against a plain solver, copies against their bounds."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from songloom.llm.mixing import capped_targets, mixed_documents, mixing_plan


def test_targets_stop_at_the_cap():
    assert capped_targets(np.array([100.0, 100.0, 100.0]), np.array([5.0, 2, 1])).tolist() == [187.5, 75.0, 37.5]
    assert capped_targets(np.array([10.0, 100.0, 100.0]), np.array([5.0, 2, 1])).tolist() == [30.0, 120.0, 60.0]
    assert capped_targets(np.array([0.0, 0.0]), np.array([5.0, 2])).tolist() == [0, 0]


def plain_rates(sizes, target, cap=3):
    c = np.array(sizes) / np.mean(sizes)
    low, high = -200.0, 200.0
    for _ in range(300):
        middle = (low + high) / 2
        given = (np.minimum(cap, np.exp(np.minimum(middle * c, 10))) * sizes).sum()
        low, high = (middle, high) if given < target else (low, middle)
    return np.minimum(cap, np.exp(np.minimum(low * c, 10)))


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(4)
    rows = []
    for i in range(3000):
        source = r.choice(["a"] * 6 + ["b", "c", "ü", None])
        rows.append((i, "w " * int(r.paretovariate(1.1) * 4), source, 1))
    rows += [(9000 + i, "copy of some words here", "a", 1) for i in range(2500)]
    rows += [(-1, None, "b", 1), (-2, "", "only empty", 1), (-3, " \n", None, 1), (5, rows[5][1], rows[5][2], 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, size int")


def test_rates_copies_and_targets(corpus):
    rows, frame = corpus
    got = mixing_plan(frame).collect()
    assert len(got) == len(rows)
    by_source = defaultdict(list)
    for g in got:
        by_source[g.source].append(g)
        assert g.taken == g.copies * g.size and 0 <= g.taken <= 3 * g.size
    total = sum(g.size for g in got)
    assert sum({g.source: g.target for g in got}.values()) == pytest.approx(total)
    for source, own in by_source.items():
        sizes = [g.size for g in own if g.size]
        assert {g.source_size for g in own} == {sum(sizes)}
        if not sizes:
            continue
        target = own[0].target
        assert abs(sum(g.taken for g in own) - target) <= max(5, 0.001 * target)
        want = plain_rates(sizes, target)
        assert np.allclose(sorted(g.rate for g in own if g.size), sorted(want), rtol=1e-5)
    again = mixing_plan(frame.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_documents_are_repeated(corpus):
    rows, frame = corpus
    expected = defaultdict(int)
    for g in mixing_plan(frame).collect():
        expected[g.doc_id] += g.copies
    found = defaultdict(int)
    mixed = mixed_documents(frame)
    assert mixed.columns == frame.columns
    for m in mixed.collect():
        found[m.doc_id] += 1
    assert found == {k: v for k, v in expected.items() if v}


def test_empty_table(spark):
    assert mixing_plan(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_rows_are_told_apart_by_all_they_hold(spark):
    rows = [(None, f"null {i} words here", "a") for i in range(3000)] + [(7, f"same id {i} here", "a") for i in range(400)]
    rows += [(i, "five words are in this", "b") for i in range(50)] + [(None, "equal rows of this one", "c")] * 2501
    frame = spark.createDataFrame([(i, t, s, None) for i, t, s in rows], "doc_id long, text string, source string, extra string")
    plan, mixed = mixing_plan(frame).collect(), mixed_documents(frame)
    assert len(plan) == len(rows) and mixed.columns == frame.columns
    found = Counter((m.doc_id, m.text) for m in mixed.collect())
    due = defaultdict(int)
    for p in plan:
        due[p.source] += p.copies
    assert {s: sum(n for (_, t), n in found.items() if len(t.split()) == size and t.startswith(w)) for s, size, w in (("b", 5, "five"), ("c", 5, "equal"))} == {s: due[s] for s in "bc"}
    of_a = [n for (i, t), n in found.items() if t.startswith(("null", "same"))]
    assert sum(of_a) == due["a"] and max(of_a) <= 3 and len(of_a) >= min(due["a"], 3400)
    copies = Counter((p.doc_id, p.copies) for p in plan if p.source == "a")
    assert copies == Counter((i, n) for (i, t), n in found.items() if t.startswith(("null", "same"))) + Counter(
        {k: n for k, n in copies.items() if k[1] == 0}
    )
