"""Name matching: helpers, best match, the similarity join against brute force."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from songloom.functions import similarity as S
from songloom.operators import matching as M
from songloom.operators.similarity_join import similar_keys

CAND = "lookup_key string, rank int, cand_id string, cand_title string, cand_year int"
LOOK = "lookup_key string, query string, year int"


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = row
        row = [0]
        for j, y in enumerate(b):
            row.append(previous[j] + 1 if x == y else max(previous[j + 1], row[-1]))
    return row[-1]


def score(a, b):
    return 200.0 * common(a, b) / (len(a) + len(b))


@pytest.mark.parametrize(
    "raw, name",
    [("Blue-Road-X", "blue road x"), ("  a\t\x1c b!! ", "a b"), ("Caf\u00e9_\u00e9-X", "caf\u00e9_\u00e9 x"), ("\u0915\u093f!", "\u0915"), ("?!", "")],
)
def test_normalise(evaluate, raw, name):
    assert evaluate(S.normalise_name(F.lit(raw))) == name


def test_split_names(evaluate):
    assert evaluate(S.split_names(F.lit(" A, B|C/ ,A,"))) == ["A", "B", "C", "A"]
    assert evaluate(S.split_names(F.lit(None).cast("string"))) == []


def test_token_sort_ratio(evaluate):
    ratio = lambda a, b: evaluate(S.token_sort_ratio(F.lit(a), F.lit(b)))
    assert ratio("Road, Blue", "blue road") == 100.0
    assert ratio("abc", "") == 0.0
    assert ratio("?", "!") is None
    assert ratio("kitten", "sitting") == pytest.approx(score("kitten", "sitting"))


def test_common_subsequence_any_length(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abc \u00e9\u0915\U0001f600") for _ in range(n))
    rows = [(word(rng.choice([0, 1, 5, 61, 62, 63, 124, 125, 130])), word(rng.choice([0, 2, 9, 62, 70, 140]))) for _ in range(300)]
    out = spark.createDataFrame(rows, "a string, b string").withColumn("n", S.common_subsequence(F.col("a"), F.col("b")))
    assert all(r.n == common(r.a, r.b) for r in out.collect())


def best(spark, query, titles, threshold=82.0, year=None, years=None, **options):
    lookups = spark.createDataFrame([("k", query, year)], LOOK)
    rows = [("k", i, f"c{i}", t, (years or [None] * len(titles))[i]) for i, t in enumerate(titles)]
    return M.best_match(lookups, spark.createDataFrame(rows, CAND), threshold, **options).first().cand_id


def test_best_match(spark):
    assert best(spark, "Blue", ["Devi", "Blue", "Mother Road"]) == "c1"
    assert best(spark, "Pyarii", ["Pyari", "Devi", "Guide"]) == "c0"
    assert best(spark, "Completely Different Title", ["Blue", "Devi"], 90) is None
    assert best(spark, "road blue", ["x", "Blue Road", "Road Blue"]) == "c1"
    assert best(spark, "x", []) is None
    # 41 of 50 shared on both sides is exactly 82.
    assert best(spark, "a" * 41 + "b" * 9, ["a" * 41 + "c" * 9]) == "c0"
    assert best(spark, "a" * 41 + "b" * 9, ["a" * 41 + "c" * 9], 82.1) is None


def test_exact_match(spark):
    lookups = spark.createDataFrame([("k", "Blue-Road", None), ("m", "x", None)], LOOK)
    rows = [("k", 0, "a", "road blue", None), ("k", 1, "b", "BLUE road", None), ("k", 2, "c", "blue road", None)]
    got = {r.lookup_key: r.cand_id for r in M.exact_match(lookups, spark.createDataFrame(rows, CAND)).collect()}
    assert got == {"k": "b", "m": None}


@pytest.mark.parametrize(
    "year, years, kept",
    [
        (1977, [1975, 1980, None], {0, 2}),
        (1977, [1960, 1990, 1980], {0, 1, 2}),
        (None, [1960, 1990, None], {0, 1, 2}),
        (0, [1960, 1990, 1980], {0, 1, 2}),
    ],
)
def test_year_window(spark, year, years, kept):
    lookups = spark.createDataFrame([("k", "q", year)], LOOK)
    candidates = spark.createDataFrame([("k", i, f"c{i}", "q", y) for i, y in enumerate(years)], CAND)
    assert {r.rank for r in M.year_window(lookups, candidates).collect()} == kept
    first = best(spark, "q", ["q"] * 3, year=year, years=years, use_year=True)
    assert first == f"c{min(kept)}"


def names(seed, count):
    rng = random.Random(seed)
    words = ["blue", "road", "dream", "song", "the", "aa", "aaa", "x", "\u00e9", "00", "000", "0000012", "ee"]
    out = set()
    for _ in range(count):
        text = list(" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))))
        for _ in range(rng.randint(0, 2)):
            text.insert(rng.randrange(len(text) + 1), rng.choice("abe 0"))
        out.add("".join(text).strip() or "q")
    return sorted(out)


def joined(spark, left, right, threshold):
    a = spark.createDataFrame([(x,) for x in left], "key string")
    b = spark.createDataFrame([(x,) for x in right], "key string")
    rows = similar_keys(a, b, threshold).collect()
    assert len(rows) == len({(r.left_key, r.right_key) for r in rows})
    return {(r.left_key, r.right_key): r.score for r in rows}


@pytest.mark.parametrize("threshold", [40, 66.7, 70, 78, 82, 94, 100])
def test_similarity_join_loses_nothing(spark, threshold):
    left, right = names(1, 80), names(2, 80)
    wanted = {(a, b): score(a, b) for a in left for b in right if score(a, b) >= threshold}
    assert joined(spark, left, right, threshold) == wanted


def test_similarity_join_on_near_copies(spark):
    """One group of near copies that makes up most of both sides."""
    left = [f"customer {i:09d}" for i in range(0, 60, 2)] + ["other name"]
    right = [f"custmer {i:09d}" for i in range(0, 60, 3)] + ["othr name"]
    wanted = {(a, b): score(a, b) for a in left for b in right if score(a, b) >= 94}
    assert joined(spark, left, right, 94) == wanted


@settings(max_examples=12, deadline=None)
@given(
    st.sets(st.text("ab \u00e9", min_size=1, max_size=9), min_size=1, max_size=25),
    st.sets(st.text("ab \u00e9", min_size=1, max_size=9), min_size=1, max_size=25),
    st.sampled_from([60, 78, 82]),
)
def test_similarity_join_property(spark, left, right, threshold):
    wanted = {(a, b): score(a, b) for a in left for b in right if score(a, b) >= threshold}
    assert joined(spark, sorted(left), sorted(right), threshold) == wanted


def test_threshold_must_make_sense(spark):
    keys = spark.createDataFrame([("a",)], "key string")
    for bad in (0, 101):
        with pytest.raises(ValueError):
            similar_keys(keys, keys, bad)
