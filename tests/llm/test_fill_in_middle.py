"""Cuts, forms and round trips against a plain recomputation with a regular expression."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from songloom.llm.fill_in_middle import BoundarySet, _Array, _Bitmap, _Runs, fill_in_middle, restored

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@given(st.sets(st.integers(0, 400_000), max_size=300), st.lists(st.tuples(st.integers(0, 300_000), st.integers(1, 3000)), max_size=3))
@settings(max_examples=150, deadline=None)
def test_select_of_any_set(values, runs):
    whole = sorted(values.union(*[range(a, a + n) for a, n in runs]))
    found = BoundarySet(np.array(whole, np.int64))
    assert [found.select(k) for k in range(len(whole))] == whole
    with pytest.raises(IndexError):
        found.select(len(whole))


def test_all_kinds_of_containers():
    evens, run, few = np.arange(0, 65_536, 2), np.arange(65_536, 100_000), np.array([200_000, 200_007])
    found = BoundarySet(np.r_[evens, run, few])
    assert [type(c) for c in found.containers] == [_Bitmap, _Runs, _Array]
    assert [found.select(k) for k in range(found.size)] == np.r_[evens, run, few].tolist()


def plain(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    low, high = sorted(x % (len(tokens) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(tokens[:low]), "".join(tokens[low:high]), "".join(tokens[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(tokens), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(tokens), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(tokens), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_documents(spark):
    r = random.Random(13)
    pieces = ["a", "é", "日本", "😀x", " ", "\n", "\t", "\x0b", "\x1c", " ", "<", "S>", "<S", "<P>", "\0"]
    texts = [None, "", " ", "   \n", "x", " x", "x ", "<M>", "a" * 70_000, " " * 70_000, "a " * 200_000, "é \n" * 100_000 + " "]
    texts += ["".join(r.choices(pieces, [9, 5, 5, 5, 9, 5, 2, 2, 2, 2, 2, 2, 2, 0.2, 1], k=r.randint(0, 60))) for _ in range(600)]
    rows = [(i - 3 if i else None, t, "other", i) for i, t in enumerate(texts)] + [(5, "a b c", "twice", 0), (5, "a b c", "twice", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, output string, n int")
    made = fill_in_middle(frame)
    got = sorted(map(tuple, made.collect()), key=str)
    assert got == sorted([(d, *plain(d, t)) for d, t, *_ in rows], key=str)
    forms = {g[2] for g in got}
    assert forms == {"plain", "spm", "psm"}
    back = made.select("doc_id", restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(tuple, back), key=str) == sorted([(d, t or "") for d, t, *_ in rows], key=str)


def test_empty_table_and_text_ids(spark):
    assert fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = fill_in_middle(spark.createDataFrame([("a1", "x y z")], "name string, body string"), "name", "body").first()
    assert (got.doc_id, got.n) == ("a1", 3)
