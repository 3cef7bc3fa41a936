"""Tags of a header found by plain search, and song files that are made once for all their readers."""

import datetime
import random

from checks import queries as Q
from songloom.operators import tagged_text as T


def test_tags_are_found_without_patterns_over_the_header(spark):
    files = spark.createDataFrame([("1.isb.txt", "\\film{a}\n")], "source_file string, content string")
    assert r"\A.*^" not in T.parse_songs(files)._jdf.queryExecution().optimizedPlan().toString()


def test_the_last_line_with_a_tag_counts(spark):
    draw = random.Random(3)
    bits = ["\\film", "\\music", "{a}", "{", "}", "\n", "\n", " x", "{{b}", "\u00e9", "\u2028", "\\film{ q } ", "\\filmed{c}"]
    headers = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 12))) for _ in range(500)]

    def expected(header, tag):
        lines = [line[len(tag) :] for line in header.split("\n") if line.startswith(tag)]
        after = lines[-1].partition("{") if lines else ("", "", "")
        return after[2].partition("}")[0].strip() if "}" in after[2] else ""

    rows = spark.createDataFrame([*((h,) for h in headers), (None,)], "header string")
    got = rows.select("header", *[T.last_tag_value(rows["header"], f).alias(f) for f in ("film", "music")]).collect()
    for row in got:
        if row.header is None:
            assert row.film is None and row.music is None
        else:
            assert (row.film, row.music) == (expected(row.header, "\\film"), expected(row.header, "\\music"))


def test_song_files_are_made_once_for_two_runs(spark, tmp_path, monkeypatch):
    day = datetime.datetime(1995, 1, 2)
    tables = {
        "nation": ([(1, "NATION_1", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "Customer#1", 1)], "c_custkey long, c_name string, c_nationkey int"),
        "supplier": ([(1, "Supplier#1")], "s_suppkey long, s_name string"),
        "part": ([(1, "blue ring", 3)], "p_partkey long, p_name string, p_size int"),
        "orders": ([(k, 1, "O", day, "1-URGENT") for k in range(3)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(k, 1, 1) for k in range(3)], "l_orderkey long, l_partkey long, l_suppkey long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    taken = []
    monkeypatch.setattr(Q, "build_catalogue", lambda **sources: taken.append(sources["files"]))
    Q.QUERIES["catalogue_from_answers"](spark, str(tmp_path))
    Q.QUERIES["catalogue"](spark, str(tmp_path))
    assert len(taken) == 3
    for files in taken:
        assert files.count() == 3 and all("/stage-" in path for path in files.inputFiles())
