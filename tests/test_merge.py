"""Merge, order, shape, summary and sinks."""

import pytest
from pyspark.sql import functions as F

from songloom.operators.merge import SCRAPED_FIELDS, choose_source, last_per_id, merge_sources
from songloom.operators.shape import (
    CATALOGUE_COLUMNS, complete_columns, export_ready, file_key, first_n, merge_key,
)
from songloom.operators.summary import distinct_films, run_counters, summarise
from songloom.operators.tagged_text import parse_songs
from songloom.plans.catalogue import build_catalogue, load_songs
from songloom.sources.csv_sink import read_csv, write_csv
from songloom.sources.files import require_rows

FILE = (
    "isb_id int, stitle string, film string, year int, starring string, singer string, music string, "
    "lyricist string, lyrics_itrans string, source_file string"
)
SCRAPED = (
    "isb_id int, stitle string, film string, year int, starring string, singer string, music string, "
    "lyricist string, lyrics_rendered string"
)


def file_row(number, name, film="F", year=1970):
    return (number, "t", film, year, "", "s", "m", "l", "raw " + name, name)


def scraped_row(number, film="S", year=1980):
    return (number, "T", film, year, "c", "S", "M", "L", "shown")


@pytest.fixture
def files(spark):
    rows = [
        file_row(7, "7.isb.txt", "old"), file_row(7, "007.isb.txt", "older"), file_row(1, "1.isb.txt"),
        file_row(None, "a.isb.txt"), file_row(None, "b.isb.txt"), file_row(0, "0.isb.txt"),
    ]
    return spark.createDataFrame(rows, FILE)


@pytest.fixture
def scraped(spark):
    return spark.createDataFrame([scraped_row(1, "", None), scraped_row(9)], SCRAPED)


def test_last_per_id(files):
    assert {r.isb_id: r.source_file for r in last_per_id(files).collect()} == {
        7: "7.isb.txt", 1: "1.isb.txt", None: "b.isb.txt", 0: "0.isb.txt"
    }


def test_merge(files, scraped):
    rows = {r.isb_id: r for r in merge_sources(files, scraped).collect()}
    assert set(rows) == {None, 0, 1, 7, 9}
    assert (rows[1].film, rows[1].year, rows[1].stitle) == ("", None, "T")
    assert (rows[1].lyrics_itrans, rows[1].lyrics_rendered, rows[1].source_file) == ("raw 1.isb.txt", "shown", "1.isb.txt")
    assert (rows[9].lyrics_itrans, rows[9].source_file) == (None, None)
    assert rows[7].lyrics_rendered is None and rows[7].film == "old"


def test_merge_filling_blanks(files, scraped):
    row = {r.isb_id: r for r in merge_sources(files, scraped, fill_blanks=True).collect()}[1]
    assert (row.film, row.year, row.singer) == ("F", 1970, "S")


def test_a_null_scraped_id_meets_the_null_file_id(files, spark):
    rows = merge_sources(files, spark.createDataFrame([scraped_row(None)], SCRAPED)).collect()
    assert [r.source_file for r in rows if r.isb_id is None] == ["b.isb.txt"]
    assert len(rows) == 4


def test_merge_shuffles_each_side_once(files, scraped, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge_sources(files, scraped)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_source_choice(files, scraped):
    assert choose_source(files, None).count() == 6
    assert choose_source(files, scraped.limit(0)).count() == 6
    assert choose_source(files.limit(0), scraped).count() == 2
    assert choose_source(files, scraped).count() == 5
    with pytest.raises(ValueError):
        choose_source(None, None)
    with pytest.raises(ValueError):
        require_rows(files.limit(0), "the file source")


def test_orders_and_limit(files, scraped):
    names = [r.source_file for r in first_n(files, 4, file_key()).collect()]
    assert names == ["0.isb.txt", "a.isb.txt", "b.isb.txt", "1.isb.txt"]
    merged = merge_sources(files, scraped)
    assert {r.isb_id for r in first_n(merged, 2, merge_key(merged.columns)).collect()} == {None, 0}
    assert first_n(files, 0, file_key()).count() == first_n(files, None, file_key()).count() == 6
    assert [r.isb_id for r in export_ready(merged).collect()] == [0, 1, 7, 9, None]
    with pytest.raises(ValueError):
        first_n(files, -1, file_key())


def test_column_contract(files):
    done = complete_columns(files.withColumn("extra", F.lit(1)))
    assert done.columns == list(CATALOGUE_COLUMNS)
    assert done.first().imdb_film_id is None


def test_summary(files, spark):
    row = summarise(files).first()
    assert (row.total_songs, row.films_covered, row.first_year, row.matched_percent) == (6, 3, 1970, None)
    ids = files.withColumn("imdb_film_id", F.when(F.col("isb_id") == 1, "tt1"))
    assert summarise(ids).first().matched_percent == 16.7
    assert summarise(files.withColumn("year", F.lit(None).cast("int"))).first().first_year is None
    assert distinct_films(files).count() == 3
    counts = run_counters(spark.createDataFrame([("saved",), ("saved",), ("failed",)], "outcome string"))
    assert {r.outcome: r.n for r in counts.collect()} == {"saved": 2, "failed": 1}


def test_csv_sink(spark, tmp_path):
    rows = [
        (1, 'say "x", y', " lead", 1977, "", "a\nb", None, "", "l", "1.isb.txt"),
        (None, "t", "f", None, "", "s", "m", "l", "z", "x.isb.txt"),
    ]
    songs = spark.createDataFrame(rows, FILE)
    write_csv(songs, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("part-*.csv"))
    text = b"".join(p.read_bytes() for p in parts)
    assert parts[0].read_bytes().startswith(b"\xef\xbb\xbfisb_id,stitle,film,year,")
    assert b'1,"say ""x"", y", lead,1977,,"a\nb",,,l,,,,,,1.isb.txt\n' in text
    assert b"\n,t,f,,," in text
    back = {r.source_file: r for r in read_csv(spark, str(tmp_path / "out")).collect()}
    assert back["1.isb.txt"].singer == "a\nb" and back["1.isb.txt"].year == 1977


def test_build_without_catalogues(spark, files, scraped):
    raw = spark.createDataFrame([("3.isb.txt", "\\film{F}\n"), ("2.isb.txt", "\\film{G}\n")], "source_file string, content string")
    done = build_catalogue(files=raw, scraped=scraped, limit=2)
    assert done.columns == list(CATALOGUE_COLUMNS)
    assert sorted(r.isb_id for r in done.collect()) == [1, 2]
    assert load_songs(files=raw, limit=1).first().isb_id == 2
    one = spark.createDataFrame([("9", "F", None, 0)], "cand_id string, cand_title string, cand_year int, rank int")
    assert {r.imdb_film_id for r in build_catalogue(files=raw, films=one).collect()} == {"tt9", None}


def test_a_limit_parses_and_merges_the_first_ids_only(spark):
    raw = spark.range(3_000).select(
        F.when(F.col("id") % 100 == 0, F.concat(F.lit("x"), "id")).otherwise(F.col("id").cast("string")).alias("name")
    ).select(F.concat("name", F.lit(".isb.txt")).alias("source_file"), F.concat(F.lit("\\film{"), "name", F.lit("}")).alias("content"))
    other = spark.range(3_000).select(
        F.when(F.col("id") != 7, F.col("id") * 2).cast("int").alias("isb_id"), F.lit(1990).alias("year"),
        *[F.lit("s").alias(c) for c in SCRAPED_FIELDS if c != "year"],
    ).filter("isb_id is null or isb_id <> 4")
    other = other.unionByName(other.filter("isb_id = 2"))
    whole = first_n(choose_source(parse_songs(raw), other), 9, merge_key(["isb_id", "source_file"]))
    limited = load_songs(raw, other, limit=9)
    assert sorted(map(str, limited.collect())) == sorted(map(str, whole.collect()))
    plan = limited._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan  # the merge is done, on the first ids, and is not gone through again
