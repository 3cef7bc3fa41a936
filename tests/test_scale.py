"""Hot keys, blocks, large limits, stages that are given back, and answers kept once per key."""

import pytest
from pyspark.sql import functions as F

from songloom import build_catalogue
from songloom.operators import matching, resolve, shape, skew
from songloom.operators.resolve import attach_ids
from songloom.operators.shape import file_key, first_n
from songloom.operators.summary import JobCounters
from songloom.plans import staging
from songloom.plans.catalogue import export_catalogue
from songloom.sources import answers as A
from songloom.sources.csv_sink import read_csv

CANDIDATE = "lookup_key long, rank int, cand_id string, cand_title string, cand_year int"


@pytest.fixture
def hot(spark, monkeypatch):
    """A third of all candidates belong to one lookup, far above the limit for one task."""
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    rows = [(0, i, f"c{i}", f"blue road {i % 7}", 1950 + i % 60) for i in range(300)]
    rows += [(1 + i % 50, i, f"d{i}", "blue road", None if i % 9 == 0 else 1980) for i in range(600)]
    lookups = [(k, "blue road 3", 1975 if k % 2 == 0 else None) for k in range(52)]
    return spark.createDataFrame(lookups, "lookup_key long, query string, year int"), spark.createDataFrame(rows, CANDIDATE)


def test_hot_lookups_meet_all_their_candidates(hot):
    lookups, candidates = hot
    met = skew.join_hot(candidates, lookups.select("lookup_key", "year"), "lookup_key")
    assert met.columns == [*candidates.columns, "year"]
    assert sorted(r.cand_id for r in met.collect()) == sorted(r.cand_id for r in candidates.collect())
    best = {r.lookup_key: r.cand_id for r in matching.best_match(lookups, candidates).collect()}
    assert best[0] == "c3" and best[51] is None and len(best) == 52
    kept = matching.year_window(lookups, candidates).collect()
    assert {r.cand_year for r in kept if r.lookup_key == 0} == set(range(1973, 1978))
    assert sum(r.lookup_key == 1 for r in kept) == 12
    exact = {r.lookup_key: r.cand_id for r in matching.exact_match(lookups, candidates).collect()}
    assert exact[0] == "c3" and exact[1] is None


def test_blocks_lose_no_pair(spark):
    left = spark.createDataFrame([(i, "k" if i % 3 else f"k{i}") for i in range(90)], "l int, key string")
    right = spark.createDataFrame([(i, "k" if i % 2 else f"k{i}") for i in range(70)], "r int, key string")
    want = sorted((r.l, r.r) for r in left.join(right, "key").collect())
    got = skew.meet_in_blocks(left, right, "key", 4, block=8)
    assert sorted((r.l, r.r) for r in got.collect()) == want


@pytest.mark.parametrize("most", [3, 10_000])
def test_first_n_with_ties_and_without_texts_in_the_sort(spark, monkeypatch, most):
    monkeypatch.setattr(shape, "TOP_ROWS", most)
    rows = [(i, f"{i % 5}.isb.txt" if i % 6 else None, "text") for i in range(60)]
    songs = spark.createDataFrame(rows, "isb_id int, source_file string, lyrics string")
    whole = [r.source_file for r in songs.orderBy(file_key()).collect()]
    for n in (1, 7, 13, 60, 100):
        first = first_n(songs, n, file_key())
        assert first.columns == songs.columns
        assert [r.source_file for r in first.collect()] == whole[:n]
    assert first_n(songs.limit(0), 5, file_key()).count() == 0


def test_first_n_with_most_rows_tied(spark, monkeypatch):
    monkeypatch.setattr(shape, "TOP_ROWS", 10)
    rows = [(i, "a.isb.txt" if i < 30 else "b.isb.txt", str(i)) for i in range(1000)]
    songs = spark.createDataFrame(rows, "isb_id int, source_file string, lyrics string").repartition(7)
    got = [r.isb_id for r in first_n(songs, 500, file_key()).collect()]
    assert len(set(got)) == 500 and set(got[:30]) == set(range(30))


def test_a_stopped_run_keeps_the_answers_it_found(spark, tmp_path, monkeypatch):
    text = "\\film{Blue Road}\n\\year{1975}\n\\singer{Gita Fivee}\n#indian\nla\n#endindian\n"
    files = spark.createDataFrame([("1.isb.txt", text)], "source_file string, content string")
    films = spark.createDataFrame([("1", "Blue Road", 1975, 0)], "cand_id string, cand_title string, cand_year int, rank int")
    people = spark.createDataFrame([("10", "Gita Five", 0)], "cand_id string, cand_name string, rank int")
    kept = str(tmp_path / "kept")

    def stop(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(resolve, "similar_members", stop)
    with pytest.raises(RuntimeError):
        build_catalogue(files=files, films=films, people=people, answers=kept)
    assert [tuple(r) for r in A.read_answers(spark, f"{kept}/films", A.FILM_SCHEMA).collect()] == [("Blue Road|1975", "tt1")]


def test_appending_reads_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "answers")
    rows = spark.range(2000).select(F.concat(F.lit("film "), "id").alias("cache_key"), F.lit("tt1").alias("imdb_id"))
    A.append_answers(rows, path, A.FILM_SCHEMA)
    one = spark.createDataFrame([("film 7", "tt2"), ("new", "tt3")], A.FILM_SCHEMA)
    A.append_answers(one, path, A.FILM_SCHEMA)
    some = A.read_answers(spark, path, A.FILM_SCHEMA, one.select("cache_key"))
    assert {"film 7", "new"} <= {r.cache_key for r in some.collect()} and some.count() < 150
    assert {r.cache_key: r.imdb_id for r in some.collect()}["film 7"] == "tt1"
    assert A.read_answers(spark, path, A.FILM_SCHEMA).count() == 2001


def test_counters_and_export_of_a_catalogue(spark, tmp_path):
    text = "\\film{Blue Road}\n\\year{1975}\n\\singer{Gita Five, Nobody}\n#indian\nla\n#endindian\n"
    files = spark.createDataFrame([("1.isb.txt", text), ("2.isb.txt", None)], "source_file string, content string")
    people = spark.createDataFrame([("10", "Gita Five", 0)], "cand_id string, cand_name string, rank int")
    counters = JobCounters()
    export_catalogue(spark, str(tmp_path / "out"), files=files, people=people, counters=counters)
    assert counters.totals() == {"parsed": 1, "unreadable": 1, "people_asked": 2, "people_resolved": 1, "films_asked": 0, "films_resolved": 0}
    assert read_csv(spark, str(tmp_path / "out")).count() == 2


def test_stages_are_given_back(spark):
    rows = spark.range(50)
    with staging.dropping_stages(spark):
        staged = staging.stage(rows)
        path = staged.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "")).first()[0]
        assert staged.count() == 50
    assert spark.read.schema("id long").parquet(path).count() == 0


def test_answers_hold_a_key_once(spark, tmp_path):
    path = str(tmp_path / "answers")
    rows = spark.createDataFrame([("A", None), ("A", "tt2"), ("A", "tt1"), ("B", None), (None, "tt9")], A.FILM_SCHEMA)
    A.append_answers(rows, path, A.FILM_SCHEMA)
    rows.write.mode("append").parquet(path)  # as another run that appends at the same time
    stored = sorted(tuple(r) for r in A.read_answers(spark, path, A.FILM_SCHEMA).collect())
    assert stored == [("A", "tt1"), ("B", None)]


def test_repeated_answers_and_blank_songs(spark):
    schema = "isb_id int, film string, year int, singer string, music string, lyricist string"
    rows = [(1, "A", 1970, "P", "", None), (2, "", 1980, None, "", ""), (3, None, None, " ", ",", "|"), (4, "B", 0, "", "", "P/Q")]
    films = spark.createDataFrame([("A|1970", "tt1"), ("A|1970", "tt1"), ("B", None)], A.FILM_SCHEMA)
    people = spark.createDataFrame([("P", "nm1"), ("P", None), ("Q", "nm2"), ("Q", "nm2")], A.PERSON_SCHEMA)
    got = attach_ids(spark.createDataFrame(rows, schema), films, people).collect()
    ids = {r.isb_id: (r.imdb_film_id, r.imdb_singer_ids, r.imdb_music_ids, r.imdb_lyricist_ids) for r in got}
    assert len(got) == 4
    assert ids == {1: ("tt1", "nm1", "", ""), 2: (None, "", "", ""), 3: (None, "", "", ""), 4: (None, "", "", "nm1|nm2")}


def test_answers_alone_and_answers_kept(spark, tmp_path):
    text = "\\film{Blue Road}\n\\year{1975}\n\\singer{Gita Five}\n#indian\nla\n#endindian\n"
    files = spark.createDataFrame([("1.isb.txt", text)], "source_file string, content string")
    known = spark.createDataFrame([("Blue Road|1975", "tt7")], A.FILM_SCHEMA)
    only = build_catalogue(files=files, known_films=known).first()
    assert (only.imdb_film_id, only.imdb_singer_ids) == ("tt7", "")
    films = spark.createDataFrame([("1", "Blue Road", 1975, 0)], "cand_id string, cand_title string, cand_year int, rank int")
    people = spark.createDataFrame([("10", "Gita Five", 0)], "cand_id string, cand_name string, rank int")
    kept = str(tmp_path / "kept")
    first = build_catalogue(files=files, films=films, people=people, answers=kept).first()
    again = build_catalogue(files=files, answers=kept).first()
    assert first == again and (again.imdb_film_id, again.imdb_singer_ids) == ("tt1", "nm10")
    # A second run with other catalogues asks them nothing: all its names are answered.
    other = build_catalogue(files=files, films=films.withColumn("cand_id", F.lit("x")), people=people, answers=kept).first()
    assert other.imdb_film_id == "tt1"
    assert build_catalogue(files=files).first().imdb_film_id is None
