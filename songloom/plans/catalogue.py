"""The full run: load, choose or merge, limit, enrich, shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songloom.operators.merge import choose_source, merge_sources
from songloom.operators.resolve import enrich_songs
from songloom.operators.shape import TOP_ROWS, complete_columns, file_key, first_n, merge_key
from songloom.operators.summary import JobCounters
from songloom.operators.tagged_text import parse_songs
from songloom.plans.staging import dropping_stages, stage
from songloom.sources.answers import (
    FILM_SCHEMA,
    PERSON_SCHEMA,
    append_answers,
    new_answers,
    one_per_key,
    read_answers,
)
from songloom.sources.csv_sink import write_csv


def load_songs(
    files: DataFrame | None = None,
    scraped: DataFrame | None = None,
    limit: int | None = None,
    keep_starring: bool = False,
    fill_blanks: bool = False,
    counters: JobCounters | None = None,
) -> DataFrame:
    """Parsed files and scraped rows brought together, cut to the first ``limit`` rows."""
    if files is not None and counters is not None:
        files = counters.watch_files(files)
    parsed = None if files is None else parse_songs(files, keep_starring)
    songs = choose_source(parsed, scraped, fill_blanks)
    if limit is not None and 0 < limit <= TOP_ROWS and songs is not parsed and songs is not scraped:
        first = _first_ids(parsed, scraped, limit, fill_blanks)
        songs = songs if first is None else first
    from_files_only = "lyrics_rendered" not in songs.columns
    return first_n(songs, limit, file_key() if from_files_only else merge_key(songs.columns))


def _first_ids(parsed: DataFrame, scraped: DataFrame, limit: int, fill_blanks: bool) -> DataFrame | None:
    """The merge of the first ``limit`` ids, which make as many rows or more, written; none if there are fewer.

    They are found on the ids alone, and only their songs are parsed, shuffled and merged. A merge is by id
    and its order begins with the id, null as 0, so what lies behind the last of them is not among its first rows.
    """
    first = F.coalesce(F.col("isb_id"), F.lit(0))
    ids = parsed.select(first.alias("id")).union(scraped.select(first.alias("id"))).distinct()
    last = ids.orderBy("id").limit(limit).agg(F.max("id").alias("id"), F.count("id").alias("n")).first()
    if last["n"] < limit:
        return None
    upto = first <= last["id"]
    return stage(merge_sources(parsed.filter(upto), scraped.filter(upto), fill_blanks))


def build_catalogue(
    files: DataFrame | None = None,
    scraped: DataFrame | None = None,
    films: DataFrame | None = None,
    people: DataFrame | None = None,
    known_films: DataFrame | None = None,
    known_people: DataFrame | None = None,
    limit: int | None = None,
    keep_starring: bool = False,
    fill_blanks: bool = False,
    answers: str | None = None,
    counters: JobCounters | None = None,
) -> DataFrame:
    """The finished table.

    Ids come from stored answers, given as tables or kept in the folder ``answers``, and for names
    without one from the film and person catalogues. New answers are appended to that folder while names
    are still being resolved, misses once all are, so a run that is stopped keeps what it found. Without
    any of these the id columns stay null. ``counters`` takes files parsed and not readable, and names
    asked and resolved, in the passes that are made anyway.

    Not all of it is lazy: whether a source is empty is looked up, and with ids the loaded songs and
    the answers are written to the job's folder first, since several steps read them. Those tables
    last until ``staging.dropping_stages`` or the job's folder is dropped; ``export_catalogue`` sees to it.
    """
    songs = load_songs(files, scraped, limit, keep_starring, fill_blanks, counters)
    if answers is not None:
        spark = songs.sparkSession
        known_films = _with_stored(known_films, read_answers(spark, f"{answers}/films", FILM_SCHEMA))
        known_people = _with_stored(known_people, read_answers(spark, f"{answers}/people", PERSON_SCHEMA))
    if all(table is None for table in (films, people, known_films, known_people)):
        return complete_columns(songs)
    keep = {}
    if answers is not None:
        keep["keep_films"] = lambda found: append_answers(found, f"{answers}/films", FILM_SCHEMA)
        keep["keep_people"] = lambda found: append_answers(found, f"{answers}/people", PERSON_SCHEMA)
    songs, film_answers, person_answers = enrich_songs(
        stage(songs), films, people, known_films, known_people, counters=counters, **keep
    )
    if answers is not None:
        append_answers(film_answers, f"{answers}/films", FILM_SCHEMA)
        append_answers(person_answers, f"{answers}/people", PERSON_SCHEMA)
    return complete_columns(songs)


def export_catalogue(spark: SparkSession, path: str, **sources) -> None:
    """``build_catalogue`` written as sorted CSV; the tables it needed on the way are given back."""
    with dropping_stages(spark):
        write_csv(build_catalogue(**sources), path)


def _with_stored(given: DataFrame | None, stored: DataFrame) -> DataFrame:
    """Given answers go before stored ones of the same key."""
    return stored if given is None else one_per_key(given).unionByName(new_answers(stored, given))
