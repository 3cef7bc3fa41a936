"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import inputs as I
from songloom.functions.html import readable_markup
from songloom.functions.similarity import name_key, normalise_name, split_names, token_sort_ratio
from songloom.functions.text import clean_lyrics, clean_title, file_id, leading_number, safe_year
from songloom.operators import matching, resolve, summary
from songloom.operators.fetch_log import route_fetches
from songloom.operators.merge import choose_source, last_per_id, merge_sources
from songloom.operators.shape import complete_columns, file_key, first_n, merge_key
from songloom.operators.tagged_text import (
    header_lines,
    is_ignored_line,
    last_tag_value,
    lyrics_block,
    parse_songs,
    text_lines,
)
from songloom.operators.web_pages import (
    PAGE_FIELDS,
    is_valid_page,
    label_pairs,
    last_label_value,
    page_lyrics,
    page_title,
    parse_pages,
    song_title,
)
from songloom.plans.catalogue import build_catalogue
from songloom.plans.staging import job_folder, stage
from songloom.sources import answers, csv_sink, store
from songloom.sources.files import read_song_files, read_table, require_rows
from songloom.streaming.ingest import ingest_fetches, ingest_pages, log_batch, source_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _scratch(spark: SparkSession) -> str:
    return f"{job_folder(spark)}/run-{uuid.uuid4().hex}"


def _streamed(spark: SparkSession, sf: str, log: str, path: str, batches: int) -> tuple[DataFrame, DataFrame]:
    """A fetch log as a stream, the attempts of an id in different batches, and as a table of the same rows.

    The events lie on disk, dealt to batches, and the log is made of them where it is read: pages are neither
    written nor read again in blocks of thousands, which no task could hold.
    """
    events = read_table(spark, f"{sf}/events.parquet")
    files = spark.sparkContext.defaultParallelism
    dealt = F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(batches))
    for batch in range(batches):
        events.filter(dealt == batch).repartition(files).write.mode("append").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(path)
    table = spark.read.schema(events.schema).parquet(path)
    return I.derive(spark, sf, log, events=stream), I.derive(spark, sf, log, events=table)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/documents.parquet").repartition(spark.sparkContext.defaultParallelism)


def _songs(spark: SparkSession, sf: str) -> DataFrame:
    return parse_songs(I.derive(spark, sf, I.SONG_FILES))


# --- tagged text ---------------------------------------------------------------------------


@query
def parse_song_files(spark, sf):
    return _songs(spark, sf)


@query
def parse_song_files_with_cast(spark, sf):
    songs = parse_songs(I.derive(spark, sf, I.SONG_FILES), keep_starring=True)
    return songs.select("source_file", "starring")


@query
def split_lines(spark, sf):
    """Right-trimmed lines of all texts, counted per distinct line."""
    files = I.derive(spark, sf, I.SONG_FILES)
    lines = files.select(F.explode(text_lines(F.col("content"))).alias("line"))
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query
def select_lyrics_block(spark, sf):
    files = I.derive(spark, sf, I.SONG_FILES)
    return files.select("source_file", lyrics_block(F.col("content")).alias("block"))


@query
def drop_comment_lines(spark, sf):
    """Header lines that are neither comments nor directives, in order."""
    files = I.derive(spark, sf, I.SONG_FILES)
    lines = files.select("source_file", text_lines(header_lines(F.col("content"))).alias("lines"))
    kept = F.filter("lines", lambda line: ~is_ignored_line(line))
    return lines.select("source_file", F.array_join(kept, "\n").alias("kept"))


@query
def extract_tags(spark, sf):
    files = I.derive(spark, sf, I.SONG_FILES)
    header = files.select("source_file", header_lines(F.col("content")).alias("header"))
    fields = ["stitle", "film", "singer", "music", "lyricist"]
    return header.select(
        "source_file",
        *[last_tag_value(F.col("header"), f).alias(f) for f in fields],
        safe_year(last_tag_value(F.col("header"), "year")).alias("year"),
    )


@query
def clean_lyrics_text(spark, sf):
    documents = _documents(spark, sf)
    return documents.select("doc_id", clean_lyrics(F.col("text")).alias("cleaned"))


@query
def clean_song_titles(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    wrapped = F.concat(F.lit(" ###"), F.col("o_orderpriority"), F.lit("## # "))
    return orders.select("o_orderkey", clean_title(wrapped).alias("title"))


@query
def file_name_ids(spark, sf):
    files = I.derive(spark, sf, I.SONG_FILES)
    name = F.col("source_file")
    return files.select(
        "source_file", file_id(name).alias("isb_id"), leading_number(name).cast("bigint").alias("leading")
    )


# --- web pages -----------------------------------------------------------------------------


def _marked_pages(spark, sf):
    pages = I.derive(spark, sf, I.LABELLED_PAGES)
    marked = pages.withColumn("markup", readable_markup(F.col("html")))
    return marked.withColumn("title", page_title(F.col("markup")))


@query
def valid_pages(spark, sf):
    marked = _marked_pages(spark, sf)
    return marked.filter(is_valid_page(F.col("html"), F.col("title"))).select("isb_id", "title")


@query
def page_song_titles(spark, sf):
    marked = _marked_pages(spark, sf)
    return marked.select("isb_id", song_title(F.col("markup"), F.col("title")).alias("stitle"))


@query
def page_labels(spark, sf):
    pairs = _marked_pages(spark, sf).select("isb_id", label_pairs(F.col("markup")).alias("pairs"))
    return pairs.select("isb_id", *[last_label_value(F.col("pairs"), f).alias(f) for f in PAGE_FIELDS])


@query
def page_lyrics_text(spark, sf):
    return _marked_pages(spark, sf).select("isb_id", page_lyrics(F.col("markup")).alias("lyrics"))


@query
def parse_web_pages(spark, sf):
    return parse_pages(I.derive(spark, sf, I.LABELLED_PAGES))


@query
def route_fetch_log(spark, sf):
    return route_fetches(I.derive(spark, sf, I.FETCH_LOG)).select(
        "isb_id", "outcome", "reason", "status", "lyrics_rendered"
    )


@query
def fetch_counters(spark, sf):
    return summary.run_counters(route_fetches(I.derive(spark, sf, I.FETCH_LOG)))


# --- merge, order, shape -------------------------------------------------------------------


@query
def merge_by_priority(spark, sf):
    return merge_sources(I.derive(spark, sf, I.FILE_SONGS), I.derive(spark, sf, I.SCRAPED_SONGS))


@query
def merge_filling_blanks(spark, sf):
    files, scraped = I.derive(spark, sf, I.FILE_SONGS), I.derive(spark, sf, I.SCRAPED_SONGS)
    return merge_sources(files, scraped, fill_blanks=True).select("isb_id", "film", "year", "singer", "music")


@query
def last_file_per_id(spark, sf):
    return last_per_id(I.derive(spark, sf, I.FILE_SONGS))


@query
def source_choice(spark, sf):
    """All branches: files only, scraped only, both, and an empty side, which counts as absent."""
    files, scraped = I.derive(spark, sf, I.FILE_SONGS), I.derive(spark, sf, I.SCRAPED_SONGS)
    none = files.filter("isb_id = -1")
    branches = {
        "files": choose_source(files, None), "scraped": choose_source(None, scraped), "both": choose_source(files, scraped),
        "no files": choose_source(none, scraped), "no scraped": choose_source(files, scraped.filter("isb_id = -1")),
    }
    return reduce(
        DataFrame.unionByName, [f.select(F.lit(name).alias("branch"), "isb_id", "film") for name, f in branches.items()]
    )


@query
def upsert_latest(spark, sf):
    """Insert-or-replace of events by user, the latest winning."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    rows = events.select(F.col("user_id").alias("isb_id"), "ts", "event_id", "event_type")
    return store.latest_per_id(rows, "ts", "event_id").select("isb_id", "event_id", "event_type")


@query
def finished_song_ids(spark, sf):
    outcomes = route_fetches(I.derive(spark, sf, I.FETCH_LOG))
    songs = outcomes.filter(F.col("outcome") == "saved")
    failures = I.derive(spark, sf, I.SCRAPED_SONGS)
    return store.finished_ids(songs, failures).select(F.col("isb_id").cast("bigint").alias("isb_id"))


@query
def pending_song_ids(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    done = I.derive(spark, sf, I.SCRAPED_SONGS).filter(F.col("film") != "")
    end = orders.agg(F.max("o_orderkey")).first()[0]
    return store.pending_ids(spark, 0, end, done)


@query
def first_files(spark, sf):
    songs = I.derive(spark, sf, I.FILE_SONGS)
    return first_n(songs, 500, file_key()).select("isb_id", "source_file")


@query
def first_many_files(spark, sf):
    """More than are taken at once: the last one is found by counts over ranges."""
    return first_n(I.derive(spark, sf, I.FILE_SONGS), 12_000, file_key()).select("isb_id", "source_file")


@query
def first_merged(spark, sf):
    merged = merge_sources(I.derive(spark, sf, I.FILE_SONGS), I.derive(spark, sf, I.SCRAPED_SONGS))
    return first_n(merged, 500, merge_key(merged.columns)).select("isb_id", "film", "source_file")


@query
def export_order(spark, sf):
    """Rows in export order, numbered from the written files: their order by name, and the rows in each."""
    path = _scratch(spark)
    merged = merge_sources(I.derive(spark, sf, I.FILE_SONGS), I.derive(spark, sf, I.SCRAPED_SONGS))
    csv_sink.write_parquet(merged, path)
    placed = spark.read.parquet(path).select(
        "isb_id", "source_file", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    files = placed.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    starts = files.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return placed.join(starts, "file").select("isb_id", "source_file", (F.col("start") + F.col("at")).alias("position"))


@query
def column_contract(spark, sf):
    return complete_columns(I.derive(spark, sf, I.FILE_SONGS).withColumn("extra", F.lit(1)))


@query
def distinct_film_years(spark, sf):
    return summary.distinct_films(_songs(spark, sf))


@query
def catalogue_summary(spark, sf):
    """Of songs with ids, so that there are matches to count."""
    return summary.summarise(_linked_songs(spark, sf))


@query
def file_scan(spark, sf):
    """Tagged files on disk, one for each supplier and some of other names, scanned and parsed."""
    folder = _scratch(spark)
    made = I.derive(spark, sf, I.DISK_FILES)

    def write(rows):
        path = folder.removeprefix("file://").removeprefix("file:")  # a folder that all executors share
        os.makedirs(path, exist_ok=True)
        for row in rows:
            with open(f"{path}/{row.name}", "wb") as out:
                out.write(bytes(row.content))

    made.foreachPartition(write)
    return parse_songs(read_song_files(spark, folder)).select("isb_id", "film", "singer", "lyrics_itrans", "source_file")


@query
def empty_sources(spark, sf):
    """Which sources of songs, in which years, are refused because they have no rows."""
    scraped = I.derive(spark, sf, I.SCRAPED_SONGS)
    years = [r[0] for r in spark.read.parquet(f"{sf}/orders.parquet").select(F.year("o_orderdate")).distinct().collect()]
    asked = [(year, shift) for year in sorted(years) for shift in (0, 1000)]

    def refused(year: int) -> bool:
        try:
            require_rows(scraped.filter(F.col("year") == year), f"songs of {year}")
        except ValueError:
            return True
        return False

    rows = [(year + shift, refused(year + shift)) for year, shift in asked]
    return spark.createDataFrame(rows, "year int, refused boolean")


@query
def run_counters(spark, sf):
    """Files, fetches, skipped ids and resolved names of a job, taken while its parts are written."""
    counters = summary.JobCounters()
    log = I.derive(spark, sf, I.FETCH_LOG)
    done = I.derive(spark, sf, I.SCRAPED_SONGS).select(F.col("isb_id").cast("bigint").alias("isb_id"))
    target = _scratch(spark)
    stage(parse_songs(counters.watch_files(I.derive(spark, sf, I.SONG_FILES))))
    log_batch(log, f"{target}/store", "counted", 0, done, counters=counters)
    for name, table in (("films", I.KNOWN_FILMS), ("people", I.KNOWN_PEOPLE)):
        stage(counters.watch_answers(I.derive(spark, sf, table), name))
    return counters.frame(spark)


# --- names and matching --------------------------------------------------------------------


@query
def normalise_text(spark, sf):
    documents = _documents(spark, sf)
    return documents.select("doc_id", normalise_name(F.col("text")).alias("name"))


@query
def sort_name_tokens(spark, sf):
    documents = _documents(spark, sf)
    return documents.select("doc_id", name_key(F.col("text")).alias("name_key"))


@query
def split_credit_names(spark, sf):
    documents = _documents(spark, sf)
    names = split_names(F.col("text"))
    return documents.select(
        "doc_id", F.size(names).cast("bigint").alias("n"), F.array_join(names, "~").alias("names")
    )


@query
def token_sort_scores(spark, sf):
    """Each typed film against the part name it came from."""
    pairs = I.derive(spark, sf, I.LOOKUPS).join(
        I.derive(spark, sf, I.SONG_SOURCE).select(F.col("k").alias("lookup_key"), "p_name"), "lookup_key"
    )
    distinct = pairs.select("query", "p_name").distinct()
    scored = distinct.withColumn("score", F.round(token_sort_ratio(F.col("query"), F.col("p_name")), 6))
    return pairs.join(scored, ["query", "p_name"]).select("lookup_key", "score")


@query
def best_match(spark, sf):
    best = matching.best_match(I.derive(spark, sf, I.LOOKUPS), I.derive(spark, sf, I.CANDIDATES))
    return best.withColumn("score", F.round("score", 6))


@query
def best_match_in_year(spark, sf):
    lookups, candidates = I.derive(spark, sf, I.LOOKUPS), I.derive(spark, sf, I.CANDIDATES)
    return matching.best_match(lookups, candidates, use_year=True).select("lookup_key", "cand_id")


@query
def exact_match(spark, sf):
    return matching.exact_match(I.derive(spark, sf, I.LOOKUPS), I.derive(spark, sf, I.CANDIDATES))


@query
def year_window(spark, sf):
    kept = matching.year_window(I.derive(spark, sf, I.LOOKUPS), I.derive(spark, sf, I.CANDIDATES))
    return kept.select("lookup_key", "cand_id", "cand_year")


@query
def film_keys(spark, sf):
    lookups = I.derive(spark, sf, I.LOOKUPS)
    return lookups.select("lookup_key", resolve.film_key(F.col("query"), F.col("year")).alias("cache_key"))


def _film_lookups(spark, sf):
    songs = I.derive(spark, sf, I.FILE_SONGS)
    return resolve.film_lookups(songs)


@query
def film_candidates(spark, sf):
    found = resolve.generate_candidates(
        _film_lookups(spark, sf).select("query").distinct().withColumn("lookup_key", F.col("query")),
        I.derive(spark, sf, I.FILM_CATALOGUE), 82.0,
    )
    return found.select("lookup_key", "cand_id", "cand_title")


@query
def resolve_films(spark, sf):
    return resolve.resolve_films(_film_lookups(spark, sf), I.derive(spark, sf, I.FILM_CATALOGUE))


@query
def resolve_people(spark, sf):
    lookups = resolve.person_lookups(I.derive(spark, sf, I.FILE_SONGS))
    return resolve.resolve_people(lookups, I.derive(spark, sf, I.PERSON_CATALOGUE))


@query
def known_answers(spark, sf):
    """Stored hits and misses are kept as they are; only the rest is looked up."""
    known = I.derive(spark, sf, I.KNOWN_FILMS)
    return resolve.resolve_films(_film_lookups(spark, sf), I.derive(spark, sf, I.FILM_CATALOGUE), known)


@query
def answers_round_trip(spark, sf):
    """Append the nations' answers, then all person answers: only new names are added."""
    path = _scratch(spark)
    known = I.derive(spark, sf, I.KNOWN_PEOPLE)
    answers.append_answers(known, path, answers.PERSON_SCHEMA)
    suppliers = I.derive(spark, sf, I.PERSON_CATALOGUE).select(
        F.col("cand_name").alias("name"), F.concat(F.lit("nm"), F.col("cand_id")).alias("imdb_id")
    )
    again = known.select("name", F.lit("changed").alias("imdb_id"))
    answers.append_answers(suppliers.unionByName(again), path, answers.PERSON_SCHEMA)
    return answers.read_answers(spark, path, answers.PERSON_SCHEMA)


@query
def json_answers(spark, sf):
    """Stored film answers written as one JSON document per line, and read back."""
    path = _scratch(spark)
    known = I.derive(spark, sf, I.KNOWN_FILMS)
    one = F.create_map("cache_key", "imdb_id")
    document = F.to_json(F.struct(one.alias("films")), {"ignoreNullFields": "false"})
    known.select(document.alias("value")).write.text(path)
    films, _ = answers.read_answers_json(spark, path, one_per_line=True)
    return films


@query
def first_credit_names(spark, sf):
    documents = _documents(spark, sf)
    return documents.select("doc_id", resolve.first_name(F.col("text")).alias("name"))


def _linked_songs(spark, sf):
    songs = I.derive(spark, sf, I.FILE_SONGS)
    films = I.derive(spark, sf, I.KNOWN_FILMS)
    people = I.derive(spark, sf, I.PERSON_CATALOGUE).select(
        F.col("cand_name").alias("name"), F.concat(F.lit("nm"), F.col("cand_id")).alias("imdb_id")
    ).unionByName(I.derive(spark, sf, I.KNOWN_PEOPLE))
    return resolve.attach_ids(songs, films, people)


@query
def attach_ids(spark, sf):
    return _linked_songs(spark, sf).select("source_file", "imdb_film_id", *resolve.ROLE_COLUMNS.values())


@query
def resolve_look_alikes(spark, sf):
    """Supplier names behind some words, looked up among the same names behind others: all are alike."""
    names = I.derive(spark, sf, I.LOOK_ALIKES)
    lookups = names.select(F.col("asked").alias("lookup_key"), F.col("asked").alias("query"), F.lit(None).cast("int").alias("year"))
    people = names.select("cand_id", F.col("listed").alias("cand_name"), "rank")
    return resolve.resolve_people(lookups, people)


# --- whole jobs ----------------------------------------------------------------------------


@query
def catalogue(spark, sf):
    """Parse, merge, resolve and shape."""
    return build_catalogue(
        files=stage(I.derive(spark, sf, I.SONG_FILES)),  # read more than once, and made by joins of large tables
        scraped=I.derive(spark, sf, I.SCRAPED_SONGS),
        films=I.derive(spark, sf, I.FILM_CATALOGUE),
        people=I.derive(spark, sf, I.PERSON_CATALOGUE),
        known_people=I.derive(spark, sf, I.KNOWN_PEOPLE),
    )


@query
def catalogue_without_ids(spark, sf):
    """Parse, merge and shape."""
    return build_catalogue(
        files=I.derive(spark, sf, I.SONG_FILES), scraped=I.derive(spark, sf, I.SCRAPED_SONGS)
    )


@query
def csv_round_trip(spark, sf):
    path = _scratch(spark)
    csv_sink.write_csv(I.derive(spark, sf, I.FILE_SONGS), path)
    return csv_sink.read_csv(spark, path)


@query
def incremental_ingest(spark, sf):
    """Stream all pages into a store, run again, and read the store."""
    target = _scratch(spark)
    pages = stage(I.derive(spark, sf, I.LABELLED_PAGES))
    folder = pages.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "")).first()[0]
    for _ in range(2):
        stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 100).parquet(folder)
        ingest_pages(stream, f"{target}/store", f"{target}/checkpoint").awaitTermination()
    songs = store.read_store(spark, f"{target}/store", "songs").select("isb_id", F.lit("saved").alias("outcome"))
    failed = store.read_store(spark, f"{target}/store", "failures").select("isb_id", "reason")
    return songs.unionByName(failed.withColumnRenamed("reason", "outcome"))


@query
def ingest_replayed(spark, sf):
    """The fetch log streamed with the attempts of an id in different batches, one of them written twice."""
    target = _scratch(spark)
    stream, log = _streamed(spark, sf, I.FETCH_LOG, f"{target}/log", 4)
    ingest_fetches(stream, f"{target}/store", f"{target}/checkpoint").awaitTermination()
    again = log.filter("attempt > 1")
    nobody = again.select("isb_id").limit(0)
    for _ in range(2):
        log_batch(again, f"{target}/store", source_of(spark, f"{target}/checkpoint"), 1_000, nobody)
    songs = store.read_store(spark, f"{target}/store", "songs").select("isb_id", F.lit("saved").alias("outcome"), "lyrics_rendered")
    failed = store.read_store(spark, f"{target}/store", "failures").select(
        "isb_id", F.lit("failed").alias("outcome"), F.lit(None).cast("string").alias("lyrics_rendered")
    )
    return songs.unionByName(failed)


@query
def ingest_refetched(spark, sf):
    """A fetch log streamed, then everything fetched again: the attempts of an id lie in different batches of a run."""
    target = _scratch(spark)
    for name, log, resume in (("first", I.FETCH_LOG, True), ("again", I.REFETCH_LOG, False)):
        stream, _ = _streamed(spark, sf, log, f"{target}/{name}", 2)
        ingest_fetches(stream, f"{target}/store", f"{target}/{name}-checkpoint", resume=resume).awaitTermination()
    store.compact(spark, f"{target}/store")
    songs = store.read_store(spark, f"{target}/store", "songs").select("isb_id", F.lit("saved").alias("outcome"), "lyrics_rendered")
    failed = store.read_store(spark, f"{target}/store", "failures").select(
        "isb_id", F.lit("failed").alias("outcome"), F.lit(None).cast("string").alias("lyrics_rendered")
    )
    return songs.unionByName(failed)


@query
def catalogue_from_answers(spark, sf):
    """A run that saves its answers, and another that has nothing but them."""
    answered = _scratch(spark)
    sources = {"files": stage(I.derive(spark, sf, I.SONG_FILES)), "scraped": I.derive(spark, sf, I.SCRAPED_SONGS)}
    build_catalogue(
        **sources, films=I.derive(spark, sf, I.FILM_CATALOGUE), people=I.derive(spark, sf, I.PERSON_CATALOGUE),
        known_people=I.derive(spark, sf, I.KNOWN_PEOPLE), answers=answered,
    )
    return build_catalogue(**sources, answers=answered)


@query
def catalogue_limited(spark, sf):
    """The first songs only, with ids from stored answers."""
    return build_catalogue(
        files=I.derive(spark, sf, I.SONG_FILES), scraped=I.derive(spark, sf, I.SCRAPED_SONGS),
        known_films=I.derive(spark, sf, I.KNOWN_FILMS), known_people=I.derive(spark, sf, I.KNOWN_PEOPLE), limit=700,
    )
