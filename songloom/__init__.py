"""songloom: build a clean, linked song catalogue from messy sources with Spark."""

from songloom.operators.merge import choose_source, merge_sources
from songloom.operators.resolve import attach_ids, enrich_songs, resolve_films, resolve_people
from songloom.operators.shape import complete_columns, export_ready, first_n
from songloom.operators.summary import summarise
from songloom.operators.tagged_text import parse_songs
from songloom.operators.web_pages import parse_pages
from songloom.plans.catalogue import build_catalogue, load_songs
from songloom.sources.csv_sink import write_csv, write_parquet
from songloom.sources.files import read_song_files, read_table

__all__ = [
    "attach_ids", "build_catalogue", "choose_source", "complete_columns", "enrich_songs",
    "export_ready", "first_n", "load_songs", "merge_sources", "parse_pages", "parse_songs",
    "read_song_files", "read_table", "resolve_films", "resolve_people", "summarise", "write_csv",
    "write_parquet",
]
