"""Last-wins dedupe and the priority merge of file and scraped records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songloom.functions.text import leading_number

# The fields of a scraped song, and those that only files have.
SCRAPED_FIELDS = [
    "stitle", "film", "year", "starring", "singer", "music", "lyricist", "lyrics_rendered",
]
FILE_ONLY_FIELDS = ["lyrics_itrans", "source_file"]


def _null_safe_key(column: Column) -> list[Column]:
    """Two non-null columns equal exactly when ``column`` is, nulls included.

    Grouping and joining on the same pair lets the join reuse the grouping's partitioning.
    """
    return [F.coalesce(column, F.lit(0)).alias("k"), column.isNull().alias("k_null")]


def _last_by(df: DataFrame, order: Column) -> DataFrame:
    """One row per id, the last by ``order``; partial results combine before the shuffle."""
    fields = [c for c in df.columns if c not in ("k", "k_null")]
    last = df.groupBy("k", "k_null").agg(F.max_by(F.struct(*fields), order).alias("row"))
    return last.select("k", "k_null", "row.*")


def last_per_id(files: DataFrame) -> DataFrame:
    """Of file rows with one id keep the last in file order; all null ids count as one id."""
    keyed = files.select("*", *_null_safe_key(F.col("isb_id")))
    order = F.struct(leading_number(F.col("source_file")), F.col("source_file"))
    return _last_by(keyed, order).drop("k", "k_null")


def latest_per_id(rows: DataFrame, time_column: str, *tie_breakers: str) -> DataFrame:
    """Keep the newest row per ``isb_id``: the read side of an insert-or-replace store."""
    keyed = rows.select("*", *_null_safe_key(F.col("isb_id")))
    order = F.struct(time_column, *tie_breakers)
    return _last_by(keyed, order).drop("k", "k_null")


def merge_sources(files: DataFrame, scraped: DataFrame, fill_blanks: bool = False) -> DataFrame:
    """Full outer merge by id in which a scraped row wins whole, blanks and nulls included.

    It takes only the raw lyrics and the file name from the file row. ``fill_blanks`` lets file
    values stand in for blank or null scraped ones. ``scraped`` holds each id once.
    """
    file_fields = [f for f in SCRAPED_FIELDS if f in files.columns]
    order = F.struct(leading_number(F.col("source_file")), F.col("source_file"))
    f = _last_by(files.select("*", *_null_safe_key(F.col("isb_id"))), order).alias("f")
    s = scraped.select(
        "isb_id", *SCRAPED_FIELDS, F.lit(True).alias("present"), *_null_safe_key(F.col("isb_id"))
    ).alias("s")
    joined = f.join(s, ["k", "k_null"], "full_outer")
    present = F.coalesce(F.col("s.present"), F.lit(False))

    def pick(field: str) -> Column:
        won = F.col(f"s.{field}")
        if field not in file_fields:
            return won.alias(field)
        kept = F.col(f"f.{field}")
        if fill_blanks:
            blank = won.isNull() if field == "year" else (F.coalesce(won, F.lit("")) == "")
            won = F.when(blank, kept).otherwise(won)
        return F.when(present, won).otherwise(kept).alias(field)

    return joined.select(
        F.when(present, F.col("s.isb_id")).otherwise(F.col("f.isb_id")).alias("isb_id"),
        *[pick(field) for field in SCRAPED_FIELDS],
        *[F.col(f"f.{field}").alias(field) for field in FILE_ONLY_FIELDS],
    )


def choose_source(files: DataFrame | None, scraped: DataFrame | None, fill_blanks: bool = False) -> DataFrame:
    """Merge when both sources have rows, else pass the one that has rows through unchanged.

    At least one source must be given. An absent or empty source makes no merge, so nothing is
    deduplicated then.
    """
    if files is None and scraped is None:
        raise ValueError("give at least one source of songs")
    if scraped is None:
        return files
    if files is None:
        return scraped
    if files.isEmpty():
        return scraped
    return files if scraped.isEmpty() else merge_sources(files, scraped, fill_blanks)
