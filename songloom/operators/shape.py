"""Row order, first-n and the column contract of the finished catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from songloom.functions.text import leading_number
from songloom.plans.staging import stage

# The finished table, in column order.
CATALOGUE_COLUMNS = {
    "isb_id": "int",
    "stitle": "string",
    "film": "string",
    "year": "int",
    "starring": "string",
    "singer": "string",
    "music": "string",
    "lyricist": "string",
    "lyrics_itrans": "string",
    "lyrics_rendered": "string",
    "imdb_film_id": "string",
    "imdb_singer_ids": "string",
    "imdb_music_ids": "string",
    "imdb_lyricist_ids": "string",
    "source_file": "string",
}


def file_key() -> Column:
    """By the digits a file name starts with, 0 when none; then by name, null first."""
    name = F.col("source_file")
    return F.struct(leading_number(name).alias("k1"), name.isNotNull().alias("k2"), F.coalesce(name, F.lit("")).alias("k3"))


def merge_key(columns: list[str]) -> Column:
    """By id with null as 0; the file name, null last, splits ties where there is one."""
    name = F.col("source_file") if "source_file" in columns else F.lit(None).cast("string")
    return F.struct(
        F.coalesce(F.col("isb_id"), F.lit(0)).alias("k1"), name.isNull().alias("k2"), F.coalesce(name, F.lit("")).alias("k3")
    )


def export_order(columns: list[str]) -> list[Column]:
    """By id, nulls last. The tie-breaker also lets range partitioning split many null ids."""
    order = [F.col("isb_id").asc_nulls_last()]
    return order + ([F.col("source_file").asc_nulls_last()] if "source_file" in columns else [])


TOP_ROWS = 10_000  # so many keys are cheaper to take from each task's own first ones than to sort


def first_n(songs: DataFrame, n: int | None, key: Column) -> DataFrame:
    """The first ``n`` rows by a non-null ``key``, in that order; 0 or none means all rows as they are.

    Only keys are sorted: they give the last key that is in and how many rows with it are. The rows with
    their texts are then filtered where they lie, and are never brought together. For a large ``n`` the
    last key is found among sorted ranges of keys by their counts, so no task gathers n of them, and rows
    with the last key are numbered where they lie, however many they are.
    """
    if n is not None and n < 0:
        raise ValueError("the limit must not be negative")
    if not n:
        return songs
    counts = songs.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    found = _top_key(counts, n) if n <= TOP_ROWS else _key_at(counts, n)
    if found is None:
        return songs.orderBy(key)
    last, room = found
    limit = F.struct(*[F.lit(value).alias(name) for name, value in last.asDict().items()]).cast(counts.schema["key"].dataType)
    inside = songs.filter(key < limit)
    return inside.unionByName(_some(songs.filter(key == limit), room)).orderBy(key)


def _top_key(counts: DataFrame, n: int) -> tuple[Row, int] | None:
    """The n-th key, and how many of its rows are in; none if there are no more than n rows."""
    first = counts.orderBy("key").limit(n)  # at least n rows, if there are as many
    before = F.sum("n").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
    placed = first.withColumn("room", F.lit(n) - F.coalesce(before, F.lit(0)))
    inside = placed.filter("room > 0 and n >= room").orderBy("key").limit(1).collect()
    return (inside[0]["key"], inside[0]["room"]) if inside else None


def _key_at(counts: DataFrame, n: int) -> tuple[Row, int] | None:
    """The same by ranges: the counts of sorted ranges say which one holds the n-th row."""
    ranges = counts.repartitionByRange("key").sortWithinPartitions("key")
    ranges = stage(ranges.withColumn("part", F.spark_partition_id()))
    sizes = sorted((r["part"], r["n"]) for r in ranges.groupBy("part").agg(F.sum("n").alias("n")).collect())  # one for each task
    before = 0
    for part, size in sizes:
        if before + size >= n:
            own = ranges.filter(F.col("part") == part)
            upto = F.sum("n").over(Window.orderBy("key"))  # the keys of one range
            held = own.withColumn("upto", upto + before).filter(F.col("upto") >= n).orderBy("key").limit(1).first()
            return held["key"], n - (held["upto"] - held["n"])
        before += size
    return None


def _some(rows: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows: whole tasks of them, and of one task the first."""
    columns = rows.columns
    placed = stage(rows.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.monotonically_increasing_id().alias("at")))
    part = F.shiftrightunsigned("at", 33)  # the task's number; below it the row's place in the task
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    taken, upto = 0, []
    for number, size in sizes:  # one for each task
        upto.append((number, min(size, n - taken)))
        taken += upto[-1][1]
    allowed = placed.sparkSession.createDataFrame(upto, "part bigint, upto bigint")
    kept = placed.withColumn("part", part).join(allowed, "part").filter(F.col("at") - F.shiftleft("part", 33) < F.col("upto"))
    return kept.select("row.*")


def complete_columns(songs: DataFrame) -> DataFrame:
    """Exactly the catalogue columns in order: missing ones null, others dropped."""
    return songs.select(
        *[
            (F.col(name) if name in songs.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in CATALOGUE_COLUMNS.items()
        ]
    )


def export_ready(songs: DataFrame) -> DataFrame:
    complete = complete_columns(songs)
    return complete.orderBy(*export_order(complete.columns))
