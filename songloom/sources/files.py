"""Scans of the raw inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from songloom.sources.listing import list_files

FILE_GLOB = "*.isb.txt"
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def utf8_text(content: Column) -> Column:
    """Bytes as UTF-8 text with invalid sequences dropped."""
    return F.translate(F.make_valid_utf8(content.cast("string")), "\ufffd", "")


def _song_file_rows(files: DataFrame) -> DataFrame:
    return files.select(
        F.element_at(F.split(F.col("path"), "/"), -1).alias("source_file"),
        utf8_text(F.col("content")).alias("content"),
    )


def read_song_files(spark: SparkSession, folder: str, empty_files: bool = True) -> DataFrame:
    """``(source_file, content)`` for every tagged file directly in ``folder``.

    Small files are packed into shared partitions by ``spark.sql.files.maxPartitionBytes`` and
    ``openCostInBytes``. Files of no bytes have empty content; they come from a listing of their own
    (``listing``), which ``empty_files=False`` leaves out. Files that cannot be read are skipped;
    ``unreadable_files`` lists them. Raises ``FileNotFoundError`` when no file matches.
    """
    files = _song_file_rows(_binary_files(spark, folder))
    if empty_files:
        empty = list_files(spark, folder, FILE_GLOB, largest=0)
        files = files.unionByName(empty.select(F.col("name").alias("source_file"), F.lit("").alias("content")))
    if files.select("source_file").isEmpty():
        raise FileNotFoundError(f"no {FILE_GLOB} files in {folder}")
    return files


def _binary_files(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", FILE_GLOB)
        .option("ignoreCorruptFiles", True)
        .option("ignoreMissingFiles", True)
        .load(folder)
    )


def unreadable_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names of files that are listed but yield no content."""
    files = _binary_files(spark, folder)
    name = F.element_at(F.split(F.col("path"), "/"), -1).alias("source_file")
    readable = files.filter(F.col("content").isNotNull()).select(name)
    return files.select(name).join(readable, "source_file", "left_anti")


def stream_song_files(spark: SparkSession, folder: str, files_per_batch: int = 10_000) -> DataFrame:
    """The same rows as a stream that picks up new files."""
    files = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE)
        .option("pathGlobFilter", FILE_GLOB)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return _song_file_rows(files)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Scraped rows, pages or fetch logs kept as parquet.

    A scan has a task for each ``spark.sql.files.maxPartitionBytes``. Callers with few bytes and much
    work for each row ask for more with ``repartition``.
    """
    return spark.read.parquet(path)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df
