"""Stored resolution answers: hits and misses of earlier runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from songloom.sources.buckets import BUCKET, append_buckets, buckets_of, read_buckets

# The two answer tables.
FILM_SCHEMA = "cache_key string, imdb_id string"
PERSON_SCHEMA = "name string, imdb_id string"
_JSON_SCHEMA = "films map<string,string>, persons map<string,string>"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_answers_json(
    spark: SparkSession, path: str, one_per_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Import ``{"films": {key: id|null}, "persons": {...}}`` documents as two answer tables.

    A document fills a file, or a line with ``one_per_line``. A missing path is an empty store.
    This is the way in for old answers only: one document is one row, so a large store belongs in
    parquet (``append_answers``) or in many small documents.
    """
    try:
        documents = spark.read.text(path, wholetext=not one_per_line)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], FILM_SCHEMA), spark.createDataFrame([], PERSON_SCHEMA)
    maps = documents.select(F.from_json("value", _JSON_SCHEMA).alias("d"))
    films = maps.select(F.explode("d.films").alias("cache_key", "imdb_id"))
    people = maps.select(F.explode("d.persons").alias("name", "imdb_id"))
    return films, people


def read_answers(spark: SparkSession, path: str, schema: str, keys: DataFrame | None = None) -> DataFrame:
    """A parquet answer table with one row per key; a missing one is empty.

    Two runs that append at once may both store a key. With ``keys``, a table of one column, only the
    buckets of those keys are read.
    """
    buckets = None if keys is None else buckets_of(keys)
    return one_per_key(read_buckets(spark, path, schema, buckets).drop(BUCKET))


def one_per_key(answers: DataFrame) -> DataFrame:
    """Of answers with one key a hit before a miss, then the least id; null keys are dropped."""
    key, value = answers.columns
    return answers.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


def new_answers(answers: DataFrame, known: DataFrame) -> DataFrame:
    """Answers whose key is not stored yet, one per key; a stored miss counts as stored."""
    key = answers.columns[0]
    return one_per_key(answers).join(known.select(key), key, "left_anti")


def append_answers(answers: DataFrame, path: str, schema: str) -> None:
    """Add the new answers to the stored ones. Each append commits as a whole.

    Only the buckets of the answers' keys are read; ``answers`` is used twice for that.
    """
    key = answers.columns[0]
    known = read_answers(answers.sparkSession, path, schema, answers.select(key))
    append_buckets(new_answers(answers, known), path, key)
