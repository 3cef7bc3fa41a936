"""A corpus pipeline over ``documents``: each stage works on what the one before it kept.

All stages but the last return the columns of ``documents``; ``mixing`` repeats rows. The last returns
one row for each packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from songloom.llm.language_id import identified_documents
from songloom.llm.mixing import mixed_documents
from songloom.llm.near_duplicates import keep_one_of_each
from songloom.llm.packing import packed_documents
from songloom.llm.quality_model import grades_of_labels, selected_documents
from songloom.llm.queries import prepare_session
from songloom.plans.staging import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that probably have less than the top grade."""
    prepare_session(spark)
    graded = grades_of_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return selected_documents(docs, graded)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in no language, or plainly in another than they say."""
    prepare_session(spark)
    return identified_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    prepare_session(spark)
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    prepare_session(spark)
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 1,024 tokens."""
    prepare_session(spark)
    return packed_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
ORACLE_SQL = None  # trained models and packing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = function(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stage(docs)
    return docs
