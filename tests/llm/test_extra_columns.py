"""Every operator on documents next to columns that are called like helpers, and on maps and structs."""

import pytest
from pyspark.sql import functions as F

from songloom.llm.fill_in_middle import fill_in_middle
from songloom.llm.language_id import identified_documents, identify_languages
from songloom.llm.mixing import mixed_documents, mixing_plan
from songloom.llm.near_duplicates import keep_one_of_each, near_duplicate_classes
from songloom.llm.packing import packed_documents
from songloom.llm.quality_model import graded_quality, grades_of_labels, selected_documents
from songloom.llm.quality_rules import quality_verdicts
from songloom.llm.sharding import sharded_documents
from songloom.llm.token_counts import token_counts

NAMES = [
    "_d1", "_d2", "_each", "_more", "_part", "_copy", "_kept", "_digest", "_language", "_rank", "_cell", "digest", "label",
    "size", "n", "copies", "rate", "target", "shard", "slot", "p", "_place", "_before", "_N", "words", "node", "rep",
]
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").drop("n_chars")
    more = [F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in NAMES]
    nested = [F.create_map("lang", "source").alias("a map"), F.struct("lang", F.array(F.create_map("source", "lang"))).alias("a.struct")]
    return given.select("*", *more, *nested)


@pytest.fixture(scope="module")
def labels(spark):
    return grades_of_labels(spark.read.parquet(f"{FOLDER}/labels.parquet"))


STAGES = {
    "quality_classifier": lambda documents, labels: selected_documents(documents, labels),
    "language_id": lambda documents, labels: identified_documents(documents),
    "near_dedup": lambda documents, labels: keep_one_of_each(documents),
    "mixing": lambda documents, labels: mixed_documents(documents),
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_return_the_rows_as_they_are(documents, labels, name):
    kept = STAGES[name](documents, labels)
    assert kept.columns == documents.columns
    as_text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in documents.columns]))
    got = {r[0] for r in kept.select(as_text).collect()}
    assert got and got <= {r[0] for r in documents.select(as_text).collect()}


OPERATORS = {
    "op1": lambda d, labels, folder: token_counts(d, folder),
    "op2": lambda d, labels, folder: graded_quality(d, labels),
    "op3": lambda d, labels, folder: quality_verdicts(d, labels.filter("grade = 2").select("doc_id")),
    "op4": lambda d, labels, folder: mixing_plan(d),
    "op6": lambda d, labels, folder: packed_documents(d),
    "op7": lambda d, labels, folder: sharded_documents(d, 5),
    "op8": lambda d, labels, folder: near_duplicate_classes(d),
    "op9": lambda d, labels, folder: identify_languages(d),
    "op13": lambda d, labels, folder: fill_in_middle(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_give_the_same_rows(documents, labels, tmp_path, name):
    plain = documents.select("doc_id", "text", "lang", "source")
    got, want = (OPERATORS[name](d, labels, str(tmp_path / str(k))) for k, d in enumerate((documents, plain)))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
