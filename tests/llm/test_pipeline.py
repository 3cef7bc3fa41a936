"""The pipeline's stages: columns, decisions that take effect, and what each must leave alone."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from songloom.llm.near_duplicates import near_duplicate_classes
from songloom.llm.quality_model import graded_quality, grades_of_labels

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    frames = [docs]
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        function(spark, frames[-1], FOLDER).write.parquet(path)
        frames.append(spark.read.parquet(path))
    return frames


def test_columns_and_order(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "language_id", "near_dedup", "mixing", "packing"]
    assert all(f.columns == steps[0].columns for f in steps[:-1])


def test_each_stage_works_on_what_the_last_kept(spark, steps):
    docs, good, known, distinct, mixed, packed = steps
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in steps]
    labels = grades_of_labels(spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert ids[1] == {r.doc_id for r in graded_quality(docs, labels).filter("kept").collect()}
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] >= ids[4] == ids[5]
    classes = near_duplicate_classes(known)
    assert ids[3] == {r.component_id for r in classes.collect()} and distinct.count() == len(ids[3])
    assert mixed.count() == packed.filter("piece = 0").count() >= 0.5 * distinct.count()


def test_registered(spark):
    assert {"pipeline", *(f"op{n}_" for n in range(1, 14))} == {
        n if n == "pipeline" else n.split("_")[0] + "_" for n in queries() if n == "pipeline" or n.startswith("op")
    }
    with_sql = {n.split("_")[0] for n in oracle_sql() if n.startswith("op")}
    assert with_sql == {"op5", "op8", "op11", "op12", "op13"}
    assert queries()["pipeline"](spark, FOLDER).count() > 0
