"""Token counts through a digest cache.

Normalised content (null as empty, the UTF-8 bytes of the text) has a SHA-256 digest, and so have the
tokenizer and the way it is used. Counts are kept under both digests in a parquet folder, which any
number of runs share: only distinct content that the cache does not hold is encoded, whole, and its
counts are appended. Copies are brought together before the texts are shuffled, and a cache row is
the same whoever writes it, so two runs at once do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songloom.llm.common import lean, pick
from songloom.llm.tokenizing import token_ids, tokenizer_path, tokenizer_version
from songloom.plans.staging import stage

CACHE_SCHEMA = "digest binary, n_tokens long"


def _version_folder(cache: str, tokenizer: str) -> str:
    return f"{cache}/tokenizer={tokenizer_version(tokenizer)}"


def read_cache(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row for each digest."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(_version_folder(cache, tokenizer))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encode(tokenizer: str):
    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [len(token_ids(tokenizer, value.as_py())) for value in batch["text"]]
            yield pa.RecordBatch.from_pydict({"digest": batch["digest"], "n_tokens": pa.array(counts, pa.int64())})

    return rows


def token_counts(
    documents: DataFrame, cache: str, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None, limit: int = 512,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row; the cache is filled first."""
    tokenizer = tokenizer or tokenizer_path()
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit(""))
    given = pick(documents, doc_id=id_col, text=text_col).withColumn("text", text)
    given = given.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    known = read_cache(spark, cache, tokenizer).select("digest")
    missing = given.select("digest", "text").dropDuplicates(["digest"]).join(known, "digest", "left_anti")
    counted = missing.mapInArrow(_encode(tokenizer), CACHE_SCHEMA)
    counted.write.mode("append").parquet(_version_folder(cache, tokenizer))

    # Written, so that the join has a shuffle of its own on this side and a hot digest can be split.
    stored = stage(read_cache(spark, cache, tokenizer))
    sizes = given.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return sizes.join(stored, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
