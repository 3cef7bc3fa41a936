"""Counts and ids against the tokenizers library itself."""

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from songloom.llm.packing import packed_documents
from songloom.llm.token_counts import read_cache, token_counts
from songloom.llm.tokenizing import token_ids, tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library_for_all_characters(library):
    points = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF and (c < 0x3000 or c % 61 == 0)]
    texts = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)} !{chr(c)}?  {chr(c)}{chr(c)} x" for c in points]
    for begin in range(0, len(texts), 5000):
        part = texts[begin : begin + 5000]
        for text, found in zip(part, library.encode_batch(part, add_special_tokens=False)):
            assert token_ids(PATH, text).tolist() == found.ids, repr(text)


def test_ids_equal_the_library_for_random_strings(library):
    r = random.Random(4)
    letters = [chr(c) for c in range(0x250)] + list("  \n\t'sdre<|endoftext|>") * 20 + ["<|endoftext|>", "’"] * 10
    for _ in range(4000):
        text = "".join(r.choices(letters, k=r.randint(0, 60)))
        assert token_ids(PATH, text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


LONG = [" " * 2_000_000, "\n" * 2_000_000, " \n" * 1_000_000, "\\" * 2_000_000, "x" + " " * 1_500_000 + "y"]


@pytest.mark.parametrize("text", [" " * 200_000, "x" * 50_000, "word " * 100_000, "\n \n" * 30_000, *LONG])
def test_very_long_texts(library, text):
    assert token_ids(PATH, text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_other_tokenizers():
    assert len(token_ids(tokenizer_path("word_bpe_49k.json"), "Hello there")) == 2
    assert len(token_ids(tokenizer_path("piece_bpe_32k.model"), "Hello there")) == 2


def test_counts_and_cache(spark, tmp_path, library):
    rows = [(1, "hello world"), (2, None), (3, ""), (4, "hello world"), (None, "<|endoftext|> é"), (5, "a b " * 600)]
    frame = spark.createDataFrame([(i, t, 9, "x") for i, t in rows], "doc_id long, text string, n_tokens int, digest string")
    cache = str(tmp_path / "cache")

    def count(text):
        return len(library.encode(text or "", add_special_tokens=False).ids)

    want = sorted([(i, len((t or "").encode()), count(t), count(t) > 512) for i, t in rows], key=str)
    for _ in range(2):
        assert sorted(map(tuple, token_counts(frame, cache).collect()), key=str) == want
        assert read_cache(spark, cache, PATH).count() == 4
    files = spark.read.parquet(cache).select(F.input_file_name()).distinct().count()
    token_counts(frame.union(spark.createDataFrame([(6, "new", 0, "")], frame.schema)), cache).collect()
    assert spark.read.parquet(cache).count() == 5 and spark.read.parquet(cache).select(F.input_file_name()).distinct().count() > files
    # What the cache says is what counts: a stored number is used, not made again.
    other = str(tmp_path / "other")
    token_counts(frame.filter("doc_id = 1"), other).collect()
    stored = spark.read.parquet(other)
    planted = [(r.digest, 77, r.tokenizer) for r in stored.collect()]
    fresh = str(tmp_path / "planted")
    spark.createDataFrame(planted, "digest binary, n_tokens long, tokenizer string").write.partitionBy("tokenizer").parquet(fresh)
    assert {r.n_tokens for r in token_counts(frame.filter("doc_id in (1, 4)"), fresh).collect()} == {77}


def test_no_text_ends_the_job(spark, tmp_path, library):
    frame = spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts(frame, str(tmp_path / "cache")).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(LONG)}
    lengths = packed_documents(frame).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n - 1 for r in lengths} == got  # an end token each


def test_empty_table(spark, tmp_path):
    assert token_counts(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "c")).count() == 0
