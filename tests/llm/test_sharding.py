"""Sharding laws: balance by weight, few moves, gapless slots."""

import math
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from songloom.llm.sharding import SEED, rendezvous_shard, sharded_documents


def test_weights_are_met(spark):
    shard = rendezvous_shard(["id"], [1.0, 2.0, 5.0])
    counts = Counter(r.s for r in spark.range(40000).select(shard.alias("s")).collect())
    assert all(abs(counts[s] / 40000 - w / 8) < 0.01 for s, w in enumerate([1, 2, 5]))


def test_a_new_shard_takes_only_into_itself(spark):
    rows = spark.range(20000).select(
        rendezvous_shard(["id"], [1.0] * 24).alias("a"), rendezvous_shard(["id"], [1.0] * 25).alias("b")
    ).collect()
    moved = [r for r in rows if r.a != r.b]
    assert all(r.b == 24 for r in moved) and 0.03 < len(moved) / 20000 < 0.05


def test_slots_are_gapless_and_sizes_count_bytes(spark):
    rows = [(i, f"é{i}") for i in range(5000)] + [(None, None), (None, ""), (7, "é7"), (7, "é7")]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, shard int, size string")
    got = sharded_documents(frame, 3).collect()
    assert len(got) == len(rows)
    for shard in range(3):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.text_crc32 == zlib.crc32(f"é{r.doc_id}".encode()) for r in got if r.doc_id is not None)
    assert {r.size for r in got if r.doc_id is None} == {8}
    assert len({r.shard for r in got if r.doc_id == 7}) == 1
    again = sharded_documents(frame.repartition(5).orderBy(F.rand(1)), 3).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def plain_shard(key, weights):
    """The draws in plain Python: the column function hashes value after value, each seeded by the one before."""
    draws = []
    for shard, weight in enumerate(weights):
        h = 42
        for value, size in ((SEED, 4), (shard, 4), (key, 8)):
            if value is not None:
                h = xxhash.xxh64_intdigest(value.to_bytes(size, "little", signed=True), h)
        draws.append((-math.log(((h >> 11) + 0.5) / (1 << 53)) / weight, shard))
    return min(draws)[1]


def test_draws_against_plain_python_and_weights(spark):
    keys = [None, 0, -1, -(2**63), 2**63 - 1, *range(1, 30000, 7)]
    frame = spark.createDataFrame([(k, "x") for k in keys], "doc_id long, text string")
    weights = [1.0, 0.5, 4.0, 2.5]
    got = sharded_documents(frame, weights=weights, grown_weight=2.0).collect()
    assert len(got) == len(keys)
    for r in got:
        assert (r.shard, r.grown_shard) == (plain_shard(r.doc_id, weights), plain_shard(r.doc_id, [*weights, 2.0]))
    assert all(r.grown_shard in (r.shard, 4) for r in got)
    counts = Counter(r.shard for r in got)
    assert all(abs(counts[s] / len(keys) - w / 8) < 0.03 for s, w in enumerate(weights))


def test_empty_table(spark):
    assert sharded_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_plan_is_native(spark):
    plan = sharded_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert not any(w in plan._jdf.queryExecution().toString() for w in ("Python", "Pandas", "Arrow"))
