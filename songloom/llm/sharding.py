"""Rendezvous sharding by a stable record key, built of stock Spark expressions only.

Every shard draws a number from the record's key and the shard's own number; the record goes to
the shard with the least ``-ln(u) / weight``. That gives each shard its weight's part of the keys,
and a further shard takes records from all others only into itself: no record moves between two
shards that both stay.

A null key is a key like any other. Rows with equal keys share a shard, so a key that repeats
makes its shard larger: that is what a law by key means. Nothing but keys and the asked columns is
shuffled, and texts never are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songloom.llm.common import numbered, pick

SEED = 7


def _draw(keys: list[str], shard: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.lit(shard), *keys), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    return F.struct((-F.log(uniform) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard"))


def rendezvous_shard(keys: list[str], weights: list[float]) -> Column:
    """The shard, 0 to ``len(weights) - 1``, that these key columns belong to."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    draws = [_draw(keys, shard, weight) for shard, weight in enumerate(weights)]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def with_slots(rows: DataFrame, order: list[str], shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Number the rows of each shard gaplessly from 0, over many tasks however few shards there are."""
    sizes = rows.groupBy(shard).agg(F.count(F.lit(1)).alias("_shard_rows"))
    return numbered(rows.join(sizes, shard), [shard], order, "_shard_rows", slot).drop("_shard_rows")


def sharded_documents(
    documents: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
    weights: list[float] | None = None, grown_weight: float = 1.0,
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one shard for each of the ``weights``.

    Without ``weights`` there are ``shards`` of equal weight. ``grown_shard`` is the place with one more shard,
    of ``grown_weight``. A null text has no bytes.
    """
    weights = [1.0] * shards if weights is None else list(weights)
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = pick(documents, doc_id=id_col, text=text_col).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        rendezvous_shard(["doc_id"], weights).alias("shard"),
        rendezvous_shard(["doc_id"], [*weights, grown_weight]).alias("grown_shard"),
    )
    placed = with_slots(rows, ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
