"""Best-fit packing of tokenized documents, planned on the histogram of lengths.

Pieces are at most ``capacity`` tokens long, so their histogram has at most that many rows, whatever
the corpus holds. Best-fit-decreasing runs over the histogram: all pieces of one length and all open
sequences with the same room move at once. The plan says, for each length, which ranks go to which
sequences; every piece finds its place by joining its rank among the pieces of its length.

A null text is empty: it has one piece, the end token alone. Rows that repeat a document are packed
as often as they come. Reruns give the same places if rows differ or are equal in all columns.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songloom.llm.common import lean, numbered, pick
from songloom.llm.tokenizing import token_ids, tokenizer_path
from songloom.plans.staging import stage

CAPACITY, END = 1024, 2
PIECE_SCHEMA = "doc_id {id}, piece int, start long, length long, ids_crc32 long"
SLOT_SCHEMA = "length long, first long, past long, base long, sequences long, offset long"


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Where the pieces of ``n`` tokens begin and end: all full but the first."""
    end = n - (n - 1) // capacity * capacity
    begin = 0
    while begin < n:
        yield begin, end
        begin, end = end, end + capacity


def _pieces(tokenizer: str, capacity: int, end_id: int):
    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch["text"]):
                ids = np.append(token_ids(tokenizer, text.as_py() or ""), end_id).astype("<u4")
                for k, (a, b) in enumerate(cut(len(ids), capacity)):
                    at.append(row), piece.append(k), start.append(a), length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"].take(pa.array(at, pa.int64())), "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            })

    return rows


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Best-fit-decreasing over counts: ``(lengths in a sequence, number of such sequences)``.

    As one after another, each piece goes to the open sequence with the least room that it fits,
    or to a new one; a sequence that takes one piece of a length takes all that fit.
    """
    by_room: dict[int, list[tuple[list[int], int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, content: list[int], n: int) -> None:
        if n and room not in by_room:
            insort(rooms, room)
        if n:
            by_room[room].append((content, n))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            each = room // length
            if at < len(rooms):
                content, n = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            else:
                content, n = [], -(-left // each)
            full = min(n, left // each)
            rest = min(left - full * each, each - 1) if full < n else 0
            put(room - each * length, content + [length] * each, full)
            if rest:
                put(room - rest * length, content + [length] * rest, 1)
            put(room, content, n - full - bool(rest))
            left -= full * each + rest
    return [group for groups in by_room.values() for group in groups]


def slots(plan: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each place in a kind of sequence: the ranks of its length that go there, and where it is."""
    taken: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for lengths, n in plan:
        offset = 0
        for length in lengths:
            rows.append((length, taken[length], taken[length] + n, base, n, offset))
            taken[length] += n
            offset += length
        base += n
    return rows


def packed_documents(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
    capacity: int = CAPACITY, end_id: int = END,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row for each piece."""
    spark = documents.sparkSession
    given = pick(documents, doc_id=id_col, text=text_col)
    schema = PIECE_SCHEMA.format(id=given.schema["doc_id"].dataType.simpleString())
    pieces = stage(given.mapInArrow(_pieces(tokenizer or tokenizer_path(), capacity, end_id), schema))
    counts = stage(pieces.groupBy("length").agg(F.count(F.lit(1)).alias("_n")))
    histogram = {r["length"]: r["_n"] for r in counts.collect()}  # at most ``capacity`` rows
    places = spark.createDataFrame(slots(best_fit(histogram, capacity)), SLOT_SCHEMA)

    ranked = numbered(pieces.join(counts, "length"), ["length"], ["doc_id", "piece", "ids_crc32", "start"], "_n", "_rank")
    fits = (F.col("p.length") == F.col("s.length")) & (F.col("_rank") >= F.col("first")) & (F.col("_rank") < F.col("past"))
    return ranked.alias("p").join(places.alias("s"), fits).select(
        "doc_id", "piece", "start", "p.length", "ids_crc32",
        (F.col("base") + F.col("_rank") - F.col("first")).alias("sequence_id"), "offset",
    )
