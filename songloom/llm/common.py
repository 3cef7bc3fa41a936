"""Helpers of this subpackage: hot-safe numbering, connected components, tolerant input columns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import reduce, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songloom.plans.staging import stage

CELL_ROWS = 1000  # rows that one cell of a group holds on average when rows are numbered


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under fixed names (``pick(df, id="doc_id")``): extra ones can't clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of the frame has, whatever its own are called."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        names.append(name)
    return names


def hashable(df: DataFrame) -> list[Column]:
    """All columns for ``xxhash64``; types that hold a map go in as JSON."""
    columns = [(F.col(f"`{f.name}`"), f.dataType.simpleString()) for f in df.schema]
    return [F.to_json(F.struct(c.alias("c"))) if "map<" in kind else c for c, kind in columns]


def same(left: str, right: str, keys: list[str]) -> Column:
    """Join condition on keys of two aliased frames, null equal to null."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def numbered(
    rows: DataFrame, keys: list[str], order: list[str], group_rows: str, name: str, ties: tuple[str, ...] = ()
) -> DataFrame:
    """Number the rows of each group gaplessly from 0, however large a group is.

    ``group_rows`` names a column with the size of the row's group. A group is dealt over cells of
    about a thousand rows by a hash of ``order``; rows are numbered in their cell, and the sizes of
    the cells before it are added. Reruns give the same numbers if ``order`` and ``ties`` tell rows apart;
    ``ties`` say nothing else.
    """
    cells = F.ceil(F.col(group_rows) / F.lit(CELL_ROWS))
    dealt = rows.withColumn("_cell", F.pmod(F.xxhash64(*order), F.greatest(cells, F.lit(1))))
    within = Window.partitionBy(*keys, "_cell").orderBy(*order, *ties)
    local = dealt.withColumn("_place", F.row_number().over(within).cast("long") - 1)
    sizes = dealt.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    joined = local.alias("l").join(starts.alias("r"), same("l", "r", [*keys, "_cell"]))
    kept = [F.col(f"l.{c}").alias(c) for c in rows.columns]
    return joined.select(*kept, (F.col("l._place") + F.col("r._before")).alias(name))


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the undirected edges ``(a, b)``: its least reachable node.

    Each round points every node at its least neighbour, follows the pointers, and contracts the
    edges, so that only edges between different labels are left. Every round is a few joins and
    partial aggregates over written tables; nothing is gathered.
    """
    edges = stage(edges.select("a", "b").filter("a <> b").distinct())
    ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = ends.select("node", F.col("node").alias("label"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p"))
        parent = stage(_followed(stage(_followed(least))))
        to = parent.select(F.col("a").alias("at"), F.col("p").alias("to"))
        moved = labels.join(to, labels["label"] == to["at"], "left")
        labels = stage(moved.select("node", F.coalesce("to", "label").alias("label")))
        left = edges.join(to, edges["a"] == to["at"]).select(F.col("to").alias("a"), "b")
        right = left.join(to, left["b"] == to["at"]).select("a", F.col("to").alias("b"))
        edges = stage(right.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return labels


def _followed(parent: DataFrame) -> DataFrame:
    nxt = parent.select(F.col("a").alias("_at"), F.col("p").alias("_up"))
    return parent.join(nxt, parent["p"] == nxt["_at"]).select("a", F.col("_up").alias("p"))


def give_back_memory() -> None:
    """Return freed memory to the system: idle Python workers keep it otherwise, next to the running ones."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # not glibc
        ctypes.CDLL(None).malloc_trim(0)


def lean(rows: Callable) -> Callable:
    """A function on an iterator of batches that gives memory back after each batch and at its end."""

    @wraps(rows)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            yield batch
            del batch
            give_back_memory()
        give_back_memory()

    return run


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a stream of batches that is sorted by ``keys``, one table each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and not _same_key(held[-1], held[-1].num_rows - 1, batch, 0, keys):
            yield pa.Table.from_batches(held)
            held = []
        changed = np.zeros(batch.num_rows, bool)
        for key in keys:
            ids = batch[key].dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            changed[1:] |= ids[1:] != ids[:-1]
        begin = 0
        for at in np.flatnonzero(changed):
            yield pa.Table.from_batches([*held, batch.slice(begin, at - begin)])
            held, begin = [], int(at)
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def _same_key(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int, keys: list[str]) -> bool:
    return all(a[k][i].as_py() == b[k][j].as_py() for k in keys)
