"""Approximate nearest neighbours by largest inner product, with a hierarchical k-means tree.

The tree is fitted on the driver over at most ``FIT_ROWS`` vectors, chosen by a hash of their id; every
vector is then put into its leaf. Leaves of more than ``SPLIT_ROWS`` vectors are split further, each in a task
of its own over at most some ``SPLIT_FIT`` of its vectors, so that leaves follow the table up to ``MAX_LEAVES``
of them; beyond that they grow. A query walks the tree best bin first: a priority queue holds the
nodes seen, keyed by how large an inner product below is likely to get, and leaves are visited
in the order in which they come off the queue. How many leaves are visited is calibrated: for at most
``CALIBRATION_ROWS`` queries the true neighbours are found by brute force over all vectors, and the
number is the least for which they miss no more than ``1 - RECALL`` of them. A query whose leaves hold
too few vectors visits more, until it has its number of neighbours or all candidates.

A leaf is searched in blocks of vectors and of queries, however many either holds, by matrix products
in double precision; near the cut-off scores are made again one by one in a fixed order, so equal vectors
have equal scores and ties go to the smaller id.

Left out are vectors that are null, zero, or hold null or non-finite components, null ids, and vectors
and queries of another length than most vectors have. Of rows that repeat an id the greatest vector counts.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songloom.llm.common import pick, sorted_groups
from songloom.plans.staging import stage

FIT_ROWS, CALIBRATION_ROWS = 20_000, 200
BRANCHES, LEAF_ROWS, ROUNDS = 16, 100, 12
SPLIT_ROWS, SPLIT_FIT, MAX_LEAVES = 400, 4096, 1 << 16
RECALL = 0.98
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
ROW_SCHEMA = "vec_id long, vector array<double>"


@dataclass
class Node:
    """Half of its vectors lie within ``radius`` of ``center``; a leaf has a number, other nodes have children."""

    center: np.ndarray
    radius: float
    leaf: int = -1
    children: list["Node"] = field(default_factory=list)
    centers: np.ndarray | None = None  # of the children, and their radii
    radii: np.ndarray | None = None


@dataclass
class Tree:
    root: Node
    leaves: list[Node]

    def leaf_order(self, query: np.ndarray, most: int, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The first leaves of a best-bin-first walk; more than ``most`` until they hold ``least`` vectors."""
        held, found, tick, norm = 0, [], 0, float(np.sqrt(query @ query))
        queue = [(0.0, tick, self.root)]
        while queue and (len(found) < most or held < least):
            _, _, node = heapq.heappop(queue)
            if node.leaf >= 0:
                found.append(node.leaf)
                held += int(sizes[node.leaf]) if sizes is not None else 0
            if node.children:
                for key, child in zip((-(node.centers @ query) - norm * node.radii).tolist(), node.children):
                    tick += 1
                    heapq.heappush(queue, (key, tick, child))
        return found

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: from the root down, the child with the nearest center."""
        out = np.zeros(len(vectors), np.int32)
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            node, at = todo.pop()
            if node.leaf >= 0:
                out[at] = node.leaf
            elif len(at):
                nearest = _nearest_center(vectors[at], node.centers)
                todo += [(child, at[nearest == k]) for k, child in enumerate(node.children)]
        return out


def _nearest_center(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (-2 * vectors @ centers.T + (centers**2).sum(axis=1)).argmin(axis=1)


def _numbered(root: Node) -> Tree:
    """The tree below a node: leaves get numbers, and nodes what a walk needs of their children."""
    leaves, todo = [], [root]
    while todo:
        node = todo.pop()
        node.leaf = -1 if node.children else len(leaves)
        if node.children:
            node.centers = np.stack([c.center for c in node.children])
            node.radii = np.array([c.radius for c in node.children])
            todo += reversed(node.children)
        else:
            leaves.append(node)
    return Tree(root, leaves)


def fit_tree(vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
    """k-means at every level until a node holds few of the fitted vectors; centers from fixed draws."""
    rng = np.random.default_rng(10)

    def grow(own: np.ndarray, depth: int) -> Node:
        center = own.mean(axis=0)
        node = Node(center, float(np.sqrt(np.median(((own - center) ** 2).sum(axis=1)))))
        names = np.zeros(0)
        if len(own) > leaf_rows and depth < 20:
            centers = own[rng.choice(len(own), min(BRANCHES, -(-2 * len(own) // leaf_rows), len(own)), replace=False)]
            for _ in range(ROUNDS):
                nearest = _nearest_center(own, centers)
                names = np.unique(nearest)
                centers = np.stack([own[nearest == k].mean(axis=0) for k in names])
            nearest = _nearest_center(own, centers)
            names = np.unique(nearest)
        if len(names) > 1:
            node.children = [grow(own[nearest == k], depth + 1) for k in names]
        return node

    return _numbered(grow(vectors, 0))


def usable_vectors(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", length: int | None = None
) -> DataFrame:
    """``(vec_id, vector)``, one row for each id that takes part; vectors have ``length``, else the usual one."""
    rows = pick(embeddings, vec_id=id_col, vector=vector_col).filter("vec_id is not null and vector is not null")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists("vector", lambda x: x != 0))
    if length is None:
        lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
        usual = lengths.orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
        length = usual[0]["length"] if usual else 0
    rows = rows.filter(F.size("vector") == length)
    return rows.groupBy("vec_id").agg(F.max("vector").alias("vector"))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def best_of(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
    """``(query row, vector row, score)`` of the best ``k`` for each query, but its own id."""
    for begin in range(0, len(queries), 64):
        part = queries[begin : begin + 64]
        rough = part @ vectors.T
        rough[query_ids[begin : begin + 64, None] == ids[None, :]] = -np.inf
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(rough), rough, 0)).max(axis=1))
        floor = np.partition(rough, max(0, rough.shape[1] - k), axis=1)[:, max(0, rough.shape[1] - k)] - slack
        for q in range(len(part)):
            at = np.flatnonzero((rough[q] >= floor[q]) & (rough[q] > -np.inf))
            score = (part[q] * vectors[at]).sum(axis=1)
            order = np.lexsort((ids[at], -score))[:k]
            yield begin + q, at[order], score[order]


def _leaf_rows(tree: Tree):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = pa.array(tree.leaf_of(_matrix(batch["vector"])), pa.int32())
                yield batch.append_column("leaf", leaf)

    return rows


def _split_rows(leaf_rows: int):
    """One row for each leaf: the tree fitted to the vectors of it that came, as bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["leaf"]):
            vectors, held = _matrix(group["vector"]), group["held"][0].as_py()
            below = fit_tree(vectors, max(2, leaf_rows * len(vectors) // held))
            yield pa.RecordBatch.from_pydict({
                "leaf": pa.array([group["leaf"][0].as_py()], pa.int32()), "below": pa.array([pickle.dumps(below.root)], pa.binary()),
            })

    return rows


def leaf_sizes(tree: Tree, indexed: DataFrame) -> np.ndarray:
    held = np.zeros(len(tree.leaves), np.int64)
    for r in indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect():  # about MAX_LEAVES rows at most
        held[r["leaf"]] = r["n"]
    return held


def tree_of(usable: DataFrame, fitted: np.ndarray) -> tuple[Tree, DataFrame]:
    """A tree whose leaves follow the table, and the written ``(vec_id, vector, leaf)`` of all rows."""
    spark, tree = usable.sparkSession, fit_tree(fitted)
    indexed = stage(usable.mapInArrow(_leaf_rows(tree), ROW_SCHEMA + ", leaf int"))
    held = leaf_sizes(tree, indexed)
    wanted = max(SPLIT_ROWS, -(-int(held.sum()) // MAX_LEAVES))
    large = [(int(leaf), int(held[leaf])) for leaf in np.flatnonzero(held > wanted)]
    if not large:
        return tree, indexed
    rows = indexed.join(spark.createDataFrame(large, "leaf int, held long"), "leaf")
    some = rows.filter(F.pmod(F.xxhash64(F.lit("split"), "vec_id"), F.ceil(F.col("held") / SPLIT_FIT)) == 0)
    dealt = some.select("leaf", "held", "vec_id", "vector").repartition("leaf").sortWithinPartitions("leaf", "vec_id")
    for r in dealt.mapInArrow(_split_rows(wanted), "leaf int, below binary").collect():  # centers of new leaves
        tree.leaves[r["leaf"]].children = pickle.loads(r["below"]).children
    tree = _numbered(tree.root)
    return tree, stage(usable.mapInArrow(_leaf_rows(tree), ROW_SCHEMA + ", leaf int"))


def _visit_rows(tree: Tree, visits: int, sizes: np.ndarray, least: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            orders = [tree.leaf_order(q, visits, sizes, least) for q in _matrix(batch["vector"])] if batch.num_rows else []
            leaves = pa.array(orders, pa.list_(pa.int32()))
            yield batch.append_column("leaves", leaves)

    return rows


def _block_best(k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["leaf", "block", "query_block"]):
            asks = group["asks"].to_numpy()
            ids, vectors = group["vec_id"].to_numpy(), _matrix(group["vector"])
            queries, members = np.flatnonzero(asks), np.flatnonzero(~asks)
            if len(queries) and len(members):
                yield _best_batch(vectors[queries], ids[queries], vectors[members], ids[members], k)

    return rows


def _best_batch(queries, query_ids, vectors, ids, k) -> pa.RecordBatch:
    found = [(np.full(len(at), query_ids[q]), ids[at], score) for q, at, score in best_of(queries, query_ids, vectors, ids, k)]
    columns = [np.concatenate(c) for c in zip(*found)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])


def _brute_rows(queries: np.ndarray, query_ids: np.ndarray, k: int):
    """The calibration queries against every vector of a batch."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _best_batch(queries, query_ids, _matrix(batch["vector"]), batch["vec_id"].to_numpy(), k)

    return rows


def _first(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


RESULT_SCHEMA = "query_id long, vec_id long, score double"


def exact_neighbours(vectors: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Brute force for a few given queries: the reference for calibration and tests."""
    return _first(vectors.mapInArrow(_brute_rows(queries, query_ids, k), RESULT_SCHEMA), k)


def _sample(vectors: DataFrame, n: int, salt: str) -> tuple[np.ndarray, np.ndarray]:
    got = vectors.orderBy(F.xxhash64(F.lit(salt), "vec_id"), "vec_id").limit(n).toArrow()
    return got["vec_id"].to_numpy(), _matrix(got["vector"])


def calibrated_visits(tree: Tree, indexed: DataFrame, queries: DataFrame, k: int, recall: float) -> int:
    """The least number of leaves that finds ``recall`` of the sampled queries' true neighbours."""
    ids, vectors = _sample(queries, CALIBRATION_ROWS, "calibration")
    true = exact_neighbours(indexed, ids, vectors, k).select("query_id", "vec_id")
    rows = true.join(indexed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()
    place = {int(i): {leaf: n for n, leaf in enumerate(tree.leaf_order(v, len(tree.leaves)))} for i, v in zip(ids, vectors)}
    needed = sorted(place[r["query_id"]][r["leaf"]] + 1 for r in rows)
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else 1


def nearest_neighbours(
    embeddings: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    recall: float = RECALL, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best found for each query among all other ids.

    ``queries`` has the columns of ``embeddings``; a query never finds its own id. The first levels of the tree
    are fitted to ``fit_rows`` vectors.
    """
    spark = embeddings.sparkSession
    usable = stage(usable_vectors(embeddings, id_col, vector_col))
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    _, sample = _sample(usable, fit_rows, "fit")
    if not len(sample):
        return nothing
    asked = stage(usable_vectors(queries, id_col, vector_col, length=sample.shape[1]))
    if asked.isEmpty():
        return nothing
    tree, indexed = tree_of(usable, sample)
    visits = calibrated_visits(tree, indexed, asked, k, recall)
    held = leaf_sizes(tree, indexed)
    # One more than k, since a query's own id is among them.
    visiting = asked.mapInArrow(_visit_rows(tree, visits, held, k + 1), ROW_SCHEMA + ", leaves array<int>")
    visiting = stage(visiting.select("vec_id", "vector", F.explode("leaves").alias("leaf")))

    def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
        return rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))

    sizes = blocks(indexed, BLOCK_ROWS, "blocks").join(blocks(visiting, BLOCK_QUERIES, "query_blocks"), "leaf")
    own, other = F.pmod(F.hash("vec_id"), F.col("blocks")), F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))
    members = indexed.join(sizes, "leaf").select(
        "leaf", own.alias("block"), other.alias("query_block"), F.lit(False).alias("asks"), "vec_id", "vector"
    )
    own, other = F.pmod(F.hash("vec_id"), F.col("query_blocks")), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asking = visiting.join(sizes, "leaf").select(
        "leaf", other.alias("block"), own.alias("query_block"), F.lit(True).alias("asks"), "vec_id", "vector"
    )
    keys = ["leaf", "block", "query_block"]
    met = members.unionByName(asking).repartition(*keys).sortWithinPartitions(*keys)
    found = _first(met.mapInArrow(_block_best(k), RESULT_SCHEMA), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
