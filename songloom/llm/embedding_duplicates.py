"""Embedding near-duplicates: PCA-ordered tiles, compared over their leading dimensions first.

Vectors are scaled to length 1 and turned into the basis of their principal components, which leaves
every inner product as it is. Two tiles of vectors are multiplied over the first dimensions only; what
the others can add is at most the product of the two suffix norms, so pairs whose sum stays below the
threshold are dropped, and the rest goes on with the next dimensions. No pair that reaches the threshold
is lost, whatever the basis is.

Which tiles meet follows from distances. Each vector belongs to the cell of its nearest center and
visits those cells of which neither the dividing plane nor the radius rules out a partner; of two cells
one visits the other. Members within half the threshold's distance of their center, the core, are all
linked with each other, as is every visitor as near as that: they are counted and never compared, so a
group of very many near copies costs no square. Cells are cut into tiles of bounded size. On vectors
without any structure hardly a cell is ruled out, and the comparisons grow with the square of the table.

Links are decided in double precision; within 1e-9 of the threshold by exactly rounded sums over the
given vectors. A tile gives back a count and one partner for each vector, not its pairs.

The basis and the centers are fitted on the driver over at most ``FIT_VALUES`` components of at most
``FIT_ROWS`` vectors, chosen by a hash of their id; they decide about speed only.

Vectors that are null, zero, or hold null or non-finite components link with nothing, and vectors link
only with others as long. Equal vectors are compared as one. Of rows that repeat an id the greatest
usable vector counts; rows with a null id are left out. Columns other than the two named play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songloom.llm.common import components, lean, pick, sorted_groups
from songloom.plans.staging import stage

THRESHOLD = 0.9
FIT_ROWS, FIT_VALUES, MOST_CELLS, ROUNDS = 20_000, 1 << 22, 512, 8
TILE_ROWS, TILE_VALUES, STRIP = 8192, 1 << 19, 256
SLACK = 1e-9
SPARSE = 0.1  # share of open pairs below which they are followed one by one
CORE, OUTER, NEAR_VISITOR, VISITOR = range(4)


@dataclass
class Model:
    """The basis, and centers in it, for vectors of one length."""

    length: int
    basis: np.ndarray  # columns, by falling variance
    centers: np.ndarray


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by a power of two first, so that no square overflows."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    scaled = np.ldexp(vectors, -exponent[:, None])
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def fit_model(vectors: np.ndarray, cells: int) -> Model:
    """Principal components of unit vectors about the origin, and k-means centers among them."""
    rng = np.random.default_rng(12)
    _, basis = np.linalg.eigh(vectors.T @ vectors)
    basis = np.ascontiguousarray(basis[:, ::-1])
    turned = vectors @ basis
    centers = turned[rng.choice(len(turned), min(cells, len(turned)), replace=False)]
    for _ in range(ROUNDS):
        nearest = _squared_distances(turned, centers).argmin(axis=1)
        names = np.unique(nearest)
        centers = np.stack([turned[nearest == k].mean(axis=0) for k in names])
    return Model(vectors.shape[1], basis, centers)


def _squared_distances(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((rows**2).sum(axis=1)[:, None] + (centers**2).sum(axis=1) - 2 * rows @ centers.T, 0)


def _farthest(threshold: float) -> float:
    """The greatest distance between unit vectors that reach the threshold."""
    return math.sqrt(2 - 2 * threshold)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = np.diff(batch["vector"].offsets.to_numpy())
    for length in np.unique(lengths):
        yield int(length), batch.filter(pa.array(lengths == length))


HOME_SCHEMA = "rep long, n long, length int, cell int, distance double"


def _home_rows(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cell of each vector; lengths that the model doesn't know have one cell, without a center."""
    for batch in batches:
        for length, part in _by_length(batch):
            cell, distance = np.zeros(len(part), np.int32), np.full(len(part), np.inf)
            if length == model.length:
                squares = _squared_distances(unit_rows(_matrix(part["vector"])) @ model.basis, model.centers)
                cell = squares.argmin(axis=1).astype(np.int32)
                distance = np.sqrt(squares[np.arange(len(part)), cell])
            yield pa.RecordBatch.from_pydict({
                "rep": part["rep"], "n": part["n"], "length": pa.array(np.full(len(part), length, np.int32)),
                "cell": pa.array(cell), "distance": pa.array(distance), "vector": part["vector"],
            })


def _visits(model: Model, radii: np.ndarray, farthest: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each cell that a vector has to visit, with its distance from that cell's center."""
    cells = np.arange(len(model.centers))
    between = np.sqrt(_squared_distances(model.centers, model.centers))
    # Of two cells the lower visits the higher if their sum is even, else the other way round.
    goes = (cells[:, None] != cells) & ((cells[:, None] < cells) == ((cells[:, None] + cells) % 2 == 0))
    for batch in batches:
        for length, part in _by_length(batch):
            if length != model.length:
                continue
            home = part["cell"].to_numpy()
            squares = _squared_distances(unit_rows(_matrix(part["vector"])) @ model.basis, model.centers)
            own = squares[np.arange(len(part)), home]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = np.where(between[home] > 0, (squares - own[:, None]) / (2 * between[home]), 0)
            distance = np.sqrt(squares)
            row, cell = np.nonzero(goes[home] & (plane <= farthest + SLACK) & (distance - radii <= farthest + SLACK))
            for begin in range(0, len(row), 8192):
                at, to = row[begin : begin + 8192], cell[begin : begin + 8192]
                taken = part.take(pa.array(at))
                yield pa.RecordBatch.from_pydict({
                    "rep": taken["rep"], "n": taken["n"], "length": taken["length"], "cell": pa.array(to.astype(np.int32)),
                    "distance": pa.array(distance[at, to]), "vector": taken["vector"],
                })


def near_pairs(left: np.ndarray, right: np.ndarray, threshold: float, triangle: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(left row, right row, cosine)`` of all pairs within ``SLACK`` of the threshold or above it, by strips.

    Rows are unit vectors in the common basis; with ``triangle`` only pairs with a greater right row count.
    """
    length = left.shape[1]
    stops = sorted({max(1, length * part // 8) for part in (1, 2, 3, 4, 6)} | {length})
    rest = [np.sqrt((side[:, stop:] ** 2).sum(axis=1)) for stop in stops for side in (left, right)]
    for top in range(0, len(left), STRIP):
        strip = left[top : top + STRIP]
        dots, at, begin = np.zeros((len(strip), len(right))), None, 0
        for k, stop in enumerate(stops):
            mine, theirs = rest[2 * k][top : top + STRIP], rest[2 * k + 1]
            if at is None:
                dots += strip[:, begin:stop] @ right[:, begin:stop].T
                open_ = dots + mine[:, None] * theirs >= threshold - SLACK
                if triangle:
                    open_ &= np.arange(top, top + len(strip))[:, None] < np.arange(len(right))
                if stop == length or open_.sum() < SPARSE * open_.size:
                    at = np.nonzero(open_)
                    dots = dots[at]
            else:
                dots = dots + _dots(strip[:, begin:stop], right[:, begin:stop], *at)
                open_ = dots + mine[at[0]] * theirs[at[1]] >= threshold - SLACK
                at, dots = (at[0][open_], at[1][open_]), dots[open_]
            begin = stop
            if at is not None and not len(dots):
                break
        if len(dots):
            yield at[0] + top, at[1], dots


def _dots(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for begin in range(0, len(i), 65_536):
        part = slice(begin, begin + 65_536)
        out[part] = np.einsum("ij,ij->i", left[i[part]], right[j[part]])
    return out


def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    """From exactly rounded sums; products of single-precision components are exact as well."""
    x, y = (np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])) for v in (x, y))
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def tile_links(
    given: tuple[np.ndarray, np.ndarray], basis: np.ndarray | None, ids: tuple[np.ndarray, np.ndarray],
    counts: tuple[np.ndarray, np.ndarray], threshold: float, triangle: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(id, linked rows, least id it is connected with)`` of the vectors linked between two sides.

    ``triangle``: both sides are the same rows.
    """
    units = [unit_rows(v) if basis is None else unit_rows(v) @ basis for v in given]
    shift = 0 if triangle else len(ids[0])
    names = ids[0] if triangle else np.concatenate(ids)
    links, label = np.zeros(len(names), np.int64), np.arange(len(names))
    for i, j, cosine in near_pairs(*units, threshold, triangle):
        sure = cosine >= threshold + SLACK
        for at in np.flatnonzero(~sure):
            sure[at] = exact_cosine(given[0][i[at]], given[1][j[at]]) >= threshold
        i, j = i[sure], j[sure]
        np.add.at(links, i, counts[1][j])
        np.add.at(links, j + shift, counts[0][i])
        label = _merged(label, i, j + shift)
    least = np.full(len(names), np.iinfo(np.int64).max)
    np.minimum.at(least, label, names)
    linked = links > 0
    return names[linked], links[linked], least[label[linked]]


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of ``a[k]`` and ``b[k]`` for all k."""
    while True:
        x, y = label[a], label[b]
        differs = x != y
        if not differs.any():
            return label
        a, b, x, y = a[differs], b[differs], x[differs], y[differs]
        up = np.arange(len(label))
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up, up[up]):
            up = up[up]
        label = up[label]


LINK_SCHEMA = "rep long, links long, partner long"


def _tile_rows(model: Model, threshold: float):
    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["length", "cell", "a", "b"]):
            block, first, second = (group[c].to_numpy() for c in ("block", "a", "b"))
            at = np.flatnonzero(block == first), np.flatnonzero(block == second)
            if not len(at[0]) or not len(at[1]):
                continue
            vectors, ids, counts = _matrix(group["vector"]), group["rep"].to_numpy(), group["n"].to_numpy()
            basis = model.basis if vectors.shape[1] == model.length else None
            sides = [tuple(v[rows] for rows in at) for v in (vectors, ids, counts)]
            found = tile_links(sides[0], basis, sides[1], sides[2], threshold, bool(first[0] == second[0]))
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["rep", "links", "partner"])

    return rows


def usable_vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, vector)``, one row for each id that can have links; single precision stays so."""
    rows = pick(embeddings, vec_id=id_col, vector=vector_col).filter("vec_id is not null and vector is not null")
    kind = "array<float>" if rows.schema["vector"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast(kind).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists("vector", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.max("vector").alias("vector"))


def _sample(reps: DataFrame, length: int) -> np.ndarray:
    most = max(1, min(FIT_ROWS, FIT_VALUES // length))
    own = reps.filter(F.size("vector") == length).orderBy(F.xxhash64("rep"), "rep").limit(most)
    return unit_rows(_matrix(own.select("vector").toArrow()["vector"]))


def _blocks(rows: Column) -> Column:
    return F.ceil(rows / F.least(F.lit(TILE_ROWS), F.greatest(F.lit(64), F.lit(TILE_VALUES) / F.col("length")))).cast("int")


def _tiled(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each row once for every tile pair ``(a, b)`` it takes part in, with its own block in ``block``.

    Blocks are numbered through the kinds core, outer, near visitor, visitor. Outer rows meet all, core
    rows meet outer rows and visitors; core with core and core with near visitors need no comparison.
    """
    ends = [F.lit(0)]
    for kind in range(4):
        ends.append(ends[-1] + F.col(f"blocks_{kind}"))

    def numbers(kind: int) -> Column:
        every = F.sequence(ends[kind], ends[kind + 1] - 1)
        return F.when(ends[kind + 1] > ends[kind], every).otherwise(F.array().cast("array<int>"))

    meets = {OUTER: range(4), CORE: (OUTER, VISITOR), NEAR_VISITOR: (OUTER,), VISITOR: (CORE, OUTER)}
    joined = rows.join(sizes, ["length", "cell"])
    chosen = lambda by_kind: F.coalesce(*[F.when(F.col("kind") == kind, value) for kind, value in by_kind.items()])
    begin, count = chosen(dict(enumerate(ends[:4]))), chosen({k: F.col(f"blocks_{k}") for k in range(4)})
    other = chosen({kind: F.concat(*[numbers(k) for k in kinds]) for kind, kinds in meets.items()})
    placed = joined.withColumn("block", (begin + F.pmod(F.xxhash64("rep"), count)).cast("int"))
    met = placed.withColumn("other", F.explode(other))
    return met.select(
        "length", "cell", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
        "block", "rep", "n", "vector",
    )


def _partial_links(reps: DataFrame, threshold: float) -> DataFrame:
    """``(rep, links, partner)``: numbers of linked rows to be added up, and edges that connect as much."""
    spark = reps.sparkSession
    lengths = reps.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    if not usual:
        return spark.createDataFrame([], LINK_SCHEMA)
    length, farthest = usual[0]["length"], _farthest(threshold)
    cells = min(MOST_CELLS, -(-usual[0]["n"] // min(TILE_ROWS, max(64, TILE_VALUES // length))))
    model = fit_model(_sample(reps, length), cells)
    schema = f"{HOME_SCHEMA}, vector {reps.schema['vector'].dataType.simpleString()}"
    homes = stage(reps.mapInArrow(partial(_home_rows, model), schema))
    near = F.col("distance") <= farthest / 2 * (1 - SLACK)
    homes = homes.withColumn("kind", F.when(near, CORE).otherwise(OUTER))

    radii = np.full(len(model.centers), -np.inf)
    reach = homes.filter(F.col("length") == length).groupBy("cell").agg(F.max("distance").alias("radius"))
    for row in reach.collect():  # at most MOST_CELLS
        radii[row["cell"]] = row["radius"]
    visits = homes.drop("kind").mapInArrow(partial(_visits, model, radii, farthest), schema)
    visits = visits.withColumn("kind", F.when(near, NEAR_VISITOR).otherwise(VISITOR))
    rows = stage(homes.unionByName(visits))

    def of_kind(kind: int, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, value)), F.lit(0))

    blocks = [_blocks(of_kind(k, F.lit(1))).alias(f"blocks_{k}") for k in range(4)]
    sizes = stage(rows.groupBy("length", "cell").agg(
        *blocks, of_kind(CORE, F.col("n")).alias("core"), of_kind(NEAR_VISITOR, F.col("n")).alias("visitors"),
        F.min(F.when(F.col("kind") == CORE, F.col("rep"))).alias("head"),
    ))
    numbers = [f"blocks_{k}" for k in range(4)]
    tiles = ["length", "cell", "a", "b"]
    met = _tiled(rows, sizes.select("length", "cell", *numbers)).repartition(*tiles).sortWithinPartitions(*tiles)
    compared = met.mapInArrow(_tile_rows(model, threshold), LINK_SCHEMA)

    counted = rows.filter(F.col("kind").isin(CORE, NEAR_VISITOR)).select("length", "cell", "kind", "rep", "n")
    counted = counted.join(sizes.filter("core > 0").select("length", "cell", "core", "visitors", "head"), ["length", "cell"])
    links = F.when(F.col("kind") == CORE, F.col("core") - F.col("n") + F.col("visitors")).otherwise(F.col("core"))
    return compared.unionByName(counted.select("rep", links.alias("links"), F.col("head").alias("partner")))


def embedding_classes(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row for each distinct non-null id.

    ``n_links`` counts the other vectors with a cosine of ``threshold`` or more; ``component_id`` is the
    least id reachable over such links, and the vector with that id is the one kept.
    """
    if not 0 < threshold < 1:
        raise ValueError("the threshold must lie between 0 and 1")
    usable = stage(usable_vectors(embeddings, id_col, vector_col))
    keyed = usable.select("vec_id", F.xxhash64("vector").alias("d1"), F.xxhash64(F.lit(12), "vector").alias("d2"))
    # Written, so that the join has a shuffle of its own on this side and a hot vector can be split.
    least = stage(keyed.groupBy("d1", "d2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    members = stage(keyed.join(least, ["d1", "d2"]).select("vec_id", "rep", "n"))
    own = members.filter("vec_id = rep").select("vec_id", "rep", "n")
    reps = stage(usable.join(own, "vec_id").select("rep", "n", "vector"))

    partial_links = stage(_partial_links(reps, threshold))
    links = partial_links.groupBy("rep").agg(F.sum("links").alias("links"))
    label = components(partial_links.select(F.col("rep").alias("a"), F.col("partner").alias("b")))
    known = links.join(label, links["rep"] == label["node"], "left").select("rep", "links", "label")
    found = members.join(known, "rep", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("label", "rep").alias("component_id")
    )
    ids = pick(embeddings, vec_id=id_col).select(F.col("vec_id").cast("long").alias("vec_id")).filter("vec_id is not null").distinct()
    component = F.coalesce("component_id", "vec_id")
    return ids.join(found, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
