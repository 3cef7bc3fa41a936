"""Near-duplicate classes of texts: a multi-index Hamming join over b-bit MinHash signatures.

1. Every text becomes its set of word shingles, the set an exact digest and a signature of
   ``CHUNKS * CHUNK`` MinHash values of 8 bits. Equal sets collapse to one representative.
2. The signature is split into 19 chunks of 5 values. Two signatures that differ in at most 37
   values have, by pigeonhole, a chunk with at most one difference; so each chunk is indexed under
   the five keys that leave one of its values out. Such pairs share a key for certain.
3. Documents that share a key and differ in at most ``MAX_DISTANCE`` values are candidates. Within
   a key all are compared with its least member first; keys whose members are not yet in one
   candidate cluster are compared in blocks, and only joins of clusters are emitted.
4. Each candidate cluster is confirmed on full shingle sets, block against block. A comparison is
   left out only if its two documents are already linked by others, which no class can lose.

The distance threshold is the one that the pigeonhole reaches, so every pair of signatures within it is
found. At similarity 0.8 a pair differs in 19 of 95 values on average; it differs in more than 37, and is
then not linked by itself, in about 1 of 100,000 cases (95 draws that differ with probability 0.2).

``exact=True`` finds those links too. Two sets that similar share one of the first shingles of each, rare
ones first, so many that the rest alone can't reach the threshold. Documents of different classes that share
such a shingle, and whose sizes and bitmaps leave room for a link, join their classes to clusters, which are
confirmed as above without a look at signatures.

Null texts count as empty. Empty texts and texts without words are linked with nothing. Rows that
repeat a document id count as one document, of which the row with the largest set stands for it,
here as in the documents kept; rows without an id are left out. Ids are whole numbers. Any number of copies and any length are handled alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songloom.llm.common import components, free_names, hashable, lean, pick, sorted_groups
from songloom.llm.words import mix, shingle_sets, word_chunks
from songloom.plans.staging import stage

CHUNKS, CHUNK, ERRORS = 19, 5, 1
VALUES = CHUNKS * CHUNK
GUARANTEED = CHUNKS * (ERRORS + 1) - 1  # any pair this near shares a key
MAX_DISTANCE = GUARANTEED
PERCENT = 80  # least Jaccard similarity of a link
BLOCK_ROWS, BLOCK_SHINGLES, KEY_BLOCK = 256, 300_000, 4096
BITMAP = 4096  # bits of a set's bitmap in the exact mode

_random = np.random.default_rng(8)
_FACTORS = (_random.integers(0, 1 << 31, VALUES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_MASKS = _random.integers(0, 1 << 32, VALUES, dtype=np.uint32)
_KEPT = list(combinations(range(CHUNK), CHUNK - ERRORS))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 8-bit MinHash values of a non-empty set of 64-bit hashes."""
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(least, ((x[i : i + 2048] ^ _MASKS[:, None]) * _FACTORS[:, None]).min(axis=1), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def signature_keys(signatures: np.ndarray) -> np.ndarray:
    """All index keys of each signature: chunk, values left out, and the values kept."""
    parts = signatures.reshape(-1, CHUNKS, CHUNK).astype(np.int64)
    keys = []
    for way, kept in enumerate(_KEPT):
        key = np.arange(CHUNKS, dtype=np.int64) * len(_KEPT) + way
        for position in kept:
            key = (key << 8) | parts[:, :, position]
        keys.append(key)
    return np.concatenate(keys, axis=1)


def _set_rows(width: int):
    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in word_chunks(batch["text"]):
                sets = shingle_sets(words, width)
                yield pa.RecordBatch.from_pydict({
                    "doc": batch["doc"].slice(row, len(sets)),
                    "digest": batch["digest"].slice(row, len(sets)),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "d1": pa.array(np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                    "d2": pa.array(np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                    "sig": pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                })

    return rows


def _full_sets(width: int):
    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # repeated ids whose text came by: its other rows are equal and add nothing
        for batch in batches:
            fresh = []
            for doc, copies in zip(batch["doc"].to_pylist(), batch["copies"].to_pylist()):
                fresh.append(copies == 1 or doc not in seen)
                if copies > 1:
                    seen.add(doc)
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            for row, words in word_chunks(batch["text"]):
                sets = shingle_sets(words, width)
                kept = {c: batch[c].slice(row, len(sets)) for c in ("doc", "label", "cluster", "blocks", "block", "sig")}
                yield pa.RecordBatch.from_pydict(kept | {"shingles": pa.array([s.tobytes() for s in sets], pa.binary())})

    return rows


def _bytes(column) -> np.ndarray:
    """Equally long binary values as rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


@lean
def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = signature_keys(_bytes(batch["sig"]))
            lists = pa.ListArray.from_arrays(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1], keys.ravel())
            yield pa.RecordBatch.from_pydict({"doc": batch["doc"], "keys": lists})


def _near_pairs(distance: int):
    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = (_bytes(batch["sig_a"]) != _bytes(batch["sig_b"])).sum(axis=1) <= distance
                yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(near))

    return rows


class _Sets:
    """Union-find over the documents of one block pair."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j

    def roots(self) -> np.ndarray:
        while not np.array_equal(self.up, self.up[self.up]):
            self.up = self.up[self.up]
        return self.up


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the two blocks that meet; a block that meets itself is both."""
    first, second, block = (group[c].to_numpy() for c in ("i", "j", "block"))
    return np.flatnonzero(block == first), np.flatnonzero(block == second)


def _label_joins(near: Callable[[pa.Table], Callable[[int, np.ndarray], np.ndarray]]):
    """Of each block pair under one key: edges that join labels with a pair near enough.

    ``near`` makes of a group a function that tells which rows are near a given one.
    """

    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["key", "i", "j"]):
            names, at = np.unique(group["label"].to_numpy(), return_inverse=True)
            if len(names) < 2:
                continue
            near_to = near(group)
            joined, (left, right), found = _Sets(len(names)), _sides(group), []
            for i in left:
                open_ = right[joined.roots()[at[right]] != joined.find(at[i])]
                near_ones = open_[near_to(i, open_)]
                found += [(names[at[i]], names[at[j]]) for j in near_ones if joined.join(at[i], at[j])]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return rows


def _by_signature(distance: int):
    def near(group: pa.Table):
        signatures = _bytes(group["sig"])
        return lambda i, others: (signatures[others] != signatures[i]).sum(axis=1) <= distance

    return near


def _by_bitmap(group: pa.Table):
    """A link can't be ruled out: each bit that one set has alone is a shingle that the other lacks."""
    sizes, bits = group["n"].to_numpy(), _bytes(group["bits"]).copy().view(np.uint64)

    def near_to(i: int, others: np.ndarray) -> np.ndarray:
        alone = np.bitwise_count(bits[i] & ~bits[others]).sum(axis=1)
        lacking = np.bitwise_count(~bits[i] & bits[others]).sum(axis=1)
        shared = np.minimum(sizes[i] - alone.astype(np.int64), sizes[others] - lacking.astype(np.int64))
        return 100 * shared >= PERCENT * (sizes[i] + sizes[others] - shared)

    return near_to


def _confirmed(distance: int):
    """Of each block pair of one cluster: links that hold on full sets, as few as connect different labels."""

    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["cluster", "i", "j"]):
            doc, signatures = group["doc"].to_numpy(), _bytes(group["sig"])
            sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
            sizes = np.array([len(s) for s in sets])
            joined, (left, right), found = _Sets(len(doc)), _sides(group), []
            _, first, at = np.unique(group["label"].to_numpy(), return_index=True, return_inverse=True)
            joined.up = first[at]
            values = np.concatenate([sets[j] for j in right]) if len(right) else np.zeros(0, np.uint64)
            owner = np.repeat(right, sizes[right])
            for i in left:
                open_ = right[joined.roots()[right] != joined.find(i)]
                open_ = open_[(signatures[open_] != signatures[i]).sum(axis=1) <= distance]
                if not len(open_):
                    continue
                if 4 * len(open_) > len(right):
                    place = np.searchsorted(sets[i], values)
                    place[place == sizes[i]] = 0
                    shared = np.bincount(owner[sets[i][place] == values], minlength=len(doc))[open_]
                else:
                    shared = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in open_])
                union = sizes[i] + sizes[open_] - shared
                found += [(doc[i], doc[j]) for j in open_[100 * shared >= PERCENT * union] if joined.join(i, j)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return rows


def _block_pairs(rows: DataFrame) -> DataFrame:
    """Each row once for every pair of blocks ``i <= j`` that its own block takes part in."""
    other = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    ends = other.select("*", F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"))
    return ends.drop("_other", "blocks")


def near_duplicate_classes(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, exact: bool = False,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row for each distinct non-null id.

    ``component_id`` is the least id reachable over links of similarity 0.8 or more between sets of
    ``width``-word shingles; the document with that id is the one kept. ``distance``, at most ``GUARANTEED``, is
    the number of values in which signatures of a link may differ; with ``exact`` no link depends on it.
    """
    if distance > GUARANTEED:
        raise ValueError(f"pairs that differ in more than {GUARANTEED} values need not share a key")
    return _classes(documents, id_col, text_col, width, exact, distance).drop("digest")


def _classes(
    documents: DataFrame, id_col: str, text_col: str, width: int, exact: bool = False, distance: int = MAX_DISTANCE
) -> DataFrame:
    """The classes with a digest of the text that stands for each id."""
    given = pick(documents, doc=id_col, text=text_col).filter("doc is not null")
    given = given.select(F.col("doc").cast("long").alias("doc"), "text", F.xxhash64("text").alias("digest"))
    raw = stage(given.mapInArrow(_set_rows(width), "doc long, digest long, n long, d1 long, d2 long, sig binary"))
    largest = F.max(F.struct("n", "d1", "d2", "sig", "digest")).alias("s")
    chosen = stage(raw.groupBy("doc").agg(largest, F.count(F.lit(1)).alias("copies")).select("doc", "s.*", "copies"))
    # Written, so that the join below has a shuffle of its own on this side and a hot set can be split.
    least = stage(chosen.filter("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc").alias("rep")))
    known = stage(chosen.join(least, ["n", "d1", "d2"], "left"))
    members = known.select("doc", "n", "digest", F.coalesce("rep", "doc").alias("rep"))
    reps = known.filter("doc = rep").select("doc", "n", "d1", "d2", "sig", "digest", "copies")

    clusters = _candidate_clusters(reps, distance)
    label = components(_links(given, reps.withColumn("label", F.col("doc")), clusters, width, distance))
    if exact:
        label = _with_all_links(given, reps, label, width)
    final = members.join(label, members["rep"] == label["node"], "left")
    component = F.coalesce("label", "rep")
    return final.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        (F.col("doc") == component).alias("kept"), "digest",
    )


def _links(given: DataFrame, reps: DataFrame, clusters: DataFrame, width: int, distance: int) -> DataFrame:
    """Confirmed links that connect all representatives of a cluster that any links connect, given their labels."""
    size = F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("n") / BLOCK_SHINGLES)
    placed = reps.join(clusters, "doc")
    blocks = placed.groupBy("cluster").agg(F.ceil(size).cast("int").alias("blocks"))
    wanted = placed.join(blocks, "cluster").withColumn("block", F.pmod(F.hash("doc"), F.col("blocks")))
    texts = given.join(wanted, ["doc", "digest"])
    texts = texts.select("doc", "text", "copies", "label", "cluster", "blocks", "block", "sig")
    schema = "doc long, label long, cluster long, blocks int, block int, sig binary, shingles binary"
    met = _block_pairs(texts.mapInArrow(_full_sets(width), schema))
    dealt = met.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return dealt.mapInArrow(_confirmed(distance), "a long, b long")


def _set_lists(width: int):
    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words in word_chunks(batch["text"]):
                sets, bits = shingle_sets(words, width), []
                for s in sets:
                    held = np.zeros(BITMAP, np.uint8)
                    held[s >> np.uint64(52)] = 1
                    bits.append(np.packbits(held).tobytes())
                yield pa.RecordBatch.from_pydict({
                    "doc": batch["doc"].slice(row, len(sets)), "bits": pa.array(bits, pa.binary()),
                    "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                })

    return rows


def _with_all_links(given: DataFrame, reps: DataFrame, label: DataFrame, width: int) -> DataFrame:
    """``label`` with the links whose signatures lie too far apart: prefix filtering between different classes."""
    own = reps.join(label, reps["doc"] == label["node"], "left")
    own = stage(own.select(*reps.columns, F.coalesce("label", "doc").alias("label")))
    texts = given.join(own.select("doc", "digest"), ["doc", "digest"]).select("doc", "text")
    sets = stage(texts.mapInArrow(_set_lists(width), "doc long, bits binary, shingles array<long>"))
    sets = sets.groupBy("doc").agg(F.first("bits").alias("bits"), F.first("shingles").alias("shingles"))  # equal rows
    placed = sets.join(own.select("doc", "n", "label"), "doc")
    each = placed.select("doc", "n", "label", F.explode("shingles").alias("key"))
    counts = each.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    rare_first = Window.partitionBy("doc").orderBy("rows", "key")  # the shingles of one text
    ranked = each.join(counts, "key").withColumn("rank", F.row_number().over(rare_first))
    prefix = stage(ranked.filter(f"rank <= n - (n * {PERCENT} + 99) div 100 + 1 and rows > 1").select("key", "doc", "n", "label"))
    open_keys = prefix.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.min("label").alias("least"), F.max("label").alias("most")
    ).filter("least < most")
    sizes = open_keys.select("key", F.ceil(F.col("rows") / KEY_BLOCK).cast("int").alias("blocks"))
    rest = prefix.join(sizes, "key").join(sets.select("doc", "bits"), "doc")
    rest = _block_pairs(rest.withColumn("block", F.pmod(F.hash("doc"), F.col("blocks"))))
    dealt = rest.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    joined = components(dealt.mapInArrow(_label_joins(_by_bitmap), "a long, b long"))
    clusters = own.join(joined, own["label"] == joined["node"]).select("doc", joined["label"].alias("cluster"))
    links = stage(_links(given, own, clusters, width, VALUES))
    inside = own.filter("doc <> label").select(F.col("label").alias("a"), F.col("doc").alias("b"))
    return components(inside.union(links))


def _candidate_clusters(reps: DataFrame, distance: int) -> DataFrame:
    """``(doc, cluster)`` of documents with a near signature: the classes of that relation."""
    keys = reps.select("doc", "sig").mapInArrow(_key_rows, "doc long, keys array<long>")
    keys = keys.select("doc", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("doc").alias("leader"), F.max("doc").alias("last"))
    shared = shared.filter("leader < last").select("key", "leader")
    indexed = stage(keys.join(shared, "key"))
    star = indexed.filter("doc <> leader").select(F.col("leader").alias("a"), F.col("doc").alias("b")).distinct()
    a = reps.select(F.col("doc").alias("a"), F.col("sig").alias("sig_a"))
    b = reps.select(F.col("doc").alias("b"), F.col("sig").alias("sig_b"))
    first = components(star.join(a, "a").join(b, "b").mapInArrow(_near_pairs(distance), "a long, b long"))

    labelled = indexed.join(first, indexed["doc"] == first["node"], "left")
    labelled = labelled.select("key", "doc", F.coalesce("label", "doc").alias("label"))
    # Two members were compared with each other above; only three or more leave a pair out.
    open_keys = labelled.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("label").alias("least"), F.max("label").alias("most")
    ).filter("n > 2 and least < most")
    sizes = open_keys.select("key", F.ceil(F.col("n") / KEY_BLOCK).cast("int").alias("blocks"))
    rest = labelled.join(sizes, "key").join(reps.select("doc", "sig"), "doc")
    rest = _block_pairs(rest.withColumn("block", F.pmod(F.hash("doc"), F.col("blocks"))))
    dealt = rest.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    second = components(dealt.mapInArrow(_label_joins(_by_signature(distance)), "a long, b long"))
    upper = second.select(F.col("node").alias("label"), F.col("label").alias("top"))
    ends = second.select(F.col("node").alias("doc"), F.col("node").alias("label"))
    known = first.select(F.col("node").alias("doc"), "label").union(
        ends.join(first, ends["doc"] == first["node"], "left_anti")
    )
    return known.join(upper, "label", "left").select("doc", F.coalesce("top", "label").alias("cluster"))


def keep_one_of_each(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, exact: bool = False
) -> DataFrame:
    """The documents without near duplicates: of each class the one with the least id.

    Rows without an id stay. Of rows that repeat an id one stays, with the text that stood for it.
    """
    name, text_digest, copy = free_names(documents, "_kept", "_digest", "_copy")
    classes = _classes(documents, id_col, text_col, width, exact).filter("kept")
    named = documents.filter(F.col(f"`{id_col}`").isNotNull())
    kept = classes.select(F.col("doc_id").alias(name), F.col("digest").alias(text_digest))
    own = Window.partitionBy(F.col(f"`{id_col}`")).orderBy(F.xxhash64(*hashable(documents)))
    at = (F.col(f"`{id_col}`").cast("long") == F.col(name)) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(text_digest))
    one = named.join(kept, at, "left_semi").withColumn(copy, F.row_number().over(own)).filter(F.col(copy) == 1).drop(copy)
    return one.unionByName(documents.filter(F.col(f"`{id_col}`").isNull()))
