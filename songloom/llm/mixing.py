"""Mixing sources to target weights by entropy balancing.

The rates closest to 1 in relative entropy, at most ``CAP``, for which every source gives its target of
tokens are ``min(CAP, exp(lambda * size / mean size))`` with one multiplier for each source. The
multipliers solve the convex dual by Newton iterations: Spark sums gradient and curvature over all
documents, pre-aggregated by source and size, and the driver moves one number for each source. A
bracket around each root catches steps that the cap makes too long.

Rates become whole copies. All documents of one source and size have the same rate, so their copies
are rounded together; what a size gives too little or too much is carried to the next smaller size of
the source. A source then misses its target by about the size of one of its smallest documents, but
for targets that its caps exclude.

Sources are metadata: their names, totals and multipliers are held by the driver, at most
``MAX_SOURCES`` of them. Null is a source of its own, the last one. Null and empty texts have size 0
and are never taken. Ties and repeated rows: documents of one source and size are ordered by a hash of
their id and whole row to decide which get a copy more. Only rows that are equal in all columns are one
document, whatever ids are null or repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songloom.llm.common import CELL_ROWS, free_names, hashable, numbered, pick, same
from songloom.plans.staging import stage

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
MAX_SOURCES = 1_000_000
TOLERANCE, MOST_STEPS = 1e-9, 100
UNITS = 1e12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


@dataclass
class Sources:
    """One entry for each source: name, tokens, documents' mean size, target and multiplier."""

    names: list[str | None]
    tokens: np.ndarray
    mean: np.ndarray
    target: np.ndarray
    multiplier: np.ndarray


def capped_targets(tokens: np.ndarray, weights: np.ndarray, cap: float = CAP) -> np.ndarray:
    """Shares of the total by weight; what exceeds ``cap`` times a source goes to the others by weight."""
    most, full = cap * tokens, tokens <= 0
    target = np.where(full, 0.0, 0.0)
    while not full.all():
        share = (tokens.sum() - most[full].sum()) / weights[~full].sum()
        target = np.where(full, most, share * weights)
        above = ~full & (target > most)
        if not above.any():
            return target
        full |= above
    return np.where(tokens > 0, most, 0.0)


def _by_code_point(name: str | None) -> tuple:
    return (name is None, name or "")


def solve_multipliers(histogram: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> Sources:
    """The dual's solution over ``(source, size, n)``."""
    spark = histogram.sparkSession
    n_tokens, n_docs = F.sum(F.col("size") * F.col("n")).alias("tokens"), F.sum("n").alias("docs")
    rows = histogram.groupBy("source").agg(n_tokens, n_docs).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: _by_code_point(r["source"]))
    tokens = np.array([float(r["tokens"]) for r in rows])
    weight = np.array([weights[k % len(weights)] for k in range(len(rows))])
    target = capped_targets(tokens, weight, cap)
    mean = np.array([r["tokens"] / r["docs"] for r in rows])
    found = Sources([r["source"] for r in rows], tokens, mean, target, np.zeros(len(rows)))
    reachable = (tokens > 0) & (target < cap * tokens)
    found.multiplier[(tokens > 0) & ~reachable] = np.inf
    found.multiplier[reachable] = np.log(target[reachable] / tokens[reachable])
    low, high = np.full(len(rows), -np.inf), np.full(len(rows), np.inf)
    for _ in range(MOST_STEPS):
        if not reachable.any():
            break
        sums = _dual_sums(histogram, found, spark, cap)
        given = np.array([sums[n][0] for n in found.names])
        slope = np.array([sums[n][1] for n in found.names])
        open_ = reachable & (np.abs(given - target) > TOLERANCE * target)
        if not open_.any():
            break
        at = found.multiplier
        low, high = np.where(given < target, at, low), np.where(given > target, at, high)
        with np.errstate(divide="ignore", invalid="ignore"):
            step = at - (given - target) / slope
            middle = np.where(np.isinf(low), at - 2, np.where(np.isinf(high), at + 2, (low + high) / 2))
        inside = np.isfinite(step) & (step > low) & (step < high)
        found.multiplier = np.where(open_, np.where(inside, step, middle), at)
    return found


def _with_rates(histogram: DataFrame, found: Sources, cap: float) -> DataFrame:
    rows = [
        (n, float(m), float(l), float(t), float(s))
        for n, m, l, t, s in zip(found.names, found.mean, found.multiplier, found.target, found.tokens)
    ]
    schema = "source string, mean double, multiplier double, target double, tokens double"
    known = histogram.sparkSession.createDataFrame(rows, schema)
    joined = histogram.alias("h").join(known.alias("k"), same("h", "k", ["source"]))
    exponent = F.col("multiplier") * F.col("size") / F.col("mean")
    rate = F.when(exponent >= float(np.log(cap)), F.lit(float(cap))).otherwise(F.exp(exponent))
    return joined.select("h.*", "mean", "target", "tokens", rate.alias("rate"))


def _dual_sums(histogram: DataFrame, found: Sources, spark, cap: float) -> dict:
    """Tokens given and their derivative for each source, summed as whole numbers of ``1 / UNITS``.

    Whole numbers add up alike in any order, so that reruns agree to the last digit.
    """
    rated = _with_rates(histogram.filter("size > 0"), found, cap)
    tokens = (F.col("n") * F.col("size")).cast("decimal(15,0)")
    tilt = F.when(F.col("rate") < cap, F.col("rate") * F.col("size") / F.col("mean")).otherwise(0.0)
    sums = rated.groupBy("source").agg(
        *[F.sum(tokens * F.round(c * F.lit(UNITS)).cast("decimal(23,0)")).alias(a) for c, a in ((F.col("rate"), "given"), (tilt, "slope"))]
    )
    rows = {r["source"]: (float(r["given"]) / UNITS, float(r["slope"]) / UNITS) for r in sums.collect()}
    return {n: (0.0, 0.0) for n in found.names} | rows


def _rounded(cap: float):
    def copies(sizes: pd.DataFrame) -> pd.DataFrame:
        """Copies for each size of one source, largest first, with the error carried on."""
        sizes = sizes.sort_values("size", ascending=False)
        owed, chosen = 0.0, []
        for size, n, rate in zip(sizes["size"], sizes["n"], sizes["rate"]):
            owed += n * rate * size
            whole = int(min(max(np.floor(owed / size + 0.5), 0), cap * n))
            owed -= whole * size
            chosen.append(whole)
        return sizes.assign(copies=np.array(chosen, np.int64))[["source", "size", "n", "rate", "copies"]]

    return copies


def _marked(documents: DataFrame, d1: str = "_d1", d2: str = "_d2") -> DataFrame:
    """With 128 bits in two columns that tell rows apart; hashes skip nulls, so where these are goes in as well."""
    own = [F.col(f"`{c}`") for c in documents.columns]
    whole = [*hashable(documents), *[c.isNull() for c in own]]
    return documents.select(*own, *[F.xxhash64(F.lit(salt), *whole).alias(name) for salt, name in (("_d1", d1), ("_d2", d2))])


def mixing_plan(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, cap: int = CAP,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, rate, copies, taken)`` for every row."""
    given = pick(documents, doc_id=id_col, text=text_col, source=source_col)
    return _marked_plan(_marked(given), weights, cap).drop("_d1", "_d2")


def _marked_plan(given: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``mixing_plan`` of rows ``(doc_id, text, source, _d1, _d2)``, with the digest of each row."""
    source = F.col("source").cast("string").alias("source")
    rows = stage(given.select("doc_id", source, word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("_text"), "_d1", "_d2"))
    histogram = stage(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    found = solve_multipliers(histogram, weights, cap)
    rated = _with_rates(histogram.filter("size > 0"), found, cap)
    schema = "source string, size long, n long, rate double, copies long"
    chosen = stage(rated.select("source", "size", "n", "rate").groupBy("source").applyInPandas(_rounded(cap), schema))
    nothing = histogram.filter("size = 0").select("source", "size", "n", F.lit(1.0).alias("rate"), F.lit(0).alias("copies"))
    decided = chosen.union(nothing)

    joined = rows.alias("l").join(decided.alias("r"), same("l", "r", ["source", "size"]))
    joined = joined.select("l.*", "n", "rate", "copies")
    taking = joined.filter("copies > 0")
    drawn = taking.withColumn("_mixed", F.xxhash64(F.lit("mixing"), "doc_id", "_text"))
    # By id and text, so that columns that play no part change no draw; rows alike in both are told apart by the rest.
    ranked = numbered(drawn, ["source", "size"], ["_mixed", "doc_id", "_text"], "n", "_rank", ties=("_d1", "_d2"))
    more = (F.col("_rank") < F.col("copies") % F.col("n")).cast("long")
    several = ranked.select(
        "doc_id", "source", "size", "_d1", "_d2", "rate", (F.floor(F.col("copies") / F.col("n")) + more).alias("copies")
    )
    none = joined.filter("copies = 0").select("doc_id", "source", "size", "_d1", "_d2", "rate", F.lit(0).cast("long").alias("copies"))
    known = [(n, int(s), float(t)) for n, s, t in zip(found.names, found.tokens, found.target)]
    totals = given.sparkSession.createDataFrame(known, "source string, source_size long, target double")
    both = several.union(none).alias("l").join(totals.alias("r"), same("l", "r", ["source"]))
    return both.select(
        "l.doc_id", "l.source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        "_d1", "_d2",
    )


def mixed_documents(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    d1, d2, each, more, part, copy = free_names(documents, "_d1", "_d2", "_each", "_more", "_part", "_copy")
    marked = _marked(documents, d1, d2)
    plan = _marked_plan(pick(marked, doc_id=id_col, text=text_col, source=source_col, _d1=d1, _d2=d2), **options)
    rows, copies = F.count(F.lit(1)), F.sum("copies")
    keys = plan.groupBy(F.col("_d1").alias(d1), F.col("_d2").alias(d2)).agg(
        F.floor(copies / rows).cast("int").alias(each), (copies % rows).alias(more)
    )
    keys = stage(keys.filter((F.col(each) > 0) | (F.col(more) > 0)))
    own = [F.col(f"`{c}`") for c in documents.columns]
    # Nearly always a row stands alone and all its copies are in that number.
    all_alike = marked.join(keys.filter(F.col(each) > 0).select(d1, d2, each), [d1, d2])
    mixed = all_alike.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(each)))).select(*own)
    some = keys.filter(F.col(more) > 0).select(d1, d2, more)
    if some.isEmpty():
        return mixed
    # Of equal rows some get one copy more: one of the rows gives them, dealt over several tasks.
    one = marked.join(some, [d1, d2]).dropDuplicates([d1, d2])
    parts = one.withColumn(part, F.explode(F.sequence(F.lit(0), F.floor((F.col(more) - 1) / CELL_ROWS))))
    number = F.least(F.lit(CELL_ROWS), F.col(more) - F.col(part) * CELL_ROWS)
    dealt = parts.repartition(d1, d2, part)
    return mixed.unionAll(dealt.withColumn(copy, F.explode(F.sequence(F.lit(1), number.cast("int")))).select(*own))
