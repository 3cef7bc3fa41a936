"""Language identification with bit-sliced Bloom filters over character n-grams.

Training counts byte 4-grams for each language. An n-gram belongs to a language if at least one in
``1 / SHARE`` of the language's n-grams is it, and it is not ``RATIO`` times rarer there than in the
language where it is most frequent; shares add up to 1, so a language has at most ``1 / SHARE`` of
them. One table holds the filters of 64 languages, each bit of its slots being one language's filter: the
``and`` of an n-gram's slots is the set of all those languages that hold it. Languages with many n-grams
share a table, and so do those with few, whose table is as much smaller.

A text is decided by its popcounts: for each language the share of n-grams with its bit, corrected
for the filter's own rate of false positives. The highest wins, ties going to the smaller name.

N-grams are taken from the text with ASCII letters lower-cased and everything in ASCII that is not a
letter turned into a space, without n-grams that hold two spaces in a row. Null texts and texts without
any letter are ``und`` with score 0, and so are all texts when nothing was learned; texts with letters
but no n-gram known get the language with most training text and score 0. The tables of the model take at
most 8 MB for 64 languages, and for stray labels no more than some bytes for each of their n-grams.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from songloom.llm.common import free_names, give_back_memory, lean, pick
from songloom.llm.words import Words, mix, word_chunks
from songloom.plans.staging import stage

GRAM = 4
SHARE, RATIO = 1e-5, 8.0
SLOTS, HASHES = 1 << 20, 3
GROUP = 64  # languages that share a table
SLOTS_PER_GRAM, LEAST_SLOTS = 10, 1 << 8  # of the tables after the first
HELD_GRAMS = 1 << 23  # n-grams of whole tables that the driver reads at once
PAIRED = 64  # languages, those with most training text, of which it is learned what they show of each other
HELD_ENTRIES = 1 << 21  # counts that one training task holds before it sends them on
UNKNOWN = "und"
LEAST_SHARE = 0.1  # of a text in the language it says, where nothing was learned of the pair
BY_ITSELF = 0.99  # of the texts in a language show no more of another one than counts as shown by itself
BINS = 1000  # of shares, when such quantiles are learned
_LETTER = regex.compile(r"\p{L}")
_FOLDED = np.full(256, 32, np.uint8)
_FOLDED[65:91] = np.arange(97, 123)
_FOLDED[97:123] = np.arange(97, 123)
_FOLDED[128:] = np.arange(128, 256)


def in_training(doc_id: Column) -> Column:
    """False for the quarter of ids that is held out; a null id is not held out."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(remainder != 2, F.lit(True))


def grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts as 32-bit numbers, and the text that each is from."""
    folded = _FOLDED[words.data]
    n = len(words.begin)
    # A space before each text and one after it (the newline), so that short words count too.
    begin = words.begin + np.arange(n)
    data = np.full(len(folded) + n, 32, np.uint8)
    inside = np.ones(len(data), bool)
    inside[begin] = False
    data[inside] = folded
    size = max(0, len(data) - GRAM + 1)
    value = np.zeros(size, np.uint32)
    for k in range(GRAM):
        value = (value << np.uint32(8)) | data[k : k + size]
    # The last space of a text and the first of the next stand side by side: none spans two texts.
    space = data == 32
    double = space[:-1] & space[1:]
    kept = np.ones(size, bool)
    for k in range(GRAM - 1):
        kept &= ~double[k : k + size]
    at = np.flatnonzero(kept)
    return value[at], np.searchsorted(begin, at, side="right") - 1


def _merged(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    value, which = np.unique(np.concatenate(values), return_inverse=True)
    return value, np.bincount(which, weights=np.concatenate(counts), minlength=len(value)).astype(np.int64)


@lean
def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[list, list]] = {}
    size = 0

    def sent() -> Iterator[pa.RecordBatch]:
        for lang, (values, counts) in held.items():
            value, count = _merged(values, counts)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(value), pa.string()), "gram": pa.array(value.astype(np.int64)), "n": pa.array(count),
            })
        held.clear()

    for batch in batches:
        for row, words in word_chunks(batch["text"]):
            langs = np.array(batch["lang"].slice(row, len(words.begin)).to_pylist(), object)
            value, owner = grams(words)
            of = langs[owner] if len(owner) else owner
            for lang in set(langs):
                values, counts = held.setdefault(lang, ([], []))
                found, count = np.unique(value[of == lang], return_counts=True)
                values.append(found), counts.append(count)
                size += len(found)
            if size > HELD_ENTRIES:
                held = {lang: tuple([x] for x in _merged(*entry)) for lang, entry in held.items()}
                size = sum(len(entry[0][0]) for entry in held.values())
                if size > HELD_ENTRIES // 2:
                    yield from sent()
                    size = 0
    yield from sent()


@dataclass
class Filters:
    """Bit b of ``table[slot]`` belongs to language number ``languages[b]``; numbers are ascending."""

    languages: np.ndarray
    table: np.ndarray
    false_positive: np.ndarray

    def positions(self, gram: np.ndarray) -> Iterator[np.ndarray]:
        h = mix(gram.astype(np.uint64) + np.uint64(1))
        for _ in range(HASHES):
            yield (h & np.uint64(len(self.table) - 1)).astype(np.int64)
            h = mix(h)

    def masks(self, gram: np.ndarray) -> np.ndarray:
        """The set of languages that hold each n-gram."""
        found = None
        for at in self.positions(gram):
            found = self.table[at] if found is None else found & self.table[at]
        return found

    def shares(self, gram: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """For each text and language the corrected share of the text's n-grams in the language."""
        number = np.bincount(owner, minlength=n)
        masks = self.masks(gram)
        hits = np.zeros((n, len(self.languages)))
        for bit in range(len(self.languages)):
            has = (masks >> np.uint64(bit)) & np.uint64(1)
            hits[:, bit] = np.bincount(owner[has.astype(bool)], minlength=n)
        rate = hits / np.maximum(number, 1)[:, None]
        return np.clip((rate - self.false_positive) / (1 - self.false_positive), 0, 1)


@dataclass
class LanguageModel:
    """Languages by name, the numbers of those with most training text, and the filters of all."""

    languages: list[str]
    most_trained: list[int]
    filters: list[Filters]

    def best(self, gram: np.ndarray, owner: np.ndarray, n: int, said: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each text the language with the highest share, that share, the share of language number
        ``said`` (NaN if negative), and the shares of the most trained languages."""
        best, score = np.zeros(n, np.int64), np.full(n, -1.0)
        claimed, shown = np.full(n, np.nan), np.zeros((n, len(self.most_trained)))
        for part in self.filters:
            shares = part.shares(gram, owner, n)
            high, at = shares.max(axis=1), part.languages[shares.argmax(axis=1)]
            better = (high > score) | ((high == score) & (at < best))
            best[better], score[better] = at[better], high[better]
            bit = np.minimum(np.searchsorted(part.languages, said), len(part.languages) - 1)
            here = np.flatnonzero(part.languages[bit] == said)
            claimed[here] = shares[here, bit[here]]
            _, paired, bits = np.intersect1d(self.most_trained, part.languages, return_indices=True)
            shown[:, paired] = shares[:, bits]
        return best, score, claimed, shown


def train(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """A model of every row that has a language; None if there is none."""
    rows = pick(documents, text=text_col, lang=lang_col).filter("lang is not null")
    counted = rows.mapInArrow(_count_rows, "lang string, gram long, n long")
    counts = stage(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(totals, "lang").withColumn("share", F.col("n") / F.col("total"))
    frequent = shares.filter(F.col("share") >= SHARE)
    most = frequent.groupBy("gram").agg(F.max("share").alias("most"))
    own = stage(frequent.join(most, "gram").filter(F.col("share") * RATIO >= F.col("most")).select("lang", "gram"))
    sizes = {r["lang"]: r["total"] for r in totals.collect()}  # one row for each language
    if not sizes:
        return None
    languages = sorted(sizes)
    held = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    most_trained = sorted(range(len(languages)), key=lambda l: (-sizes[languages[l]], l))[:PAIRED]
    model = LanguageModel(languages, most_trained, _empty_filters([held.get(lang, 0) for lang in languages]))
    _fill(model, own, held)
    for part in model.filters:
        for bit in range(len(part.languages)):
            filled = ((part.table >> np.uint64(bit)) & np.uint64(1)).mean()
            part.false_positive[bit] = min(filled**HASHES, 0.999)
    return model


def _empty_filters(held: list[int]) -> list[Filters]:
    """Tables for languages that hold so many n-grams, those with most of them first."""
    order, filters = np.argsort(-np.array(held), kind="stable"), []
    for begin in range(0, len(order), GROUP):
        own, slots = np.sort(order[begin : begin + GROUP]), SLOTS
        if begin:
            wanted = max(LEAST_SLOTS, SLOTS_PER_GRAM * held[order[begin]])
            slots = min(SLOTS, 1 << (wanted - 1).bit_length())
        filters.append(Filters(own, np.zeros(slots, np.uint64), np.zeros(len(own))))
    return filters


def _fill(model: LanguageModel, own: DataFrame, held: dict[str, int]) -> None:
    """Enter all n-grams; the driver reads those of a few tables at once, at most ``1 / SHARE`` for a language."""
    places, read, size = [], 0, 0
    for f, part in enumerate(model.filters):
        n = sum(held.get(model.languages[l], 0) for l in part.languages)
        if size and size + n > HELD_GRAMS:
            read, size = read + 1, 0
        size += n
        places += [(model.languages[l], read, f, bit) for bit, l in enumerate(part.languages)]
    placed = own.sparkSession.createDataFrame(places, "lang string, read int, filter int, bit int")
    numbers = stage(own.join(placed, "lang").select("read", "gram", "filter", "bit"))
    for r in range(read + 1):
        chosen = numbers.filter(F.col("read") == r).select("gram", "filter", "bit").toArrow()
        gram, which, bit = (chosen[c].to_numpy() for c in ("gram", "filter", "bit"))
        order = np.argsort(which, kind="stable")
        ends = np.searchsorted(which[order], np.arange(len(model.filters) + 1))
        for f, part in enumerate(model.filters):
            at = order[ends[f] : ends[f + 1]]
            for slot in part.positions(gram[at]):
                np.bitwise_or.at(part.table, slot, np.uint64(1) << bit[at].astype(np.uint64))


PREDICTED = "lang_pred string, score double"


def language_of(
    spark: SparkSession, model: LanguageModel | None, more: bool = False
) -> Callable[[Column, Column], Column]:
    """A column function of texts and labels: ``struct(lang_pred, score)``, from the text alone.

    With ``more`` it adds ``number``, that of the language found, ``claimed``, the share of the language that
    the label names, null if nothing was learned of it, and ``shown``, those of the most trained languages.
    """
    shared = spark.sparkContext.broadcast(model) if model else None  # 8 MB for 64 languages, less for stray ones
    numbers = {lang: l for l, lang in enumerate(model.languages)} if model and more else {}

    @F.arrow_udf(PREDICTED + (", number int, claimed double, shown array<double>" if more else ""))
    def predict(text: pa.Array, label: pa.Array) -> pa.Array:
        known = shared.value if shared is not None else None
        parts = []
        for row, words in word_chunks(text):
            n = len(words.begin)
            lettered = np.array([bool(t) and _LETTER.search(t) is not None for t in text.slice(row, n).to_pylist()], bool)
            name, score, at = np.full(n, UNKNOWN, object), np.zeros(n), np.full(n, -1)
            claimed, shown = np.full(n, np.nan), np.zeros((n, 0))
            if known is not None:
                said = np.array([numbers.get(x, -1) for x in label.slice(row, n).to_pylist()], np.int64)
                at, high, claimed, shown = known.best(*grams(words), n, said)
                score = np.where(lettered, high, 0.0)
                at = np.where(score > 0, at, known.most_trained[0])
                name[lettered] = np.array(known.languages, object)[at][lettered]
            columns = [pa.array(name, pa.string()), pa.array(score)]
            if more:
                columns += [pa.array(at, pa.int32()), pa.array(claimed, from_pandas=True)]
                columns.append(pa.array(shown.tolist(), pa.list_(pa.float64())))
            parts.append(pa.StructArray.from_arrays(columns, names))
        give_back_memory()
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    names = ["lang_pred", "score", "number", "claimed", "shown"][: 5 if more else 2]
    types = [pa.string(), pa.float64(), pa.int32(), pa.float64(), pa.list_(pa.float64())]
    kind = pa.struct(list(zip(names, types)))
    return predict


def identify_languages(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learned from rows with a language that are not held out."""
    known = documents.filter(in_training(F.col(f"`{id_col}`")))
    language = language_of(documents.sparkSession, train(known, text_col, lang_col))
    given = pick(documents, doc_id=id_col, text=text_col)
    predicted = language(F.col("text"), F.lit(None).cast("string")).alias("p")
    found = given.select("doc_id", (~in_training(F.col("doc_id"))).alias("held_out"), predicted)
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def shown_by_itself(
    known: DataFrame, model: LanguageModel, language: Callable[[Column, Column], Column], text_col: str, lang_col: str
) -> np.ndarray:
    """``least[p, l]``: a text found to be in language p that says l shows some of l from this share on.

    Both are places among the model's ``PAIRED`` most trained languages. Filters overlap, so texts in p show some
    of l by themselves. Of the rows that say p and are found to be in p, ``BY_ITSELF`` show less of l than this.
    For languages too close to tell apart it is half of what is usual for texts in l, and without such rows of p
    or l it is ``LEAST_SHARE``.
    """
    rows = pick(known, text=text_col, lang=lang_col).filter("lang is not null")
    found = rows.select("lang", language(F.col("text"), F.col("lang")).alias("p")).filter("p.lang_pred = lang and p.score > 0")
    found = found.filter(F.col("p.number").isin(model.most_trained))
    each = found.select("p.number", F.posexplode("p.shown").alias("l", "share"))
    bins = each.groupBy("number", "l", F.floor(F.col("share") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    pair = Window.partitionBy("number", "l")  # at most BINS + 1 rows
    upto = F.sum("n").over(pair.orderBy("bin")) / F.sum("n").over(pair)
    quantiles = bins.withColumn("upto", upto).groupBy("number", "l").agg(
        F.min(F.when(F.col("upto") >= BY_ITSELF, F.col("bin"))).alias("high"),
        F.min(F.when(F.col("upto") >= 0.5, F.col("bin"))).alias("usual"),
    )
    n, place = len(model.most_trained), {l: k for k, l in enumerate(model.most_trained)}
    high, usual = np.full((n, n), np.nan), np.full(n, np.nan)
    for r in quantiles.collect():  # one row for each pair of PAIRED languages
        high[place[r["number"]], r["l"]] = (r["high"] + 1) / BINS
        if place[r["number"]] == r["l"]:
            usual[r["l"]] = r["usual"] / BINS
    least = np.minimum(high, usual / 2)
    least[np.isnan(least)] = LEAST_SHARE
    np.fill_diagonal(least, 0.0)
    return least


def identified_documents(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The documents that are in a known language and hold some of the one they say, as they are.

    A text goes if it is ``und``, or if it shows no more of the language it says than texts in the language
    found show of that by themselves (``shown_by_itself``). So a text with long quotations in another language
    stays, and so does one that shows nothing of any language or says one that nothing was learned of. Where
    either language is not among the ``PAIRED`` most trained ones, the share asked for is ``LEAST_SHARE``.
    """
    known = documents.filter(in_training(F.col(f"`{id_col}`")))
    model = train(known, text_col, lang_col)
    language = language_of(documents.sparkSession, model, more=True)
    name, = free_names(documents, "_language")
    found, said = F.col(name), F.col(f"`{lang_col}`")
    foreign = F.lit(False)
    if model:
        paired = F.array(*[F.lit(model.languages[l]) for l in model.most_trained])
        least = shown_by_itself(known, model, language, text_col, lang_col)
        limits = F.from_json(F.lit(json.dumps(least.ravel().tolist())), "array<double>")
        of, at = [F.nullif(F.array_position(paired, x), F.lit(0)).cast("int") - 1 for x in (said, found["lang_pred"])]
        limit = F.get(limits, at * len(model.most_trained) + of)
        other = F.when(said == found["lang_pred"], 0.0).otherwise(LEAST_SHARE)
        foreign = F.coalesce((found["claimed"] < F.coalesce(limit, other)) & (found["score"] > 0), F.lit(False))
    marked = documents.withColumn(name, language(F.col(f"`{text_col}`"), said.cast("string")))
    return marked.filter((found["lang_pred"] != UNKNOWN) & ~foreign).drop(name)
