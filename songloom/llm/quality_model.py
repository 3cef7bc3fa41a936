"""A quality classifier: cumulative-link regression of graded ratings on hashed text features.

A text's features are the set of its normalised words (letters only, lower-cased), of the ends of its
raw words by class of character, and of levels of repetition, hashed to ``FEATURES`` numbers. One weight per feature is shared by
all grades; ordered thresholds split the line: ``P(grade <= k) = sigmoid(threshold[k] - weights . x)``.
Both give each text an expected grade and the probability of the top grades, by which it is selected.

The fit runs on the driver over at most ``MAX_LABELLED`` labelled rows, chosen by a hash of their id;
features in fewer than ``LEAST_TEXTS`` of them keep weight 0. Scoring reads every whole text in one
narrow pass. The model is ``FEATURES`` numbers, whatever the corpus holds.

Null texts count as empty; an empty text has no features and is scored by the thresholds alone. Labels
that are null are left out; ratings that repeat an id count as often as they come. Without any labelled
text, or with one grade only, nothing can be learned: every text gets that grade (or null) and is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from songloom.llm.common import give_back_memory, lean, pick
from songloom.llm.quality_rules import repeated_words
from songloom.llm.words import IS_SPACE, LOWER, Words, mix, word_chunks
from songloom.plans.staging import stage

FEATURES = 1 << 22
MAX_LABELLED = 12_000
LEAST_TEXTS = 3
PRIOR, LEAST_SCALE = 3.0, 0.5
STEPS, RIDGE = 40, 3e-4
TAIL = 0.6  # least probability of the top grade to be selected
_CLASS = np.arange(256, dtype=np.uint8)  # bytes by class: A, a, 0, or a symbol itself
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 65, 97, 48, 97
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)


def _normalised(data: np.ndarray) -> np.ndarray:
    """Letters lower-cased (ASCII and the Latin-1 block), newlines kept, the rest of ASCII as spaces."""
    out = _LETTERS[data]
    out[data == 10] = 10
    latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[latin] += 32
    return out


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(text, feature)`` pairs, sorted."""
    letters = _normalised(words.data)
    # The same texts cut into runs of letters: ends of texts stay where they were.
    letter = ~IS_SPACE[letters]
    edge = np.diff(np.r_[False, letter].astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    runs = Words(letters, words.begin, words.end, start, stop, np.r_[np.searchsorted(start, words.begin), len(start)])
    plain = mix(runs.hashes() + np.uint64(1)) >> np.uint64(42)
    kind = _CLASS[words.data].astype(np.uint64)
    last = words.stop - 1
    tail = kind[last]
    for back in (1, 2):
        at = np.maximum(last - back, 0)
        tail = (tail << np.uint64(8)) | np.where(at >= words.start, kind[at], np.uint64(0))
    shape = mix(tail + np.uint64(1 << 40)) >> np.uint64(42)
    owners, found = [runs.of_word(), words.of_word()], [plain, shape]
    for kind, share in enumerate(_repetition(words)):
        for level in range(1, 8):
            at = np.flatnonzero(share >= level)
            owners.append(at)
            found.append(np.full(len(at), kind * 8 + level, np.uint64))
    owner = np.concatenate(owners).astype(np.uint64)
    pairs = np.unique((owner << np.uint64(22)) | np.concatenate(found))
    return (pairs >> np.uint64(22)).astype(np.int64), (pairs & np.uint64(FEATURES - 1)).astype(np.int32)


def _repetition(words: Words) -> list[np.ndarray]:
    """How much of a text is in repeated windows, and repeats the word before: 0 to 7, by doubling."""
    n = len(words.begin)
    same = words.hashes(LOWER[words.data])
    owner = words.of_word()
    again = (same[1:] == same[:-1]) & (owner[1:] == owner[:-1])
    counts = [repeated_words(words), np.bincount(owner[1:][again], minlength=n)]
    return [np.ceil(np.log2(1 + 100 * c / np.maximum(np.diff(words.first), 1))) for c in counts]


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, value: np.ndarray) -> np.ndarray:
        """The probability of each grade."""
        below = _sigmoid(self.thresholds[None, :] - value[:, None])
        return np.diff(np.c_[np.zeros(len(value)), below, np.ones(len(value))], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _scales(owner: np.ndarray, feature: np.ndarray, top: np.ndarray) -> np.ndarray:
    """For each feature the log of its rate among the best texts over that among the others.

    Weights are learned as multiples of it, so that the ridge holds back features that say little.
    """
    best = np.bincount(feature, weights=top[owner], minlength=FEATURES)
    rest = np.bincount(feature, weights=~top[owner], minlength=FEATURES)
    odds = (~top).sum() / top.sum()
    scale = np.log((best + PRIOR) / (top.sum() + PRIOR)) - np.log((rest + PRIOR * odds) / ((~top).sum() + PRIOR * odds))
    scale[(best + rest < LEAST_TEXTS) | (np.abs(scale) < LEAST_SCALE)] = 0
    return scale


def fit_ordinal(owner: np.ndarray, feature: np.ndarray, grade: np.ndarray, grades: int) -> OrdinalModel:
    """Maximum likelihood with a ridge over all given rows, by limited-memory quasi-Newton steps.

    Grades weigh by the inverse root of their number, so that rare ones count.
    """
    scale = _scales(owner, feature, grade == grades - 1)
    used = scale[feature] != 0
    owner, feature = owner[used], feature[used]
    names, column = np.unique(feature, return_inverse=True)
    scale, k = scale[names], len(names)
    counts = np.bincount(grade, minlength=grades)
    weight = 1 / np.sqrt(counts[grade])
    weight /= weight.sum()

    def thresholds(free: np.ndarray) -> np.ndarray:
        return np.r_[free[0], free[0] + np.cumsum(np.exp(free[1:]))]

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        value = np.bincount(owner, weights=(x[:k] * scale)[column], minlength=len(grade))
        bounds = np.r_[-np.inf, thresholds(x[k:]), np.inf]
        upper, lower = _sigmoid(bounds[grade + 1] - value), _sigmoid(bounds[grade] - value)
        upper[grade == grades - 1], lower[grade == 0] = 1.0, 0.0
        likely = np.maximum(upper - lower, 1e-9)
        up, low = weight * upper * (1 - upper) / likely, weight * lower * (1 - lower) / likely
        by_weight = np.bincount(column, weights=(up - low)[owner], minlength=k) * scale + RIDGE * x[:k]
        by_bound = np.bincount(grade, weights=low, minlength=grades)[1:] - np.bincount(grade, weights=up, minlength=grades)[:-1]
        later = np.cumsum(by_bound[::-1])[::-1]
        slope = np.r_[by_weight, later[0], later[1:] * np.exp(x[k + 1 :])]
        return RIDGE / 2 * (x[:k] @ x[:k]) - weight @ np.log(likely), slope

    share = np.clip(np.cumsum(counts)[:-1] / len(grade), 1e-3, 1 - 1e-3)
    bounds = np.log(share / (1 - share))
    start = np.r_[np.zeros(k), bounds[0], np.log(np.maximum(np.diff(bounds), 0.05))]
    x = _minimum(loss, start, STEPS)
    weights = np.zeros(FEATURES, np.float32)
    weights[names] = x[:k] * scale
    return OrdinalModel(weights, thresholds(x[k:]))


def _minimum(loss: Callable, x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with step halving."""
    value, slope = loss(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, shares = slope.copy(), []
        for move, change in reversed(moves):
            shares.append(move @ direction / (move @ change))
            direction -= shares[-1] * change
        if moves:
            direction *= moves[-1][0] @ moves[-1][1] / (moves[-1][1] @ moves[-1][1])
        for (move, change), share in zip(moves, reversed(shares)):
            direction += move * (share - change @ direction / (move @ change))
        length = 1.0 if moves else 1 / max(1.0, np.abs(slope).sum())
        down = slope @ direction
        while True:
            there = x - length * direction
            new_value, new_slope = loss(there)
            if new_value <= value - 1e-4 * length * down or length < 1e-8:
                break
            length /= 2
        if (there - x) @ (new_slope - slope) > 1e-12:
            moves = [*moves, (there - x, new_slope - slope)][-memory:]
        done = abs(value - new_value) < 1e-7
        x, value, slope = there, new_value, new_slope
        if done:
            break
    return x


@lean
def _labelled_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, words in word_chunks(batch["text"]):
            owner, feature = features(words)
            offsets = np.searchsorted(owner, np.arange(len(words.begin) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, feature)
            grade = batch["grade"].slice(row, len(words.begin))
            same = {c: batch[c].slice(row, len(grade)) for c in ("doc_id", "digest")}
            yield pa.RecordBatch.from_pydict(same | {"grade": grade, "features": lists})


def train(
    documents: DataFrame, graded: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED
) -> tuple[OrdinalModel | None, list[int]]:
    """A model and the sorted grades from ``graded``: ``(doc_id, grade)``.

    Fitted are at most ``max_labelled`` different texts with a grade. Where labelled ids repeat with several
    texts, each id and grade gives its first text before any gives its second.
    """
    some = graded.toDF("doc_id", "grade").dropna().orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(max_labelled)
    some = some.withColumn("grade", F.col("grade").cast("int")).distinct()
    given = pick(documents, doc_id=id_col, text=text_col).withColumn("digest", F.xxhash64("text"))
    labelled = given.select("doc_id", "digest").join(F.broadcast(some), "doc_id").distinct()  # at most max_labelled labels
    turn = F.row_number().over(Window.partitionBy("doc_id", "grade").orderBy("digest"))
    first = labelled.withColumn("turn", turn).filter(F.col("turn") <= max_labelled)
    wanted = stage(first.orderBy("turn", F.xxhash64("doc_id"), "doc_id", "grade").limit(max_labelled).drop("turn"))
    texts = given.join(F.broadcast(wanted), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest", "grade"])
    kind = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, digest long, grade int, features array<int>"
    chosen = texts.select("doc_id", "digest", "grade", "text").mapInArrow(_labelled_rows, kind)
    got = chosen.toArrow().combine_chunks()
    order = np.lexsort((got["digest"].to_numpy(), got["grade"].to_numpy(), got["doc_id"].to_numpy()))  # sums in one order: reruns agree
    got = got.take(pa.array(order)).combine_chunks()
    grades, grade = np.unique(got["grade"].to_numpy(), return_inverse=True)
    if len(grades) < 2:
        return None, [int(g) for g in grades]
    lists = got["features"]
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    owner = np.repeat(np.arange(len(grade)), sizes)
    model = fit_ordinal(owner, lists.flatten().to_numpy(), grade, len(grades))
    return model, [int(g) for g in grades]


def quality_score(spark: SparkSession, model: OrdinalModel, grades: list[int]) -> Callable[[Column], Column]:
    """A column function of texts: ``struct(expected_grade, tail_probability)``.

    ``tail_probability`` is that of the highest grade.
    """
    shared, values = spark.sparkContext.broadcast(model), np.array(grades, float)  # FEATURES numbers of 4 bytes

    @F.arrow_udf("expected_grade double, tail_probability double")
    def score(text: pa.Array) -> pa.Array:
        p = [np.zeros((0, len(values)))]
        for _, words in word_chunks(text):
            owner, feature = features(words)
            weights = shared.value.weights[feature]
            p.append(shared.value.probabilities(np.bincount(owner, weights=weights, minlength=len(words.begin))))
        p = np.concatenate(p)
        parts = [pa.array(p @ values), pa.array(p[:, -1].copy())]
        give_back_memory()
        return pa.StructArray.from_arrays(parts, ["expected_grade", "tail_probability"])

    return score


def graded_quality(
    documents: DataFrame, graded: DataFrame, id_col: str = "doc_id", text_col: str = "text", tail: float = TAIL
) -> DataFrame:
    """``(doc_id, expected_grade, tail_probability, kept)``, one row for each document."""
    model, grades = train(documents, graded, id_col, text_col)
    given = pick(documents, doc_id=id_col, text=text_col)
    if model is None:
        only = F.lit(float(grades[0]) if grades else None).cast("double")
        none = F.lit(None).cast("double")
        return given.select("doc_id", only.alias("expected_grade"), none.alias("tail_probability"), F.lit(True).alias("kept"))
    score = quality_score(documents.sparkSession, model, grades)
    scored = given.select("doc_id", score(F.col("text")).alias("s")).select("doc_id", "s.*")
    return scored.withColumn("kept", F.col("tail_probability") >= tail)


def selected_documents(
    documents: DataFrame, graded: DataFrame, id_col: str = "doc_id", text_col: str = "text", tail: float = TAIL
) -> DataFrame:
    """The documents that ``graded_quality`` keeps, as they are; nothing but the labelled rows is shuffled."""
    model, grades = train(documents, graded, id_col, text_col)
    if model is None:
        return documents
    score = quality_score(documents.sparkSession, model, grades)
    return documents.filter(score(F.col(f"`{text_col}`"))["tail_probability"] >= tail)


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, grade)`` of labels: 2 good and harmless, 1 with one fault, 0 poor and toxic."""
    grade: Column = F.col("quality") + 1 - F.col("toxic")
    return labels.select("doc_id", grade.cast("int").alias("grade"))
