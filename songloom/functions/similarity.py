"""Name normalising and the 0-100 token-sort similarity, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from songloom.functions.text import strip

# Bits per word of the subsequence fold: two such words add up without overflowing a bigint.
_WORD = 62
_FULL = (1 << _WORD) - 1
_MARK = "\x01"


def normalise_name(text: Column) -> Column:
    """Lower case; every run of blanks and punctuation becomes one space; trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " "))


def split_names(text: Column) -> Column:
    """Names of a credit field split on ``, | /``: trimmed, blanks dropped, order kept."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), "[,|/]", -1), strip)
    return F.filter(parts, lambda name: name != "")


def sort_tokens(normalised: Column) -> Column:
    """Words in code-point order, joined by one space."""
    return F.array_join(F.array_sort(F.split(normalised, " ")), " ")


def name_key(text: Column) -> Column:
    """The string two names are compared on."""
    return sort_tokens(normalise_name(text))


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two strings, any length.

    One bit per character of ``a`` and one pass over the characters of ``b``, with ``m`` the places
    of the current character in ``a``: ``v' = (v + (v & m)) | (v & ~m)``. Zero bits left in ``v``
    count the subsequence.
    """
    ordered = F.when(F.length(a) <= F.length(b), F.struct(a.alias("a"), b.alias("b"))).otherwise(
        F.struct(b.alias("a"), a.alias("b"))
    )

    def count(pair: Column) -> Column:
        shorter, longer = pair["a"], pair["b"]
        return (
            F.when(shorter == longer, F.length(shorter))
            .when(F.length(shorter) == 0, F.lit(0))
            .when(F.length(shorter) <= _WORD, _one_word(shorter, longer))
            .otherwise(_many_words(shorter, longer))
        )

    return _bind(ordered, count)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _bits(text: Column, letter: Column) -> Column:
    """A bit for each character of a text of at most one word, set where it is ``letter``; the first is the highest.

    String functions mark the places, so that no step of it is interpreted letter by letter.
    """
    marked = F.replace(text, letter, F.lit(_MARK))
    digits = F.replace(F.regexp_replace(marked, f"[^{_MARK}]", "0"), F.lit(_MARK), F.lit("1"))
    return F.conv(digits, 2, 10).cast("bigint")


def _letter_places(text: Column) -> Column:
    """``map<letter, bits>``: for each letter of a text of one word the places where it stands."""
    letters = F.array_distinct(F.split(text, ""))
    return F.map_from_arrays(letters, F.transform(letters, lambda letter: _bits(text, letter)))


def _one_word(a: Column, b: Column) -> Column:
    """``a`` fits one word. Its first character is the highest bit, so ``b`` is read backwards."""
    places = _bind(
        _letter_places(a),
        lambda at: F.transform(F.split(F.reverse(b), ""), lambda letter: F.coalesce(F.try_element_at(at, letter), F.lit(0))),
    )

    def step(v, m):
        return (v + v.bitwiseAND(m)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m))).bitwiseAND(F.lit(_FULL))

    left = F.aggregate(places, F.lit(_FULL), step)
    return F.length(a) - F.bit_count(left.bitwiseAND(_low_bits(F.length(a))))


def _many_words(a: Column, b: Column) -> Column:
    """The same fold over words of 62 bits, the carry handed from word to word.

    The words of a letter are worked out once for ``a``. Their first characters are the lowest bits, so
    ``b`` is read forwards.
    """
    word_count = F.ceil(F.length(a) / F.lit(_WORD)).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(word_count, F.lit(1)) - 1),
        lambda k: F.reverse(F.substr(a, k * _WORD + 1, F.lit(_WORD))),
    )

    def folded(given: Column) -> Column:
        letters = F.array_distinct(F.split(given["a"], ""))
        places = F.map_from_arrays(
            letters, F.transform(letters, lambda letter: F.transform(given["blocks"], lambda block: _bits(block, letter)))
        )
        start = F.transform(given["blocks"], lambda block: F.lit(_FULL))
        masks = _bind(places, lambda at: F.transform(F.split(b, ""), lambda letter: F.try_element_at(at, letter)))
        return F.aggregate(F.filter(masks, lambda m: m.isNotNull()), start, step)

    def step(words, mask):
        def add(acc, pair):
            v, m = pair["v"], pair["m"]
            total = v + v.bitwiseAND(m) + acc["carry"]
            word = total.bitwiseAND(F.lit(_FULL)).bitwiseOR(v.bitwiseAND(F.bitwise_not(m)))
            return F.struct(
                F.shiftright(total, _WORD).alias("carry"),
                F.array_append(acc["words"], word).alias("words"),
            )

        empty = F.struct(
            F.lit(0).cast("bigint").alias("carry"),
            F.array().cast("array<bigint>").alias("words"),
        )
        pairs = F.zip_with(words, mask, lambda v, m: F.struct(v.alias("v"), m.alias("m")))
        return F.aggregate(pairs, empty, add, lambda acc: acc["words"])

    words = _bind(F.struct(a.alias("a"), blocks.alias("blocks")), folded)
    used = F.zip_with(
        words, blocks,
        lambda v, block: F.length(block) - F.bit_count(v.bitwiseAND(_low_bits(F.length(block)))),
    )
    return F.aggregate(used, F.lit(0), lambda acc, n: acc + n)


def _low_bits(count: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), count) - 1


def similarity(key_a: Column, key_b: Column) -> Column:
    """``200 * common / (len a + len b)`` of two compare keys; null when both are empty."""

    def score(pair: Column) -> Column:
        total = F.length(pair["a"]) + F.length(pair["b"])
        return F.when(total > 0, 200.0 * common_subsequence(pair["a"], pair["b"]) / total)

    return _bind(F.struct(key_a.alias("a"), key_b.alias("b")), score)


def may_reach(key_a: Column, key_b: Column, threshold: float) -> Column:
    """False only for pairs that cannot reach the threshold.

    The insertions and deletions between two keys are at least their edit distance, which is far
    cheaper to bound.
    """
    total = F.length(key_a) + F.length(key_b)
    room = F.floor((100 - float(threshold)) / 100 * total + 1e-9).cast("int")
    return F.call_function("levenshtein", key_a, key_b, room) >= 0


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Similarity of two raw names, 0-100, blind to case, punctuation and word order."""
    return similarity(name_key(a), name_key(b))
