"""Trimming, line and marker helpers shared by the tagged-text and web-page operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a blank-aware trim removes. Java's \s is narrower, so the set is
# spelled out once and reused for trims (as characters) and for patterns (as a class).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
BLANK_CLASS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def strip_chars(text: Column, chars: str) -> Column:
    return F.trim(text, F.lit(chars))


def lstrip_chars(text: Column, chars: str) -> Column:
    return F.ltrim(text, F.lit(chars))


def rstrip_chars(text: Column, chars: str) -> Column:
    return F.rtrim(text, F.lit(chars))


def unify_newlines(text: Column) -> Column:
    """``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    unified = F.regexp_replace(text, r"\r\n?", "\n")
    return F.when(F.contains(text, F.lit("\r")), unified).otherwise(text)


def rstrip_lines(text: Column) -> Column:
    """Remove blanks at the end of each line; leading blanks stay."""
    lines = F.transform(F.split(text, "\n", -1), lambda line: F.rtrim(line, F.lit(BLANKS)))
    return F.array_join(lines, "\n")


def unwrap_markers(text: Column) -> Column:
    """``##words##`` becomes ``words``; the pair may span lines."""
    return F.regexp_replace(text, "##([^#]*)##", "$1")


def first_braces(line: Column) -> Column:
    """Trimmed content of the first ``{...}`` on a line, ``''`` when there is none."""
    return strip(F.regexp_extract(line, r"\{([^}\n]*)\}", 1))


def safe_year(text: Column) -> Column:
    """ASCII digits become an int; anything else, or an int overflow, becomes null."""
    return F.when(text.rlike(r"^[0-9]+\z"), text.try_cast("int"))


def clean_lyrics(text: Column) -> Column:
    """Resolve dots and repeat marks, unwrap markers, squeeze blank lines, trim."""
    text = F.replace(text, F.lit("threedots"), F.lit("..."))
    text = F.regexp_replace(text, rf"-{BLANK_CLASS}*\p{{Nd}}+", "")
    text = unwrap_markers(text)
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return strip(text)


def clean_title(text: Column) -> Column:
    return strip(strip_chars(unwrap_markers(text), "#"))


def file_id(name: Column) -> Column:
    """Song id from ``<digits>.isb.txt``; null for any other name."""
    return F.regexp_extract(name, r"^([0-9]+)\.isb\.txt\z", 1).try_cast("int")


def leading_number(name: Column) -> Column:
    """Digits a file name starts with, 0 when it starts with none."""
    digits = F.regexp_extract(name, "^([0-9]+)", 1)
    return F.coalesce(digits.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
