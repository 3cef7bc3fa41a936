"""Column helpers of the tagged-text parser."""

import pytest
from pyspark.sql import functions as F

from songloom.functions import text as T
from songloom.operators import tagged_text as P


@pytest.mark.parametrize(
    "line, value",
    [
        (r"\film{Blue Road}%", "Blue Road"),
        (r"\film{}%", ""),
        ("% note", ""),
        (r"\film{ a {b} c}", "a {b"),
        (r"\film{open", ""),
        ("\\film{\u2003wide\xa0}", "wide"),
    ],
)
def test_first_braces(evaluate, line, value):
    assert evaluate(T.first_braces(F.lit(line))) == value


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("one \\threedots\ntwo", "one \\...\ntwo"),
        ("##refrain##", "refrain"),
        ("a\n\n\n\nb", "a\n\nb"),
        ("la \\- 2", "la \\"),
        ("1950-60", "1950"),
        ("x -\n 3 y", "x  y"),
        ("##over\nlines## #one", "over\nlines #one"),
        ("- \u0967\u0968 end", "end"),
        (" \x1c\u3000mid dle\x85", "mid dle"),
    ],
)
def test_clean_lyrics(evaluate, raw, cleaned):
    assert evaluate(T.clean_lyrics(F.lit(raw))) == cleaned


@pytest.mark.parametrize(
    "raw, year", [("1977", 1977), ("unknown", None), ("", None), ("+77", None), (" 1977", None), ("99999999999", None)]
)
def test_safe_year(evaluate, raw, year):
    assert evaluate(T.safe_year(F.lit(raw))) == year


@pytest.mark.parametrize("raw, title", [("##Blue Road##", "Blue Road"), ("# a ##b## #", "a b"), (" ### x#", "### x")])
def test_clean_title(evaluate, raw, title):
    assert evaluate(T.clean_title(F.lit(raw))) == title


@pytest.mark.parametrize(
    "name, number, leading",
    [("12345.isb.txt", 12345, 12345), ("007.isb.txt", 7, 7), ("x.isb.txt", None, 0), ("12x.isb.txt", None, 12)],
)
def test_file_id(evaluate, name, number, leading):
    assert evaluate(T.file_id(F.lit(name))) == number
    assert int(evaluate(T.leading_number(F.lit(name)))) == leading


def test_lines_are_right_trimmed_only(evaluate):
    assert evaluate(P.text_lines(F.lit("a \t\r\n  b\rc\x0b\n\n"))) == ["a", "  b", "c", ""]
    assert evaluate(P.text_lines(F.lit(""))) == []


@pytest.mark.parametrize(
    "content, block",
    [
        ("#indian\na\n#endindian\nb", "a"),
        ("#indian\na\n% c\n#endindian\nx\n#indian\nb\n", "a\nb"),
        ("#indian\na\n#indian twice\nb", "a\nb"),
        (" #indian\na\n#endindian", ""),
        ("#indian\n#endindian", ""),
        ("#indian", ""),
        ("#endindian\n#indianX\na  \n\n#endindianY\nb", "a\n"),
        ("#indian\na#endindian\nb\u2028#endindian\n", "a#endindian\nb\u2028#endindian"),
    ],
)
def test_lyrics_block(evaluate, content, block):
    assert evaluate(P.lyrics_block(F.lit(content))) == block


def test_ignored_lines(evaluate):
    for line in ["% x", "#x", r"\starring{a}", r"\printtitle", r"\startsong", r"\endsong"]:
        assert evaluate(P.is_ignored_line(F.lit(line))) is True
    for line in [r"\film{a}", " %", ""]:
        assert evaluate(P.is_ignored_line(F.lit(line))) is False


def test_long_texts_do_not_overflow(spark):
    body = "word \n" * 200_000
    content = f"\\film{{F}}\n#indian\n{body}#endindian\n\\music{{M}}\n"
    song = P.parse_songs(spark.createDataFrame([("1.isb.txt", content)], "source_file string, content string")).first()
    assert (song.film, song.music) == ("F", "M")
    assert len(song.lyrics_itrans) == 5 * 200_000 - 1
