"""Inputs of the registered queries, derived from the given tables.

The tables hold no songs, so song texts, scraped rows, labelled pages and candidate lists are made
from their columns, over all rows, by SQL that both engines read the same way. ``@name`` stands
for a table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from songloom.sources.files import read_table

# One row per order with the names its song is made of.
SONG_SOURCE = """
SELECT o.o_orderkey AS k, o.o_orderpriority AS priority,
       CAST(YEAR(o.o_orderdate) AS INT) AS order_year,
       COALESCE(c.c_name, '') AS c_name, COALESCE(n.n_name, '') AS n_name,
       COALESCE(s.s_name, '') AS s_name, COALESCE(p.p_name, '') AS p_name
FROM @orders o
LEFT JOIN @customer c ON c.c_custkey = o.o_custkey
LEFT JOIN @nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS partkey, MIN(l_suppkey) AS suppkey
           FROM @lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
LEFT JOIN @part p ON p.p_partkey = l.partkey
LEFT JOIN @supplier s ON s.s_suppkey = l.suppkey
"""

# The film name as a contributor might have typed it.
_FILM = """
CASE k % 6
  WHEN 0 THEN p_name
  WHEN 1 THEN REPLACE(UPPER(p_name), ' ', '-')
  WHEN 2 THEN split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1)
  WHEN 3 THEN REPLACE(p_name, 'l', 'll')
  WHEN 4 THEN p_name || ' ii'
  ELSE REPLACE(REPLACE(p_name, 'o', 'u'), 'e', 'i') END
"""
_SINGER = """
CASE k % 4
  WHEN 0 THEN s_name
  WHEN 1 THEN REPLACE(s_name, 'pp', 'p') || ' / ' || n_name
  WHEN 2 THEN n_name || ', ' || REPLACE(s_name, '#', ' ') || ', '
  ELSE s_name || '|' || s_name END
"""


def _line(*parts: str) -> str:
    return " || ".join(parts) + " || chr(10)"


def _tag(name: str, value: str) -> str:
    return _line("chr(92)", f"'{name}'", "chr(123)", value, "chr(125)", "'%'")


_CONTENT = " || ".join(
    [
        _line("'%'"),
        _line("chr(92)", "'startsong'"),
        _tag("stitle", "CASE WHEN k % 2 = 0 THEN '##' || priority || '##' ELSE priority || ' ' || p_name || ' #' END"),
        _tag("film", "'to be corrected'"),
        _tag("film", f"({_FILM})"),
        _tag("year", "CASE WHEN k % 11 = 0 THEN 'unknown' ELSE CAST(order_year AS STRING) END"),
        _tag("starring", "c_name"),
        _tag("singer", f"({_SINGER})"),
        _tag("music", "CASE WHEN k % 5 = 0 THEN '' ELSE REPLACE(s_name, 'ie', 'ei') END"),
        "CASE WHEN k % 3 = 0 THEN '' ELSE " + _tag("lyrics", "n_name") + " END",
        _line("'% Contributor: '", "c_name"),
        _line("' '", "chr(92)", "'film'", "chr(123)", "'indented'", "chr(125)"),
        _line("chr(92)", "'printtitle'"),
        _line("'#indian'"),
        _line("'%'"),
        _line("'##'", "p_name", "'## '", "priority", "'   '"),
        _line("priority", "' '", "chr(92)", "'threedots'"),
        _line("n_name", "' '", "chr(92)", "'- '", "CAST(k AS STRING)"),
        _line("chr(92)", "'film'", "chr(123)", "'sung, not a tag'", "chr(125)"),
        "chr(10) || chr(10) || chr(10)",
        _line("'% note'"),
        _line("'  '", "s_name", "' 1950-60'"),
        "CASE WHEN k % 9 = 0 THEN '' ELSE " + _line("'#endindian'") + " END",
        "CASE WHEN k % 8 = 0 THEN " + _line("'#indian'") + " || " + _line("c_name")
        + " || " + _line("'#endindian'") + " ELSE '' END",
        "CASE WHEN k % 10 = 0 THEN " + _tag("film", "''") + " ELSE '' END",
        _line("chr(92)", "'endsong'"),
    ]
)

_NAME = """
CASE WHEN k % 97 = 0 THEN 'x' ELSE '' END ||
CASE WHEN k % 13 = 0 THEN '00' ELSE '' END || CAST({id} AS STRING) || '.isb.txt'
"""

SONG_FILES = f"""
SELECT source_file,
       CASE WHEN k % 7 = 0 THEN REPLACE(content, chr(10), chr(13) || chr(10)) ELSE content END AS content
FROM (SELECT k, {_NAME.format(id="k")} AS source_file, {_CONTENT} AS content FROM ({SONG_SOURCE}) s) f
"""

# Parsed-form records of the same songs. Two orders share an id, written with and without zeros.
FILE_SONGS = f"""
SELECT CASE WHEN k % 97 = 0 THEN NULL ELSE CAST(FLOOR(k / 2.0) AS INT) END AS isb_id,
       CASE WHEN k % 97 = 0 THEN 'x' ELSE '' END || CASE WHEN k % 2 = 1 THEN '00' ELSE '' END
         || CAST(CAST(FLOOR(k / 2.0) AS BIGINT) AS STRING) || '.isb.txt' AS source_file,
       priority AS stitle, {_FILM} AS film,
       CASE WHEN k % 11 = 0 THEN NULL ELSE order_year END AS year,
       '' AS starring, {_SINGER} AS singer,
       CASE WHEN k % 5 = 0 THEN '' ELSE REPLACE(s_name, 'ie', 'ei') END AS music,
       CASE WHEN k % 3 = 0 THEN '' ELSE n_name END AS lyricist,
       p_name || chr(10) || s_name AS lyrics_itrans
FROM ({SONG_SOURCE}) s
"""

# One scraped row per order; ids reach beyond the file ids and skip every other one.
SCRAPED_SONGS = """
SELECT CAST(o_orderkey * 2 AS INT) AS isb_id,
       o_orderpriority AS stitle,
       CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus || ' film' END AS film,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(YEAR(o_orderdate) AS INT) END AS year,
       'cast ' || o_orderstatus AS starring,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'NATION_1, NATION_2' END AS singer,
       '' AS music, 'NATION_3' AS lyricist,
       'rendered ' || CAST(o_orderkey AS STRING) AS lyrics_rendered
FROM @orders
"""

# The given pages with a label block, lyrics, and decoys in a comment and a script.
LABELLED_PAGES = """
SELECT page_id AS isb_id,
       CASE WHEN page_id % 10 = 7 THEN '<title>short | x</title>'
            WHEN page_id % 10 = 3 THEN REPLACE(html, '<title>', '<title>Not Found ')
            WHEN page_id % 10 = 5 THEN REPLACE(REPLACE(html, '<h1', '<h2'), '<title>', '<title>' || url || ' | ')
            ELSE html END ||
       '<!-- <b>Film:</b> in a comment --><script>var s = "<b>Film:</b> in a script";</script>' ||
       '<style-x>shown</style-x><pre-note>no lyrics</pre-note>' ||
       '<p><b>Film:</b> first<br/>' ||
       '<b class="l" title="1 > 0 <b>">Movie</b>: ' || url || ' &amp; more&apos;s &copy 5 &ampx<br/>' ||
       CASE WHEN page_id % 4 = 0 THEN '<b>YEAR:</b> n/a ' ELSE '<B>Year</B>: ' || CAST(1900 + page_id AS STRING) || ' ' END ||
       '<b>Singers:</b>' || CASE WHEN page_id % 2 = 0 THEN ' A ' || CAST(page_id AS STRING) || ', B ' ELSE '<br>' END ||
       '<b>Composer:</b> : C &copy; D<i>x</i><b>Cast:</b></p>' ||
       '<b>Unknown:</b> u<b>Lyricist:</b><a>' || CAST(page_id AS STRING) || '</a></p>' ||
       CASE WHEN page_id % 3 = 0 THEN '<pre>' || chr(10) || ' one ' || url || '<br>two </pre>'
            WHEN page_id % 3 = 1 THEN '<div class="x" id="MyLyrics">three<div> four </div>' || url || '</div> five'
            ELSE '<div class="lyrics">six</div>' END AS html
FROM @pages
"""

# Events as a fetch log: four events make the attempts of one id.
FETCH_LOG = """
SELECT CAST(FLOOR(e.event_id / 4.0) AS BIGINT) AS isb_id, CAST(e.event_id % 4 + 1 AS INT) AS attempt,
       CASE e.event_type WHEN 'view' THEN 200 WHEN 'signup' THEN 200 WHEN 'purchase' THEN 404
                         WHEN 'click' THEN 429 ELSE 500 END AS status,
       COALESCE(p.html, '<title>Song ' || e.props || '</title>' || repeat('<p>line</p>', 40 + CAST(e.user_id AS INT)))
         || '<pre>attempt ' || CAST(e.event_id % 4 + 1 AS STRING) || '</pre>' AS html
FROM @events e LEFT JOIN @pages p ON p.page_id = CAST(FLOOR(e.event_id / 4.0) AS BIGINT)
"""

# The same events fetched again, with the attempts the other way round.
REFETCH_LOG = f"SELECT isb_id, 5 - attempt AS attempt, status, html FROM ({FETCH_LOG}) first_run"

# Per order: the film that was typed, and the parts of its lines as the search hits.
LOOKUPS = f"""
SELECT k AS lookup_key, {_FILM} AS query, CASE WHEN k % 11 = 0 THEN NULL ELSE order_year END AS year
FROM ({SONG_SOURCE}) s
"""
CANDIDATES = """
SELECT DISTINCT l_orderkey AS lookup_key, l_partkey AS rank, 'c' || CAST(l_partkey AS STRING) AS cand_id,
       p_name AS cand_title, CASE WHEN p_size % 10 = 0 THEN NULL ELSE 1952 + p_size END AS cand_year
FROM @lineitem JOIN @part ON p_partkey = l_partkey
"""

FILM_CATALOGUE = """
SELECT CAST(p_partkey AS STRING) AS cand_id, p_name AS cand_title,
       CASE WHEN p_size % 10 = 0 THEN NULL ELSE 1952 + p_size END AS cand_year, p_partkey AS rank
FROM @part
"""
PERSON_CATALOGUE = """
SELECT CAST(s_suppkey AS STRING) AS cand_id, s_name AS cand_name, s_suppkey AS rank FROM @supplier
"""

# Answers of an earlier run: the films under the year of their part, those of odd parts as misses.
KNOWN_FILMS = """
SELECT p_name || '|' || CAST(1952 + p_size AS STRING) AS cache_key,
       CASE WHEN MIN(p_partkey) % 2 = 0 THEN 'tt' || CAST(MIN(p_partkey) AS STRING) END AS imdb_id
FROM @part GROUP BY p_name, p_size
"""
KNOWN_PEOPLE = """
SELECT n_name AS name, CASE WHEN n_nationkey % 3 > 0 THEN 'nm' || CAST(n_nationkey AS STRING) END AS imdb_id
FROM @nation
"""

# Every supplier's name behind some words, as asked and as listed: all are alike. Some match the name with
# their own number, some are as near to several others, some reach none.
LOOK_ALIKES = """
SELECT CASE s_suppkey % 3 WHEN 0 THEN 'Maestro ' ELSE 'Ustaad ji ' END || s_name AS asked,
       CASE s_suppkey % 5 WHEN 0 THEN 'Swami ' ELSE 'Ustad ' END || s_name AS listed,
       CAST(s_suppkey AS STRING) AS cand_id, s_suppkey AS rank
FROM @supplier
"""

# Files as they lie on disk: songs, songs without a word under names without digits, files of no bytes, and some
# that are no song files.
DISK_FILES = """
SELECT CAST(s_suppkey AS STRING) || '.isb.txt' AS name,
       CAST(chr(92) || 'film' || chr(123) || s_name || chr(125) || chr(10) || chr(92) || 'singer' || chr(123) || 'A' || chr(125)
         || chr(10) || '#indian' || chr(10) || 'line ' || s_name || chr(10) || '#endindian' || chr(10) AS @blob) AS content
FROM @supplier
UNION ALL SELECT 'x' || CAST(n_nationkey AS STRING) || '.isb.txt', CAST('%' AS @blob) FROM @nation
UNION ALL SELECT CAST(9000000 + r_regionkey AS STRING) || '.isb.txt', CAST('' AS @blob) FROM @region
UNION ALL SELECT CAST(r_regionkey AS STRING) || '.txt', CAST('not a song file' AS @blob) FROM @region
"""

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


# Tables whose rows each become a text to work on.
DRIVING = ["orders", "events", "pages"]


def for_duckdb(sql: str) -> str:
    sql = sql.replace("@blob", "BLOB")
    return re.sub(r"@(\w+)", r"\1", sql)


def derive(spark: SparkSession, sf_dir: str, sql: str, **given: DataFrame) -> DataFrame:
    """Run an input's SQL on the parquet tables of a folder; a table that is ``given`` takes the place of its own."""

    def view(match: re.Match) -> str:
        name = match.group(1)
        table = given[name] if name in given else read_table(spark, f"{sf_dir}/{name}.parquet")
        if name in DRIVING:  # one small file each here, and much work for each row
            table = table.repartition(spark.sparkContext.defaultParallelism)
        table.createOrReplaceTempView(f"given_{name}")
        return f"given_{name}"

    return spark.sql(re.sub(r"@(\w+)", view, sql.replace("@blob", "BINARY")))
