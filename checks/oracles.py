"""Independent SQL for the registered queries.

Written the other way round than the Spark jobs where there is a choice: windows over exploded
lines instead of patterns over whole texts, plain cross products of distinct names instead of the
similarity join, a table-filling subsequence count instead of the bit-wise one.
"""

from __future__ import annotations

from checks import inputs as I
from checks.inputs import for_duckdb

ORACLES: dict[str, str] = {}
FILE_COLUMNS = "isb_id, stitle, film, year, starring, singer, music, lyricist, lyrics_itrans, source_file"
BLANKS = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)"
    "||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)"
    "||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
)
BLANK_CLASS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def add(name: str, sql: str) -> None:
    ORACLES[name] = for_duckdb(sql)


def clean(text: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace(replace({text}, 'threedots', '...'), "
        f"'-{BLANK_CLASS}*\\p{{Nd}}+', '', 'g'), '##([^#]*)##', '\\1', 'g'), '\\n{{3,}}', chr(10)||chr(10), 'g'), {BLANKS})"
    )


def title(text: str) -> str:
    return f"trim(trim(regexp_replace({text}, '##([^#]*)##', '\\1', 'g'), '#'), {BLANKS})"


# --- tagged text ---------------------------------------------------------------------------

LINES = f"""
src AS ({I.SONG_FILES}),
cut AS (SELECT source_file,
               string_split(regexp_replace(replace(replace(content, chr(13)||chr(10), chr(10)), chr(13), chr(10)), '\\n$', ''), chr(10)) AS ls
        FROM src),
lines AS (SELECT source_file, rtrim(unnest(ls), {BLANKS}) AS line, generate_subscripts(ls, 1) AS pos FROM cut),
marked AS (SELECT *, CASE WHEN starts_with(line, '#indian') THEN 1 WHEN starts_with(line, '#endindian') THEN 0 END AS mark
           FROM lines),
state AS (SELECT *, COALESCE(last_value(mark IGNORE NULLS) OVER (PARTITION BY source_file ORDER BY pos
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS inside FROM marked),
braced AS (SELECT *, trim(regexp_extract(line, '\\{{(.*?)\\}}', 1), {BLANKS}) AS v,
                  mark IS NULL AND inside = 0 AS outside FROM state)
"""


def tag(prefix: str) -> str:
    return f"COALESCE(arg_max(v, pos) FILTER (outside AND starts_with(line, chr(92) || '{prefix}')), '')"


BLOCK = "COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (inside = 1 AND mark IS NULL AND NOT starts_with(line, '%')), '')"
YEAR = f"CASE WHEN regexp_full_match({tag('year')}, '[0-9]+') THEN TRY_CAST({tag('year')} AS INT) END"
FILE_ID = "TRY_CAST(NULLIF(regexp_extract(source_file, '^([0-9]+)\\.isb\\.txt$', 1), '') AS INT)"

PARSED = f"""
WITH {LINES}
SELECT {FILE_ID} AS isb_id, {title(tag('stitle'))} AS stitle, {tag('film')} AS film, {YEAR} AS year,
       '' AS starring, {tag('singer')} AS singer, {tag('music')} AS music, {tag('lyrics')} AS lyricist,
       {clean(BLOCK)} AS lyrics_itrans, source_file
FROM braced GROUP BY source_file
"""
add("parse_song_files", PARSED)
add(
    "parse_song_files_with_cast",
    f"WITH {LINES} SELECT source_file, {tag('starring')} AS starring FROM braced GROUP BY source_file",
)
add("split_lines", f"WITH {LINES} SELECT line, COUNT(*) AS n FROM lines GROUP BY line")
add("select_lyrics_block", f"WITH {LINES} SELECT source_file, {BLOCK} AS block FROM braced GROUP BY source_file")
add(
    "drop_comment_lines",
    f"""WITH {LINES} SELECT source_file, COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (
        outside AND NOT starts_with(line, '%') AND NOT starts_with(line, '#')
        AND NOT regexp_matches(line, '^\\\\(starring|printtitle|startsong|endsong)')), '') AS kept
    FROM braced GROUP BY source_file""",
)
add(
    "extract_tags",
    f"""WITH {LINES} SELECT source_file, {tag('stitle')} AS stitle, {tag('film')} AS film, {tag('singer')} AS singer,
    {tag('music')} AS music, {tag('lyrics')} AS lyricist, {YEAR} AS year FROM braced GROUP BY source_file""",
)
add("clean_lyrics_text", f"SELECT doc_id, {clean('text')} AS cleaned FROM documents")
add("clean_song_titles", f"SELECT o_orderkey, {title(chr(39) + ' ###' + chr(39) + ' || o_orderpriority || ' + chr(39) + '## # ' + chr(39))} AS title FROM orders")
add(
    "file_name_ids",
    f"""SELECT source_file, {FILE_ID} AS isb_id,
    COALESCE(TRY_CAST(NULLIF(regexp_extract(source_file, '^([0-9]+)', 1), '') AS BIGINT), 0) AS leading
    FROM ({I.SONG_FILES}) f""",
)

# --- web pages -----------------------------------------------------------------------------

AMP = (
    "replace(replace(replace(replace(replace(replace(replace({}, '&copy;', '©'), '&copy ', '© '), '&apos;', chr(39)), "
    "'&middot;', '·'), '&quot;', '\"'), '&amp;', '&'), '&ampx', '&x')"
)


def decoded(text: str) -> str:
    return AMP.format(text)


SHOWN = (
    "regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), "
    "'(?is)<script(?: [^>]*)?>.*?</script>|<style(?: [^>]*)?>.*?</style>', '', 'g')"
)
TITLE = decoded("trim(regexp_extract(html, '(?is)<title>(.*?)</title', 1))")
LABEL = "rtrim(lower(trim(label)), ':')"
FIELD = f"""CASE WHEN {LABEL} IN ('film', 'movie') THEN 'film' WHEN {LABEL} = 'year' THEN 'year'
 WHEN {LABEL} IN ('singer', 'singers') THEN 'singer' WHEN {LABEL} IN ('music', 'composer') THEN 'music'
 WHEN {LABEL} IN ('lyrics', 'lyricist') THEN 'lyricist' WHEN {LABEL} IN ('starring', 'cast') THEN 'starring' END"""
# Labels followed by text, by a line break, or by a linked text.
LABEL_PATTERN = r'(?i)<b(?: (?:[^>"]|"[^"]*")*)?>([^<]*)</b>([^<]+|<br>|<a>[^<]*</a>|<i>[^<]*</i>)'
PAGES = f"""
pages_in AS ({I.LABELLED_PAGES}),
shown AS (SELECT isb_id, html AS raw, {SHOWN} AS html FROM pages_in),
titled AS (SELECT *, {TITLE} AS title FROM shown),
labels_found AS (
  SELECT isb_id, unnest(regexp_extract_all(html, '{LABEL_PATTERN}', 1)) AS label,
         unnest(regexp_extract_all(html, '{LABEL_PATTERN}', 2)) AS val,
         generate_subscripts(regexp_extract_all(html, '{LABEL_PATTERN}', 1), 1) AS pos FROM titled),
valued AS (SELECT isb_id, pos, {FIELD} AS field,
                  CASE WHEN val = '<br>' THEN '<br/>' ELSE trim(ltrim(trim({decoded('val')}), ':')) END AS val
           FROM labels_found),
fields AS (SELECT isb_id, arg_max(val, pos) FILTER (field = 'film') AS film,
                  CAST(arg_max(val, pos) FILTER (field = 'year' AND regexp_full_match(val, '[0-9]+')) AS INT) AS year,
                  arg_max(val, pos) FILTER (field = 'starring') AS starring,
                  arg_max(val, pos) FILTER (field = 'singer') AS singer,
                  arg_max(val, pos) FILTER (field = 'music') AS music,
                  arg_max(val, pos) FILTER (field = 'lyricist') AS lyricist FROM valued GROUP BY isb_id),
worked AS (SELECT t.isb_id, raw, title,
  CASE WHEN contains(html, '<h1') THEN {decoded("trim(regexp_extract(html, '(?s)<h1[^>]*>([^<]*)<', 1))")}
       WHEN contains(title, '|') THEN trim(split_part(title, '|', 1)) ELSE '' END AS stitle,
  COALESCE(film, '') AS film, year, COALESCE(starring, '') AS starring, COALESCE(singer, '') AS singer,
  COALESCE(music, '') AS music, COALESCE(lyricist, '') AS lyricist,
  CASE WHEN contains(html, '<pre>') THEN trim({decoded("replace(regexp_extract(html, '(?s)<pre>(.*?)</pre>', 1), '<br>', chr(10))")}, {BLANKS})
       WHEN contains(html, 'id="MyLyrics"') THEN trim({decoded(
           "replace(replace(regexp_extract(html, '(?s)id=.MyLyrics.>(.*</div>.*?)</div>', 1), '<div>', chr(10)), '</div>', chr(10))")}, {BLANKS})
       ELSE '' END AS lyrics_rendered
  FROM titled t LEFT JOIN fields f ON f.isb_id = t.isb_id)
"""
VALID = "NOT contains(lower(title), 'not found') AND length(raw) >= 500"
add("valid_pages", f"WITH {PAGES} SELECT isb_id, title FROM worked WHERE {VALID}")
add("page_song_titles", f"WITH {PAGES} SELECT isb_id, stitle FROM worked")
add("page_labels", f"WITH {PAGES} SELECT isb_id, film, year, starring, singer, music, lyricist FROM worked")
add("page_lyrics_text", f"WITH {PAGES} SELECT isb_id, lyrics_rendered AS lyrics FROM worked")
add(
    "parse_web_pages",
    f"""WITH {PAGES} SELECT isb_id, stitle, film, year, starring, singer, music, lyricist, lyrics_rendered
    FROM worked WHERE {VALID}""",
)
def routed(log: str, name: str = "routed") -> str:
    return f"""
{name}_log AS ({log}),
{name}_ends AS (SELECT isb_id, arg_min(status, attempt) AS status, arg_min(html, attempt) AS html
         FROM {name}_log WHERE attempt <= 3 AND status IN (200, 404) GROUP BY isb_id),
{name} AS (SELECT i.isb_id, status,
  status = 200 AND length(html) >= 500
    AND NOT contains(lower(regexp_extract(html, '(?is)<title>(.*?)</title', 1)), 'not found') AS ok,
  regexp_extract(html, '<pre>([^<]*)</pre>', 1) AS lyrics
  FROM (SELECT DISTINCT isb_id FROM {name}_log) i LEFT JOIN {name}_ends e ON e.isb_id = i.isb_id)
"""


ROUTED = routed(I.FETCH_LOG)
add(
    "route_fetch_log",
    f"""WITH {ROUTED} SELECT isb_id, CASE WHEN ok THEN 'saved' ELSE 'failed' END AS outcome,
    CASE WHEN ok THEN NULL ELSE 'parse_failed_or_404' END AS reason, status,
    CASE WHEN ok THEN lyrics END AS lyrics_rendered FROM routed""",
)
add(
    "fetch_counters",
    f"WITH {ROUTED} SELECT CASE WHEN ok THEN 'saved' ELSE 'failed' END AS outcome, COUNT(*) AS n FROM routed GROUP BY 1",
)

# --- merge, order, shape -------------------------------------------------------------------

LEADING = "COALESCE(TRY_CAST(NULLIF(regexp_extract(source_file, '^([0-9]+)', 1), '') AS BIGINT), 0)"
LAST = f"""
files AS ({I.FILE_SONGS}), scraped AS ({I.SCRAPED_SONGS}),
ordered AS (SELECT *, row_number() OVER (PARTITION BY isb_id ORDER BY {LEADING} DESC, source_file DESC) AS rn FROM files),
f AS (SELECT * FROM ordered WHERE rn = 1)
"""


def won(field: str, filled: str = "") -> str:
    value = f"s.{field}"
    if filled:
        value = f"CASE WHEN {filled.format(value)} THEN f.{field} ELSE {value} END"
    return f"CASE WHEN s.lyrics_rendered IS NOT NULL THEN {value} ELSE f.{field} END AS {field}"


JOINED = "FROM f FULL JOIN scraped s ON f.isb_id IS NOT DISTINCT FROM s.isb_id"
MERGED = f"""{LAST}, merged AS (SELECT CASE WHEN s.lyrics_rendered IS NOT NULL THEN s.isb_id ELSE f.isb_id END AS isb_id,
{', '.join(won(c) for c in ['stitle', 'film', 'year', 'starring', 'singer', 'music', 'lyricist'])},
s.lyrics_rendered, f.lyrics_itrans, f.source_file {JOINED})"""
add("merge_by_priority", f"WITH {MERGED} SELECT * FROM merged")
add(
    "merge_filling_blanks",
    f"""WITH {LAST} SELECT COALESCE(s.isb_id, f.isb_id) AS isb_id,
    {won('film', "COALESCE({}, '') = ''")}, {won('year', "{} IS NULL")},
    {won('singer', "COALESCE({}, '') = ''")}, {won('music', "COALESCE({}, '') = ''")} {JOINED}""",
)
add("last_file_per_id", f"WITH {LAST} SELECT * EXCLUDE (rn) FROM f")
_FILES_ONLY = f"SELECT '{{}}' AS branch, isb_id, film FROM ({I.FILE_SONGS}) f"
_SCRAPED_ONLY = f"SELECT '{{}}' AS branch, isb_id, film FROM ({I.SCRAPED_SONGS}) s"
add(
    "source_choice",
    f"""WITH {MERGED} {_FILES_ONLY.format('files')} UNION ALL {_SCRAPED_ONLY.format('scraped')}
    UNION ALL SELECT 'both', isb_id, film FROM merged
    UNION ALL {_SCRAPED_ONLY.format('no files')} UNION ALL {_FILES_ONLY.format('no scraped')}""",
)
add(
    "upsert_latest",
    """SELECT user_id AS isb_id, event_id, event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) e WHERE rn = 1""",
)
add(
    "finished_song_ids",
    f"""WITH {ROUTED} SELECT isb_id FROM routed WHERE ok UNION SELECT CAST(isb_id AS BIGINT) FROM ({I.SCRAPED_SONGS}) s""",
)
add(
    "pending_song_ids",
    f"""WITH done AS ({I.SCRAPED_SONGS}) SELECT r.isb_id FROM
    (SELECT unnest(range(0, (SELECT MAX(o_orderkey) FROM orders) + 1)) AS isb_id) r
    WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.film <> '' AND d.isb_id = r.isb_id)""",
)
add(
    "first_files",
    f"SELECT isb_id, source_file FROM ({I.FILE_SONGS}) f ORDER BY {LEADING}, source_file LIMIT 500",
)
add(
    "first_many_files",
    f"SELECT isb_id, source_file FROM ({I.FILE_SONGS}) f ORDER BY {LEADING}, source_file LIMIT 12000",
)
add(
    "first_merged",
    f"""WITH {MERGED} SELECT isb_id, film, source_file FROM merged
    ORDER BY COALESCE(isb_id, 0), source_file NULLS LAST LIMIT 500""",
)
add(
    "export_order",
    f"""WITH {MERGED} SELECT isb_id, source_file,
    row_number() OVER (ORDER BY isb_id NULLS LAST, source_file NULLS LAST) - 1 AS position FROM merged""",
)
EMPTY_IDS = """CAST(NULL AS VARCHAR) AS imdb_film_id, CAST(NULL AS VARCHAR) AS imdb_singer_ids,
CAST(NULL AS VARCHAR) AS imdb_music_ids, CAST(NULL AS VARCHAR) AS imdb_lyricist_ids"""
add(
    "column_contract",
    f"""SELECT isb_id, stitle, film, year, starring, singer, music, lyricist, lyrics_itrans,
    CAST(NULL AS VARCHAR) AS lyrics_rendered, {EMPTY_IDS}, source_file FROM ({I.FILE_SONGS}) f""",
)
add("distinct_film_years", f"SELECT DISTINCT film, year FROM ({PARSED}) p")
add(
    "file_scan",
    f"""SELECT CAST(s_suppkey AS INT) AS isb_id, s_name AS film, 'A' AS singer, 'line ' || s_name AS lyrics_itrans,
    CAST(s_suppkey AS VARCHAR) || '.isb.txt' AS source_file FROM supplier
    UNION ALL SELECT NULL, '', '', '', 'x' || CAST(n_nationkey AS VARCHAR) || '.isb.txt' FROM nation
    UNION ALL SELECT CAST(9000000 + r_regionkey AS INT), '', '', '', CAST(9000000 + r_regionkey AS VARCHAR) || '.isb.txt' FROM region""",
)
add(
    "empty_sources",
    f"""WITH scraped AS ({I.SCRAPED_SONGS}), years AS (SELECT DISTINCT YEAR(o_orderdate)::INT AS year FROM orders),
    asked AS (SELECT year FROM years UNION ALL SELECT year + 1000 FROM years)
    SELECT year, NOT EXISTS (SELECT 1 FROM scraped s WHERE s.year = asked.year) AS refused FROM asked""",
)
add(
    "run_counters",
    f"""WITH {ROUTED}, done AS ({I.SCRAPED_SONGS}), todo AS (SELECT * FROM routed WHERE isb_id NOT IN (SELECT isb_id FROM done))
    SELECT 'parsed' AS counter, COUNT(*) AS n FROM ({I.SONG_FILES}) f
    UNION ALL SELECT 'unreadable', 0
    UNION ALL SELECT 'skipped', COUNT(*) FROM routed WHERE isb_id IN (SELECT isb_id FROM done)
    UNION ALL SELECT 'saved', COUNT(*) FROM todo WHERE ok
    UNION ALL SELECT 'failed', COUNT(*) FROM todo WHERE NOT COALESCE(ok, false)
    UNION ALL SELECT 'films_asked', COUNT(*) FROM ({I.KNOWN_FILMS}) f
    UNION ALL SELECT 'people_asked', COUNT(*) FROM ({I.KNOWN_PEOPLE}) p
    UNION ALL SELECT 'films_resolved', COUNT(imdb_id) FROM ({I.KNOWN_FILMS}) f
    UNION ALL SELECT 'people_resolved', COUNT(imdb_id) FROM ({I.KNOWN_PEOPLE}) p""",
)
add(
    "ingest_refetched",
    f"""WITH {routed(I.FETCH_LOG, 'r')}, {routed(I.REFETCH_LOG, 'again')},
    both_runs AS (SELECT isb_id, r.ok AS first_ok, r.lyrics AS first_lyrics, a.ok AS ok, a.lyrics AS lyrics
                  FROM r JOIN again a USING (isb_id))
    SELECT CAST(isb_id AS INT) AS isb_id, 'saved' AS outcome, CASE WHEN ok THEN lyrics ELSE first_lyrics END AS lyrics_rendered
    FROM both_runs WHERE ok OR first_ok
    UNION ALL SELECT CAST(isb_id AS INT), 'failed', NULL FROM both_runs WHERE NOT (COALESCE(ok, false) AND COALESCE(first_ok, false))""",
)
add(
    "ingest_replayed",
    f"""WITH {ROUTED} SELECT CAST(isb_id AS INT) AS isb_id, CASE WHEN ok THEN 'saved' ELSE 'failed' END AS outcome,
    CASE WHEN ok THEN lyrics END AS lyrics_rendered FROM routed""",
)

# --- names and matching --------------------------------------------------------------------


def normal(text: str) -> str:
    spaced = rf"regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}_\t-\r\x1c-\x20]', ' ', 'g')"
    return rf"trim(regexp_replace({spaced}, '[\t-\r\x1c-\x20]+', ' ', 'g'))"


def key(text: str) -> str:
    return f"array_to_string(list_sort(string_split({normal(text)}, ' ')), ' ')"


def lcs(a: str, b: str) -> str:
    return f"""list_extract(list_reduce(string_split({a}, ''), lambda above, ch:
      list_reduce(range(1, length({b}) + 1), lambda acc, j: list_append(acc,
        CASE WHEN substr({b}, j, 1) = ch THEN above[j] + 1 ELSE greatest(above[j + 1], acc[j]) END), [0::BIGINT]),
      list_resize([0::BIGINT], length({b}) + 1, 0::BIGINT)), -1)"""


def ratio(a: str, b: str) -> str:
    # Two empty names have no score; one empty name scores 0.
    return f"""CASE WHEN {a} = '' AND {b} = '' THEN NULL WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE
      ELSE 200.0::DOUBLE * {lcs(a, b)} / (length({a}) + length({b})) END"""


NAMED = "trim(x, " + BLANKS + ")"
NAMES = f"list_filter(list_transform(regexp_split_to_array({{}}, '[,|/]'), lambda x: {NAMED}), lambda x: x <> '')"

add("normalise_text", f"SELECT doc_id, {normal('text')} AS name FROM documents")
add("sort_name_tokens", f"SELECT doc_id, {key('text')} AS name_key FROM documents")
add(
    "split_credit_names",
    f"""SELECT doc_id, CAST(len({NAMES.format('text')}) AS BIGINT) AS n,
    array_to_string({NAMES.format('text')}, '~') AS names FROM documents""",
)
# Distinct pairs of names are scored once and joined back.
add(
    "token_sort_scores",
    f"""WITH s AS ({I.SONG_SOURCE}), l AS ({I.LOOKUPS}),
    pairs AS (SELECT lookup_key, {key('query')} AS a, {key('p_name')} AS b FROM l JOIN s ON s.k = l.lookup_key),
    scored AS (SELECT a, b, {ratio('a', 'b')} AS score FROM (SELECT DISTINCT a, b FROM pairs) d)
    SELECT lookup_key, ROUND(score, 6) AS score FROM pairs JOIN scored USING (a, b)""",
)
SCORED = f"""
l AS ({I.LOOKUPS}), c AS ({I.CANDIDATES}),
pairs AS (SELECT l.lookup_key, year, query, rank, cand_id, cand_title, cand_year,
                 {key('query')} AS a, {key('cand_title')} AS b FROM l JOIN c ON c.lookup_key = l.lookup_key),
scores AS (SELECT a, b, {ratio('a', 'b')} AS score FROM (SELECT DISTINCT a, b FROM pairs) d),
windowed AS (SELECT *, year IS NULL OR cand_year IS NULL OR abs(cand_year - year) <= 2 AS near FROM pairs),
scored AS (SELECT *, bool_or(near) OVER (PARTITION BY lookup_key) AS any_near FROM windowed JOIN scores USING (a, b))
"""
BEST = """SELECT lookup_key, cand_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lookup_key ORDER BY score DESC, rank) AS rn FROM scored WHERE {}) r
WHERE rn = 1 AND score >= 82"""
add(
    "best_match",
    f"""WITH {SCORED}, best AS ({BEST.format('true')})
    SELECT l.lookup_key, cand_id, ROUND(score, 6) AS score FROM l LEFT JOIN best ON best.lookup_key = l.lookup_key""",
)
add(
    "best_match_in_year",
    f"""WITH {SCORED}, best AS ({BEST.format('near OR NOT any_near')})
    SELECT l.lookup_key, cand_id FROM l LEFT JOIN best ON best.lookup_key = l.lookup_key""",
)
add(
    "exact_match",
    f"""WITH l AS ({I.LOOKUPS}), c AS ({I.CANDIDATES}),
    hits AS (SELECT l.lookup_key, arg_min(cand_id, rank) AS cand_id FROM l JOIN c ON c.lookup_key = l.lookup_key
             WHERE {normal('query')} = {normal('cand_title')} GROUP BY l.lookup_key)
    SELECT l.lookup_key, cand_id FROM l LEFT JOIN hits ON hits.lookup_key = l.lookup_key""",
)
add(
    "year_window",
    f"WITH {SCORED} SELECT lookup_key, cand_id, cand_year FROM scored WHERE near OR NOT any_near",
)
FILM_KEY = "CASE WHEN year IS NULL OR year = 0 THEN query ELSE query || '|' || CAST(year AS VARCHAR) END"
add("film_keys", f"SELECT lookup_key, {FILM_KEY} AS cache_key FROM ({I.LOOKUPS}) l")

FILMS = f"""
songs AS ({I.FILE_SONGS}), catalogue AS ({I.FILM_CATALOGUE}),
wanted AS (SELECT DISTINCT {FILM_KEY} AS cache_key, query, year FROM (SELECT film AS query, year FROM songs WHERE film <> '') f),
left_keys AS (SELECT DISTINCT {key('query')} AS a FROM wanted), right_keys AS (SELECT DISTINCT {key('cand_title')} AS b FROM catalogue),
close_keys AS (SELECT a, b, score FROM (SELECT a, b, {ratio('a', 'b')} AS score FROM left_keys CROSS JOIN right_keys) p
               WHERE score >= 82),
named AS (SELECT *, {key('cand_title')} AS b FROM catalogue)
"""
FILM_IDS = """
hits AS (SELECT cache_key, score, rank, cand_id,
                year IS NULL OR cand_year IS NULL OR abs(cand_year - year) <= 2 AS near
         FROM (SELECT *, {key} AS a FROM wanted) w JOIN close_keys USING (a) JOIN named USING (b)),
flagged AS (SELECT *, bool_or(near) OVER (PARTITION BY cache_key) AS any_near FROM hits),
best AS (SELECT cache_key, cand_id FROM (
  SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY score DESC, rank) AS rn FROM flagged WHERE near OR NOT any_near) r
  WHERE rn = 1),
film_ids AS (SELECT w.cache_key, 'tt' || cand_id AS imdb_id FROM wanted w LEFT JOIN best b ON b.cache_key = w.cache_key)
""".replace("{key}", key("query"))
add(
    "film_candidates",
    f"""WITH {FILMS} SELECT DISTINCT query AS lookup_key, cand_id, cand_title
    FROM (SELECT DISTINCT query, {key('query')} AS a FROM wanted) w JOIN close_keys USING (a) JOIN named USING (b)""",
)
add("resolve_films", f"WITH {FILMS}, {FILM_IDS} SELECT cache_key, imdb_id FROM film_ids")
add(
    "known_answers",
    f"""WITH {FILMS}, {FILM_IDS}, known AS ({I.KNOWN_FILMS})
    SELECT cache_key, imdb_id FROM known UNION ALL
    SELECT cache_key, imdb_id FROM film_ids f WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.cache_key = f.cache_key)""",
)
PEOPLE = f"""
person_songs AS ({I.FILE_SONGS}), people AS ({I.PERSON_CATALOGUE}),
person_names AS (SELECT DISTINCT unnest({NAMES.format("singer || ',' || music || ',' || lyricist")}) AS name FROM person_songs),
person_left AS (SELECT DISTINCT {key('name')} AS a FROM person_names), person_right AS (SELECT DISTINCT {key('cand_name')} AS b FROM people),
person_close AS (SELECT a, b, score FROM (SELECT a, b, {ratio('a', 'b')} AS score FROM person_left CROSS JOIN person_right) p
                 WHERE score >= 78),
person_best AS (SELECT name, cand_id FROM (
  SELECT name, cand_id, row_number() OVER (PARTITION BY name ORDER BY score DESC, rank) AS rn
  FROM (SELECT *, {key('name')} AS a FROM person_names) n JOIN person_close USING (a)
  JOIN (SELECT *, {key('cand_name')} AS b FROM people) p USING (b)) r WHERE rn = 1),
person_ids AS (SELECT n.name, 'nm' || cand_id AS imdb_id FROM person_names n LEFT JOIN person_best b ON b.name = n.name)
"""
add("resolve_people", f"WITH {PEOPLE} SELECT name, imdb_id FROM person_ids")
add(
    "answers_round_trip",
    f"""SELECT name, imdb_id FROM ({I.KNOWN_PEOPLE}) k UNION ALL
    SELECT cand_name AS name, 'nm' || cand_id AS imdb_id FROM ({I.PERSON_CATALOGUE}) p""",
)

add("json_answers", I.KNOWN_FILMS)
add("first_credit_names", f"SELECT doc_id, trim(split_part(text, ',', 1), {BLANKS}) AS name FROM documents")


def ids(role: str, table: str, row: str) -> str:
    return f"""(SELECT COALESCE(string_agg(i.imdb_id, '|' ORDER BY u.pos), '') FROM
      (SELECT unnest({NAMES.format(f"COALESCE({row}.{role}, '')")}) AS name,
              generate_subscripts({NAMES.format(f"COALESCE({row}.{role}, '')")}, 1) AS pos) u
      JOIN {table} i ON i.name = u.name)"""


def with_ids(songs: str, films: str, people: str, columns: str) -> str:
    return f"""SELECT {columns}, fi.imdb_id AS imdb_film_id, {ids('singer', people, 's')} AS imdb_singer_ids,
    {ids('music', people, 's')} AS imdb_music_ids, {ids('lyricist', people, 's')} AS imdb_lyricist_ids
    FROM {songs} s LEFT JOIN {films} fi ON COALESCE(s.film, '') <> '' AND fi.cache_key =
      CASE WHEN COALESCE(s.year, 0) = 0 THEN s.film ELSE s.film || '|' || CAST(s.year AS VARCHAR) END"""


add(
    "attach_ids",
    f"""WITH songs AS ({I.FILE_SONGS}), film_ids AS ({I.KNOWN_FILMS}),
    person_ids AS ({I.KNOWN_PEOPLE} UNION ALL SELECT cand_name, 'nm' || cand_id FROM ({I.PERSON_CATALOGUE}) p)
    {with_ids('songs', 'film_ids', 'person_ids', 's.source_file')}""",
)

add(
    "catalogue_summary",
    f"""WITH songs AS ({I.FILE_SONGS}), film_ids AS ({I.KNOWN_FILMS}),
    linked AS (SELECT s.film, s.year, fi.imdb_id FROM songs s LEFT JOIN film_ids fi ON COALESCE(s.film, '') <> '' AND
      fi.cache_key = CASE WHEN COALESCE(s.year, 0) = 0 THEN s.film ELSE s.film || '|' || CAST(s.year AS VARCHAR) END)
    SELECT COUNT(*) AS total_songs, COUNT(DISTINCT film) AS films_covered, MIN(year) AS first_year, MAX(year) AS last_year,
    COUNT(imdb_id) AS matched,
    CASE WHEN COUNT(imdb_id) > 0 THEN ROUND(100.0::DOUBLE * COUNT(imdb_id) / COUNT(*), 1) END AS matched_percent FROM linked""",
)
add(
    "resolve_look_alikes",
    f"""WITH names AS ({I.LOOK_ALIKES}),
    a AS (SELECT asked, {key('asked')} AS a FROM names), b AS (SELECT cand_id, rank, {key('listed')} AS b FROM names),
    scored AS (SELECT a, b, {ratio('a', 'b')} AS score
               FROM (SELECT DISTINCT a FROM a) x CROSS JOIN (SELECT DISTINCT b FROM b) y),
    best AS (SELECT asked, cand_id, row_number() OVER (PARTITION BY asked ORDER BY score DESC, rank) AS rn
             FROM a JOIN scored USING (a) JOIN b USING (b) WHERE score >= 78)
    SELECT a.asked AS name, 'nm' || best.cand_id AS imdb_id FROM a LEFT JOIN best ON best.asked = a.asked AND rn = 1""",
)

# --- whole jobs ----------------------------------------------------------------------------

PARSED_MERGED = MERGED.replace(f"files AS ({I.FILE_SONGS})", f"files AS ({PARSED})")
CATALOGUE_FIELDS = (
    "isb_id, stitle, film, year, starring, singer, music, lyricist, lyrics_itrans, lyrics_rendered"
)
add(
    "catalogue_without_ids",
    f"WITH {PARSED_MERGED} SELECT {CATALOGUE_FIELDS}, {EMPTY_IDS}, source_file FROM merged",
)
_S_FIELDS = ", ".join(f"s.{c.strip()}" for c in (CATALOGUE_FIELDS + ", source_file").split(","))
_CAT_FILMS = FILMS.replace(f"songs AS ({I.FILE_SONGS})", "songs AS (SELECT * FROM merged)")
_CAT_PEOPLE = PEOPLE.replace(f"person_songs AS ({I.FILE_SONGS})", "person_songs AS (SELECT * FROM merged)").replace(
    "singer || ',' || music || ',' || lyricist",
    "COALESCE(singer, '') || ',' || COALESCE(music, '') || ',' || COALESCE(lyricist, '')",
)
add(
    "catalogue",
    f"""WITH {PARSED_MERGED}, {_CAT_FILMS}, {FILM_IDS}, {_CAT_PEOPLE}, known_people AS ({I.KNOWN_PEOPLE}),
    all_people AS (SELECT * FROM known_people UNION ALL SELECT * FROM person_ids p
                   WHERE NOT EXISTS (SELECT 1 FROM known_people k WHERE k.name = p.name))
    {with_ids('merged', 'film_ids', 'all_people', _S_FIELDS)}""",
)
BLANK_AS_NULL = ", ".join(
    f"NULLIF({c}, '') AS {c}" for c in ["stitle", "film"]
) + ", year, " + ", ".join(
    f"NULLIF({c}, '') AS {c}" for c in ["starring", "singer", "music", "lyricist", "lyrics_itrans"]
)
add(
    "csv_round_trip",
    f"""SELECT isb_id, {BLANK_AS_NULL}, CAST(NULL AS VARCHAR) AS lyrics_rendered, {EMPTY_IDS}, source_file
    FROM ({I.FILE_SONGS}) f""",
)
add(
    "incremental_ingest",
    f"""WITH {PAGES} SELECT CAST(isb_id AS INT) AS isb_id,
    CASE WHEN {VALID} THEN 'saved' ELSE 'parse_failed_or_404' END AS outcome FROM worked""",
)
ORACLES["catalogue_from_answers"] = ORACLES["catalogue"]
add(
    "catalogue_limited",
    f"""WITH {PARSED_MERGED}, first_songs AS (
      SELECT * FROM merged ORDER BY COALESCE(isb_id, 0), source_file NULLS LAST LIMIT 700),
    film_ids AS ({I.KNOWN_FILMS}), person_ids AS ({I.KNOWN_PEOPLE})
    {with_ids('first_songs', 'film_ids', 'person_ids', _S_FIELDS)}""",
)
