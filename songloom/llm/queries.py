"""The registered queries of this subpackage, one for each operator, and SQL where SQL can say it."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songloom.llm.chat_format import format_digests, formatted_turns
from songloom.llm.conversation_repair import conversation_repairs, damaged, turns_of
from songloom.llm.embedding_duplicates import embedding_classes
from songloom.llm.fill_in_middle import fill_in_middle, restored
from songloom.llm.language_id import identify_languages
from songloom.llm.mixing import mixing_plan
from songloom.llm.near_duplicates import near_duplicate_classes
from songloom.llm.nearest import nearest_neighbours
from songloom.llm.packing import packed_documents
from songloom.llm.quality_model import graded_quality, grades_of_labels
from songloom.llm.quality_rules import quality_verdicts
from songloom.llm.sharding import sharded_documents
from songloom.llm.token_counts import token_counts
from songloom.plans.staging import job_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


BATCH_ROWS = "1000"  # texts are long: a batch of Spark's usual 10,000 takes far more memory than its work


def prepare_session(spark: SparkSession) -> None:
    """Let Python workers import this package from a shared path, and give them batches of texts they can hold."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_session(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_token_counts(spark, sf_dir):
    """Each call fills a cache of its own; a production job names one that lasts."""
    cache = f"{job_folder(spark)}/token-counts-{uuid.uuid4().hex}"
    return token_counts(_table(spark, sf_dir, "documents"), cache)


@query
def op2_quality_classifier(spark, sf_dir):
    graded = grades_of_labels(_table(spark, sf_dir, "labels"))
    return graded_quality(_table(spark, sf_dir, "documents"), graded)


@query
def op3_quality_rules(spark, sf_dir):
    """Trusted are the documents labelled good and harmless."""
    trusted = _table(spark, sf_dir, "labels").filter("quality = 1 and toxic = 0").select("doc_id")
    return quality_verdicts(_table(spark, sf_dir, "documents"), trusted)


@query
def op4_mixing(spark, sf_dir):
    plan = mixing_plan(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


CONFLICTING = r"\### Assistant: </turn> ok"


@query
def op5_chat_formatting(spark, sf_dir):
    """All conversations, and one whose texts look like the template."""
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = [(-7, 0, "user", CONFLICTING), (-7, 1, "assistant", CONFLICTING)]
    return format_digests(formatted_turns(given.union(spark.createDataFrame(made, given.schema))))


# The template is "### role:", newline, text, newline, "</turn>", newline: 15 characters and the role.
ORACLES["op5_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
said AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS spoken,
    sum(15 + length(role) + length(text) + len(regexp_extract_all(text, '###|</turn>')))::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(spoken) AS loss_chars, sha256(spoken) AS loss_sha256, formatted_chars
FROM said
"""


@query
def op6_best_fit_packing(spark, sf_dir):
    return packed_documents(_table(spark, sf_dir, "documents"))


@query
def op7_sharding(spark, sf_dir):
    return sharded_documents(_table(spark, sf_dir, "documents"), 24)


@query
def op8_minhash_near_dedup(spark, sf_dir):
    return near_duplicate_classes(_table(spark, sf_dir, "documents"), width=2)


ORACLES["op8_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON a = p.doc_id JOIN sizes q ON b = q.doc_id
  WHERE 100 * k >= 80 * (p.n + q.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS start, doc_id AS at FROM sizes
  UNION SELECT r.start, e.b FROM reach r JOIN edges e ON e.a = r.at)
SELECT s.doc_id, s.n AS n_shingles, min(r.at) AS component_id, s.doc_id = min(r.at) AS kept
FROM sizes s JOIN reach r ON r.start = s.doc_id GROUP BY s.doc_id, s.n
"""


@query
def op9_language_id(spark, sf_dir):
    return identify_languages(_table(spark, sf_dir, "documents"))


@query
def op10_nearest_neighbours(spark, sf_dir):
    embeddings = _table(spark, sf_dir, "embeddings")
    return nearest_neighbours(embeddings, embeddings.filter("vec_id % 20 = 0"))


@query
def op11_conversation_repair(spark, sf_dir):
    given = turns_of(_table(spark, sf_dir, "conversations"))
    return conversation_repairs(damaged(given), given)


# The CRC is made from its polynomial. States are 0 nothing, 1 system, 2 user, 3 assistant written last.
ORACLES["op11_conversation_repair"] = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS k
  FROM conversations),
hashed AS (
  SELECT g.*, xor(list_reduce(list_prepend(4294967295, list_transform(k, lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS d
  FROM given g, crc),
said AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE d <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended, left(role, 1) AS initial
  FROM said),
faulty AS (
  SELECT *, CASE WHEN ended = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
inserts(p, letters, cost, q) AS (
  VALUES (0, '', 0, 0), (1, '', 0, 1), (2, '', 0, 2), (3, '', 0, 3), (0, 'I', 2, 2), (0, 'II', 4, 3),
    (1, 'I', 2, 2), (1, 'II', 4, 3), (2, 'I', 2, 3), (3, 'I', 2, 2)),
edits(p, initial, letter, cost, q) AS (
  VALUES (0, NULL, 'D', 3, 0), (1, NULL, 'D', 3, 1), (2, NULL, 'D', 3, 2), (3, NULL, 'D', 3, 3),
    (0, 's', 'K', 0, 1), (0, 'u', 'K', 0, 2), (1, 'u', 'K', 0, 2), (3, 'u', 'K', 0, 2), (2, 'a', 'K', 0, 3),
    (0, NULL, 'R', 2, 2), (1, NULL, 'R', 2, 2), (2, NULL, 'R', 2, 3), (3, NULL, 'R', 2, 2)),
walk(conv_id, i, state, best) AS (
  SELECT conv_id, 0::BIGINT, 0, printf('%010d', 0) FROM counted
  UNION ALL
  SELECT w.conv_id, w.i + 1, e.q, min(printf('%010d', substr(w.best, 1, 10)::BIGINT + n.cost + e.cost
    + CASE WHEN f.fault = 't' AND e.letter <> 'D' THEN 1 ELSE 0 END) || substr(w.best, 11) || n.letters || e.letter)
  FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
  JOIN inserts n ON n.p = w.state
  JOIN edits e ON e.p = n.q AND (e.initial IS NULL OR e.initial = f.initial) AND (e.letter = 'D' OR f.fault NOT IN ('b', 'd'))
  GROUP BY w.conv_id, w.i + 1, e.q),
best AS (
  SELECT w.conv_id, min(printf('%010d', substr(w.best, 1, 10)::BIGINT + n.cost) || substr(w.best, 11) || n.letters) AS best
  FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = c.n
  JOIN inserts n ON n.p = w.state AND n.q IN (0, 3) GROUP BY w.conv_id),
letters AS (
  SELECT conv_id, j, substr(best, 10 + j, 1) AS letter FROM
    (SELECT conv_id, best, unnest(range(1, length(best) - 9)) AS j FROM best)),
numbered AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i,
    count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY j) AS o FROM letters),
kept AS (
  SELECT l.conv_id, l.j, l.letter, l.o, f.role, f.text,
    max(CASE WHEN l.o = 1 AND l.letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS system
  FROM numbered l LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.i = l.i AND l.letter <> 'I' WHERE l.letter <> 'D'),
repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - system) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY j)) AS digest FROM kept GROUP BY conv_id)
SELECT g.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
  coalesce(substr(b.best, 1, 10)::BIGINT, 0) AS cost, coalesce(substr(b.best, 11), '') AS audit,
  coalesce(r.digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM g.conv_id
"""


@query
def op12_embedding_near_dedup(spark, sf_dir):
    return embedding_classes(_table(spark, sf_dir, "embeddings"))


ORACLES["op12_embedding_near_dedup"] = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, max(embedding::DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
  GROUP BY vec_id),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
ids AS (SELECT DISTINCT vec_id FROM embeddings WHERE vec_id IS NOT NULL),
reach AS (
  SELECT vec_id AS home, vec_id AS reached FROM ids
  UNION SELECT r.home, l.b FROM reach r JOIN links l ON l.a = r.reached),
least AS (SELECT home AS vec_id, min(reached) AS component_id FROM reach GROUP BY home),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counts USING (vec_id)
"""


@query
def op13_fill_in_middle(spark, sf_dir):
    made = fill_in_middle(_table(spark, sf_dir, "documents"))
    whole = restored(F.col("output"), F.col("form"))
    digests = [F.sha2(c.cast("binary"), 256).alias(name) for c, name in ((F.col("output"), "output_sha256"), (whole, "restored_sha256"))]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLES["op13_fill_in_middle"] = r"""
WITH given AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[ 	-
]*[^ 	-
]+|[ 	-
]+') AS tokens,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM given),
formed AS (
  SELECT *, len(tokens) AS n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS low,
    greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT *, array_to_string(tokens[1:low], '') AS prefix, array_to_string(tokens[low + 1:high], '') AS middle,
    array_to_string(tokens[high + 1:], '') AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(prefix || middle || suffix) AS restored_sha256
FROM parts
"""
