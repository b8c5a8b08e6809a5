"""The training-data queries, name -> (spark, sf_dir) -> DataFrame, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import (
    ann,
    conversation_repair,
    lexical_search,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    quality_rules,
    quotation_linking,
    secret_scan,
    sentencepiece_viterbi,
    substring_dedup,
    toxicity,
)
from barloom.llm.shared import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ship_package(spark), sf_dir)

    return run


QUERIES: dict[str, Query] = {
    q.__name__: _shipped(q)
    for q in (
        substring_dedup.op1_substring_dedup,
        ngram_join.op2_ngram_jaccard_join,
        license_scan.op3_license_scan,
        quality_rules.op4_quality_cascade,
        ann.op5_random_projection_forest,
        quotation_linking.op6_quotation_linking,
        sentencepiece_viterbi.op7_sentencepiece_round_trip,
        toxicity.op8_toxicity,
        secret_scan.op9_secret_scan,
        packing.op10_best_fit_packing,
        lexical_search.op11_lexical_search,
        line_dedup.op12_line_dedup,
        conversation_repair.op13_conversation_repair,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"


def _more(best: str, cost: str, letter: str) -> str:
    """SQL of a path of edits, its cost in nine digits before its letters, with one more edit."""
    return f"lpad((left({best}, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({best}, 10) || {letter}"


def _inserted(select: str) -> str:
    """SQL of the best path to each state, after up to two rows inserted."""
    user = f"least(u, {_more('z', '5', chr(39) + 'I' + chr(39))}, {_more('s', '5', chr(39) + 'I' + chr(39))}, {_more('a', '5', chr(39) + 'I' + chr(39))})"
    return f"""SELECT conv_id, i, z, s, u, least(a, {_more('u', '5', "'I'")}) AS a
  FROM (SELECT conv_id, i, z, s, {user} AS u, a FROM ({select}))"""


def _kept(path: str, role: str) -> str:
    """SQL of a path that keeps the row, or gives it another role."""
    return _more(path, f"open5 + if(o = '{role}', 0, 1)", f"if(o = '{role}', 'K', 'R')")

ORACLE: dict[str, str] = {
    "op1_substring_dedup": rf"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '{_WORD}'), []::VARCHAR[]) AS w FROM documents),
s AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS i,
    unnest(list_transform(range(1, len(w) - 33), lambda k: array_to_string(w[k:k + 34], ' '))) AS g
  FROM d),
r AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM s JOIN r USING (g)),
k AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN c USING (doc_id, p)
  GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
    "op2_ngram_jaccard_join": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}'), []::VARCHAR[]) AS w
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' ')) END) AS gram
  FROM d),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
  SELECT u, v FROM o JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.v FROM reach r JOIN l ON l.u = r.other)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op4_quality_cascade": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS body, coalesce(regexp_extract_all(text, '{_WORD}'), []::VARCHAR[]) AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
t AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
    unnest(list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k:k + 2], ' '))) AS g
  FROM d),
r AS (SELECT doc_id, g FROM t GROUP BY doc_id, g HAVING count(*) > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
  SELECT doc_id, unnest(range(i, i + 3)) AS p FROM t JOIN r USING (doc_id, g)) GROUP BY doc_id),
m AS (
  SELECT doc_id, body, len(w)::BIGINT AS n_words,
    length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(body) - length(translate(body, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 20 * n_words AND 10 * n_symbols <= 3 * n_words
    AND 10 * n_dup_lines <= 3 * n_lines
    AND 10 * length(regexp_replace(body, '[^\p{{L}}]', '', 'g')) >= 6 * word_chars
    AND 10 * len(regexp_extract_all(body, '(?:\.\.\.|\x{{2026}})[\x20\x09\r]*(?:\n|\z)')) <= 3 * n_lines
    AND 10 * len(regexp_extract_all(body, '(?:\A|\n)[\x20\x09]*[-*\x{{2022}}]')) <= 9 * n_lines AS kept
FROM b""",
    "op11_lexical_search": r"""
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM p GROUP BY doc_id),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM n),
m AS (SELECT doc_id, 100 - 50 + (50 * n * docs) // words AS m FROM n, s),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, docs),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
r AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50""",
    "op12_line_dedup": r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents),
k AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
r AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT doc_id, line, i, last IS NOT NULL AND doc_id <> last AS dropped FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op13_conversation_repair": rf"""
WITH RECURSIVE c AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS key
  FROM conversations),
h AS (
  SELECT k.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS h
  FROM k, c),
d AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM h WHERE h <> 0),
o AS (
  SELECT *, left(role, 1) AS o, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    trim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) AS body
  FROM d),
f AS (
  SELECT *, body = '' AS blank, body <> '' AND again AS duplicate,
    body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS truncated,
    lag(o) OVER (PARTITION BY conv_id ORDER BY i) || o NOT IN ('su', 'ua', 'au') AS illegal
  FROM o),
e AS (SELECT *, CASE WHEN truncated THEN 5 ELSE 0 END AS open5, NOT blank AND NOT duplicate AS fit FROM f),
p(conv_id, i, z, s, u, a) AS (
  {_inserted("SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000000' AS z, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM conversations")}
  UNION ALL
  {_inserted(f"""SELECT p.conv_id, e.i, {_more('z', '2', "'D'")} AS z,
      least({_more('s', '2', "'D'")}, CASE WHEN fit AND o = 's' THEN {_more('z', 'open5', "'K'")} END) AS s,
      least({_more('u', '2', "'D'")}, CASE WHEN fit THEN least({_kept('z', 'u')}, {_kept('s', 'u')}, {_kept('a', 'u')}) END) AS u,
      least({_more('a', '2', "'D'")}, CASE WHEN fit THEN {_kept('u', 'a')} END) AS a
    FROM p JOIN e ON e.conv_id = p.conv_id AND e.i = p.i + 1""")}),
b AS (SELECT conv_id, arg_max(least(z, a), i) AS best FROM p GROUP BY conv_id),
l AS (SELECT conv_id, unnest(string_split(substr(best, 10), '')) AS l, unnest(range(length(best) - 9)) AS j FROM b WHERE length(best) > 9),
n AS (
  SELECT *, count(*) FILTER (l <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i,
    count(*) FILTER (l <> 'D') OVER (PARTITION BY conv_id ORDER BY j) AS out
  FROM l),
w AS (
  SELECT n.*, role, text, max(CASE WHEN l = 'K' AND out = 1 AND o = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.conv_id) AS has_s
  FROM n LEFT JOIN e ON e.conv_id = n.conv_id AND e.i = n.i AND l <> 'I'),
r AS (
  SELECT conv_id, string_agg(concat(
    CASE WHEN l = 'K' THEN role WHEN (out - has_s) % 2 = 1 THEN 'user' ELSE 'assistant' END, ':', text), chr(10) ORDER BY j) AS repaired
  FROM w WHERE l <> 'D' GROUP BY conv_id),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM f GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, left(best, 9)::BIGINT AS cost,
  substr(best, 10) AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM b LEFT JOIN g USING (conv_id) LEFT JOIN r USING (conv_id)""",
}
