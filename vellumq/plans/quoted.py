"""Queries over turned quotation marks, with SQL that turns them by a fold of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumq.operators import quotes as Q
from vellumq.plans.words import _docs

QUERIES, ORACLES = {}, {}
#: Texts beside the documents, few of which hold quotations within quotations.
PLANTED = [
    (-1, "\"He told us, 'go home', and went,\" she wrote. The dogs' bowls, the '90s, 6' by 8\"."),
    (-2, "('a' [\"b\" {'c'}]) \"'d' \" 'e\n'f\" g' \"\"\n\"'\"'"),
    (-3, "\"it's 5\" and 'tis \"7\" 'née' 一' ½\"  'x'\nno mark\n\"open 'to the end"),
]
_Q = "chr(39)"
_VALUES = ", ".join(f"({i}, '" + t.replace("'", "''").replace("\n", "' || chr(10) || '") + "')" for i, t in PLANTED)
_SIGN = lambda n: f"CASE x.kind WHEN 'd' THEN '{Q.SIGNS['d'][n]}' ELSE '{Q.SIGNS['s'][n]}' END"
_OWN = "right(acc.stack, 1) = x.kind"
_STAYS = f"(NOT ({_OWN}) AND (x.bef = 'n' OR (x.bef = 'l' AND x.kind = 's')))"
_CLOSES = f"({_OWN} AND x.bef <> 'o')"
_STACK = f"CASE WHEN {_STAYS} THEN acc.stack WHEN {_CLOSES} THEN left(acc.stack, length(acc.stack) - 1) ELSE acc.stack || x.kind END"
_TURNED = rf"""WITH dc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents UNION ALL SELECT * FROM (VALUES {_VALUES}) t(doc_id, text)),
ln AS (SELECT doc_id, i, s[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM dc), unnest(range(1, len(s) + 1)) AS u(i)),
pc AS (SELECT *, string_split(translate(line, chr(34), {_Q}), {_Q}) AS p, regexp_extract_all(line, '[''"]') AS m FROM ln),
sp AS (SELECT *, list_transform(m, lambda c, k: {{'kind': CASE c WHEN '"' THEN 'd' ELSE 's' END, 'bef': CASE WHEN p[k] = '' AND k = 1 THEN 'o' WHEN p[k] = '' THEN 'x' WHEN regexp_matches(p[k], '{Q.NUMBER}') THEN 'n' WHEN regexp_matches(p[k], '{Q.LETTER}') THEN 'l' WHEN regexp_matches(p[k], '{Q.OPENER}') THEN 'o' ELSE 'x' END, 'stack': '', 'sign': '', 'deep': 0::BIGINT, 'signs': []::VARCHAR[]}}) AS st FROM pc),
fd AS (SELECT *, list_reduce(list_prepend({{'kind': '', 'bef': '', 'stack': '', 'sign': '', 'deep': 0::BIGINT, 'signs': []::VARCHAR[]}}, st), lambda acc, x: {{'kind': '', 'bef': '', 'stack': {_STACK}, 'sign': '', 'deep': greatest(acc.deep, length({_STACK})),
  'signs': list_append(acc.signs, CASE WHEN {_STAYS} AND x.bef = 'n' THEN {_SIGN(2)} WHEN {_STAYS} THEN '{Q.APOSTROPHE}' WHEN {_CLOSES} THEN {_SIGN(1)} ELSE {_SIGN(0)} END)}}) AS f FROM sp),
tx AS (SELECT doc_id, sum(len(m)) AS marks, max(f.deep) AS deepest, sum(length(f.stack)) AS "left", string_agg(array_to_string(list_transform(p, lambda x, k: x || coalesce(f.signs[k], '')), ''), chr(10) ORDER BY i) AS text FROM fd GROUP BY doc_id)"""


def query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


@query(f'{_TURNED} SELECT doc_id, marks::INTEGER AS marks, deepest::INTEGER AS deepest, "left"::INTEGER AS "left", sha256(text) AS sha256 FROM tx')
def quotes_turned(spark, sf_dir):
    """Each text, and three planted ones, with its quotation marks turned; how deep its quotations go, and how many stay open."""
    docs = _docs(spark, sf_dir).select("doc_id", "text").unionByName(spark.createDataFrame(PLANTED, "doc_id bigint, text string"))
    return Q.texts(docs).select("doc_id", "marks", "deepest", "left", F.sha2("text", 256).alias("sha256"))
