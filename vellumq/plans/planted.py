"""Queries over slips planted at a distance and over real fixes, with SQL that chooses the slips one after another."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumq.operators import anchored as N
from vellumq.operators import targets as P
from vellumq.operators import witness as V
from vellumq.plans.aligned import _GAPS, _OPS, _round
from vellumq.plans.pairs import _PAIRS
from vellumq.plans.words import _docs

QUERIES, ORACLES = {}, {}


def query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


def _could(kind: str, word: str | None, new: str | None) -> str:
    if word is None:
        return f"SELECT *, '{kind}' AS kind, 1 AS tiles, length(x) AS size, x AS old, x || ' ' || x AS new FROM tv WHERE regexp_matches(x, '^[a-z]{{3,}}$')"
    if new:
        return f"SELECT *, '{kind}', 1, length(x), x, '{new}' FROM tv WHERE x = '{word}'"
    return f"SELECT *, '{kind}', 2, length(x) + 1, x || ' ', '' FROM tv WHERE x = '{word}' AND q = ' ' AND (p IS NULL OR regexp_matches(p, '[{P.SPACE}]$'))"


_PICK = f"CASE WHEN len(list_filter(acc, lambda s: abs(s.pos - x[1].pos) < {P.APART})) > 0 THEN acc ELSE list_concat(acc, x) END"
_SLIPS = rf"""tz AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{P.TILE}') AS t FROM documents),
te AS (SELECT doc_id, i - 1 AS tile, t[i] AS x, CASE WHEN i > 1 THEN t[i - 1] END AS p, t[i + 1] AS q FROM tz, unnest(range(1, len(t) + 1)) AS u(i)),
tw AS (SELECT *, sum(length(x)) OVER w - length(x) AS pos, sum((x = chr(10))::INTEGER) OVER w AS line, len(regexp_extract_all(x, '{P.WORD}')) - coalesce(regexp_matches(p, '[^{P.SPACE}]$') AND regexp_matches(x, '^[^{P.SPACE}]'), false)::INTEGER AS begun FROM te WINDOW w AS (PARTITION BY doc_id ORDER BY tile ROWS UNBOUNDED PRECEDING)),
tr AS (SELECT doc_id, line, sum(length(x)) AS room, arg_min(x, tile) AS head FROM tw WHERE x <> chr(10) GROUP BY doc_id, line),
tn AS (SELECT *, sum(begun) OVER (PARTITION BY doc_id ORDER BY tile ROWS UNBOUNDED PRECEDING) - begun AS word FROM tw),
tv AS (SELECT tn.* FROM tn JOIN tr USING (doc_id, line) WHERE room >= {P.ROOM} AND NOT regexp_matches(head, '{P.MARKUP}')),
cd AS ({" UNION ALL ".join(_could(*s) for s in P.SLIPS)}),
ch AS (SELECT *, left(sha256('1:' || doc_id || ':' || pos || ':' || kind), 16) AS h FROM cd),
ct AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind ORDER BY h, pos) AS turn FROM ch),
cl AS (SELECT doc_id, list({{'pos': pos, 'tile': tile, 'tiles': tiles, 'size': size, 'kind': kind, 'old': old, 'new': new, 'word': word}} ORDER BY turn, h, pos, kind) AS cs FROM ct GROUP BY doc_id),
cp AS (SELECT doc_id, list_reduce(list_prepend(cs[1:1], list_transform(cs[2:], lambda c: [c])), lambda acc, x: {_PICK}) AS cs FROM cl),
sl AS (SELECT doc_id, unnest(cs, recursive := true) FROM cp),
sp AS (SELECT *, pos + coalesce(sum(length(new) - size) OVER w, 0) AS "at", word + coalesce(sum(CASE WHEN new = '' THEN -1 WHEN kind = 'double' THEN 1 ELSE 0 END) OVER w, 0) AS w1, CASE WHEN kind = 'double' THEN 2 ELSE 1 END AS n
  FROM sl WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
_TEXTS = r"""pl AS (SELECT doc_id, list({'tile': tile, 'tiles': tiles, 'new': new} ORDER BY tile) AS ss FROM sp GROUP BY doc_id),
pt AS (SELECT doc_id, coalesce(len(ss), 0) AS slips, CASE WHEN ss IS NULL THEN array_to_string(t, '') ELSE array_to_string(list_concat(flatten(list_transform(ss, lambda s, k: list_append(t[(CASE WHEN k > 1 THEN ss[k - 1].tile + ss[k - 1].tiles ELSE 0 END) + 1:s.tile], s.new))), t[ss[-1].tile + ss[-1].tiles + 1:]), '') END AS text FROM tz LEFT JOIN pl USING (doc_id))"""
_SAID = "array_to_string({0}[{1} + 1:{2}], ' ')"
_BARE = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_]', '', 'g')"
_FIXED = f"""fx AS (SELECT a, b, i1 AS w1, greatest(i2, i1 + 1) AS w2, {_SAID.format('wa', 'i1', 'i2')} AS old, {_SAID.format('wb', 'j1', 'j2')} AS new FROM op JOIN blk1 USING (a, b) WHERE op <> 'equal'),
fr AS (SELECT * FROM fx WHERE {_BARE.format('old')} <> {_BARE.format('new')})"""
_SPLIT = f"regexp_extract_all(coalesce({{0}}, ''), '{P.WORD}')"
_NEAR = f"""WITH RECURSIVE {_PAIRS}, blk1 AS (SELECT near.a, near.b, 0 AS i0, 0 AS j0, {_SPLIT.format('x.text')} AS wa, {_SPLIT.format('y.text')} AS wb FROM near JOIN documents x ON x.doc_id = near.a JOIN documents y ON y.doc_id = near.b)"""


@query(f'WITH {_SLIPS} SELECT doc_id, kind, pos::INTEGER AS pos, "at"::INTEGER AS "at", w1::INTEGER AS w1, (w1 + n)::INTEGER AS w2, old, new FROM sp')
def slips_at_a_distance(spark, sf_dir):
    """Slips of ten kinds for each text, none nearer than 400 characters to another."""
    return P.plant(_docs(spark, sf_dir)).select("doc_id", "kind", "pos", "at", "w1", "w2", "old", "new")


@query(f"WITH {_SLIPS}, {_TEXTS} SELECT doc_id, slips::INTEGER AS slips, sha256(text) AS sha256 FROM pt")
def texts_with_slips(spark, sf_dir):
    """Each text with its slips in place."""
    docs = _docs(spark, sf_dir)
    return P.planted_texts(docs, P.plant(docs)).select("doc_id", "slips", F.sha2("text", 256).alias("sha256"))


@query(f"""WITH RECURSIVE {_SLIPS}, {_TEXTS}, blk1 AS (SELECT pt.doc_id AS a, pt.doc_id AS b, 0 AS i0, 0 AS j0, {_SPLIT.format('pt.text')} AS wa, {_SPLIT.format('d.text')} AS wb FROM pt JOIN documents d USING (doc_id) WHERE slips > 0),
{_round(1, 3)}, {_GAPS}, {_FIXED}
SELECT kind, count(*) AS planted, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM fr WHERE fr.a = sp.doc_id AND fr.w1 - 1 <= sp.w1 + n AND sp.w1 <= fr.w2 + 1)) AS met FROM sp GROUP BY kind""")
def slips_found(spark, sf_dir):
    """How many planted slips of each kind an alignment with the text that was right finds."""
    docs = _docs(spark, sf_dir)
    slips = P.plant(docs)
    pairs = P.planted_texts(docs, slips).filter("slips > 0").select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"), F.col("text").alias("text_a"), F.col("was").alias("text_b"))
    fixes = P.real_fixes(pairs).select(F.col("a").alias("file"), F.col("w1").alias("a"), F.col("w2").alias("b"))
    return P.found_by_kind(slips, fixes)


@query(f"{_NEAR}, {_round(1, 3)}, {_GAPS}, {_FIXED} SELECT a, b, w1::INTEGER AS w1, w2::INTEGER AS w2, old, new FROM fr")
def real_fixes(spark, sf_dir):
    """What each document has other than its nearest earlier one, but for signs and case."""
    return P.real_fixes(V.nearest_pairs(_docs(spark, sf_dir)))


@query(f"{_OPS} SELECT a, b, op, i1::INTEGER AS i1, i2::INTEGER AS i2, j1::INTEGER AS j1, j2::INTEGER AS j2 FROM op WHERE op <> 'equal' AND greatest(i2 - i1, j2 - j1) >= 3")
def long_changes(spark, sf_dir):
    """Changes of three words or more of each document against its nearest earlier one."""
    ops = N.operations(N.lowered_words(V.nearest_pairs(_docs(spark, sf_dir)))).filter("op <> 'equal'")
    return P.long_runs(ops, 3).select("a", "b", "op", "i1", "i2", "j1", "j2")
