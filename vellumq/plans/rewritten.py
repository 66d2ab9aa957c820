"""Queries over edits of pages' trees, with SQL that states each edit's verdict and the pages after the edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumq.operators import edits as E
from vellumq.operators import intervals as I
from vellumq.operators.graph import settled
from vellumq.plans import trees
from vellumq.session import table

QUERIES, ORACLES = {}, {}


def query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


#: Pages and edits that the tables' own pages don't suggest: edits at tags, outside blocks, across blocks, on one another, twice, and on blocks of other names.
PLANTED = [
    *trees.PLANTED,
    (-7, "<div><p>One two.</p> <p>Three <i>four<b> five</b></i> six</p><p>seven</p><h2>Eight</h2></div>"),
    (-8, "<ul><li>a</li><li>b c<br>d</li></ul><p>e<p>f"),
    (-9, "<div>g<p>h</p></div><p>i</p>j<p>k</p>"),
]
ASKED = [
    (-7, 1, "split", 10, None, None), (-7, 2, "split", 8, None, None), (-7, 3, "split", 10, None, None), (-7, 4, "heading", 2, None, 2), (-7, 5, "quote", 2, 17, None), (-7, 6, "merge", 17, None, None), (-7, 7, "split", 0, None, None),
    (-7, 8, "split", 900, None, None), (-7, 9, "heading", 17, None, 1), (-8, 1, "quote", 2, 14, None), (-8, 2, "merge", 2, None, None), (-8, 3, "heading", 5, None, 2), (-8, 4, "merge", 11, None, None), (-8, 5, "quote", 5, 2, None), (-8, 6, "quote", 5, 9999, None),
    (-9, 1, "heading", 1, None, 4), (-9, 2, "merge", 3, None, None), (-9, 3, "split", 8, None, None), (-9, 4, "quote", 3, 3, None), (-9, 5, "merge", 7, None, None), (-9, 6, "heading", 7, None, 5), (-9, 7, "split", 3, None, None),
]


def _literal(x) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)


_ASKED = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in ASKED)
_PAGES = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in PLANTED)
_BLOCK = f"NOT IN ({trees._listed(I.INLINE)})"
_JUDGED = rf"""{trees._READING.replace(trees._VALUES, _PAGES)},
rd AS (SELECT *, lag(pos) OVER w IS NULL AS opens, lead(pos) OVER w IS NULL AS closes FROM up WINDOW w AS (PARTITION BY page_id, block ORDER BY pos)),
el2 AS (SELECT e.page_id, e.first, e.last, e.name, (SELECT max(o.first) FROM el o WHERE o.page_id = e.page_id AND o.first < e.first AND e.first < o.last) AS parent,
  coalesce((SELECT k.name = e.name FROM pk k WHERE k.page_id = e.page_id AND k.pos = e.last AND k.kind = 'close'), false) AS closed,
  EXISTS (SELECT 1 FROM el o WHERE o.page_id = e.page_id AND o.name {_BLOCK} AND e.first < o.first AND o.first < e.last) AS holds,
  CASE WHEN EXISTS (SELECT 1 FROM pk k WHERE k.page_id = e.page_id AND k.pos = e.last) THEN (SELECT min(k.pos) FROM pk k WHERE k.page_id = e.page_id AND k.pos > e.last AND (k.kind <> 'text' OR regexp_matches(k.piece, '[^ \t\n\f\r]'))) END AS next FROM el e WHERE e.name {_BLOCK}),
rw AS (SELECT page_id, pos, lag(name) OVER (PARTITION BY page_id ORDER BY pos) IS NOT DISTINCT FROM 'br' AS broken, kind, regexp_matches(piece, '[.!?][ \t\n\f\r]*$') AS stopped FROM pk),
sg AS (SELECT d.page_id, d.pos, d.opens, d.closes, d.words, w.broken, w.stopped, (SELECT min(o.pos) FROM rd o WHERE o.page_id = d.page_id AND o.opens AND o.pos > d.pos) AS begun FROM rd d JOIN rw w ON w.page_id = d.page_id AND w.pos = d.pos),
ed AS (SELECT page_id, pos * 4 AS edit_id, 'split' AS kind, pos AS spot, NULL AS upto, NULL AS level FROM sg WHERE broken UNION ALL SELECT page_id, pos * 4 + 1, 'heading', pos, NULL, 3 FROM sg WHERE opens AND closes AND words <= 4
  UNION ALL SELECT page_id, pos * 4 + 2, 'quote', pos, begun, NULL FROM sg WHERE opens AND words >= 20 AND begun IS NOT NULL UNION ALL SELECT page_id, pos * 4 + 3, 'merge', pos, NULL, NULL FROM sg WHERE closes AND NOT stopped
  UNION ALL SELECT page_id, 1000000 + edit_id, kind, spot, upto, level FROM (VALUES {_ASKED}) t(page_id, edit_id, kind, spot, upto, level)),
j1 AS (SELECT d.*, a.pos IS NOT NULL AS there, a.block, a.opens, u.pos IS NOT NULL AS there2, u.block AS b2, b.last, b.name, b.parent, b.closed, b.holds, b.next, c.last AS last2, c.parent AS parent2, c.closed AS closed2, n.last AS last3, n.name AS name3, n.closed AS closed3
  FROM ed d LEFT JOIN rd a ON a.page_id = d.page_id AND a.pos = d.spot LEFT JOIN el2 b ON b.page_id = d.page_id AND b.first = a.block LEFT JOIN rd u ON u.page_id = d.page_id AND u.pos = d.upto LEFT JOIN el2 c ON c.page_id = d.page_id AND c.first = u.block
  LEFT JOIN el2 n ON n.page_id = d.page_id AND n.first = b.next),
j2 AS (SELECT *, CASE WHEN NOT there OR (kind = 'quote' AND NOT there2) THEN 'no text' WHEN block IS NULL OR (kind = 'quote' AND b2 IS NULL) THEN 'no block' WHEN kind = 'split' AND name NOT IN ({trees._listed(E.CUT)}) THEN 'no paragraph' WHEN kind = 'split' AND opens THEN 'first'
  WHEN kind = 'heading' AND name NOT IN ({trees._listed(E.HEADED)}) THEN 'no paragraph' WHEN kind = 'heading' AND holds THEN 'holds blocks' WHEN kind = 'quote' AND (parent IS DISTINCT FROM parent2 OR b2 < block) THEN 'crosses'
  WHEN kind <> 'split' AND (NOT closed OR (kind = 'quote' AND NOT closed2)) THEN 'open' WHEN kind = 'merge' AND name3 IS NULL THEN 'nothing next' WHEN kind = 'merge' AND name3 <> name THEN 'other name' WHEN kind = 'merge' AND NOT closed3 THEN 'open' END AS bad FROM j1),
j3 AS (SELECT *, CASE WHEN bad IS NULL THEN block END AS lo, CASE WHEN bad IS NULL THEN CASE kind WHEN 'quote' THEN last2 WHEN 'merge' THEN last3 ELSE last END END AS hi FROM j2),
vd AS (SELECT x.*, CASE WHEN bad IS NOT NULL THEN bad WHEN EXISTS (SELECT 1 FROM j3 y WHERE y.page_id = x.page_id AND y.bad IS NULL AND (y.lo < x.lo OR (y.lo = x.lo AND y.hi > x.hi)) AND y.hi >= x.lo) THEN 'overlaps'
  WHEN EXISTS (SELECT 1 FROM j3 y WHERE y.page_id = x.page_id AND y.lo = x.lo AND y.hi = x.hi AND y.edit_id < x.edit_id AND (x.kind <> 'split' OR (y.kind = 'split' AND y.spot = x.spot)
    OR (y.kind <> 'split' AND y.edit_id = (SELECT min(z.edit_id) FROM j3 z WHERE z.page_id = x.page_id AND z.lo = x.lo AND z.hi = x.hi)))) THEN 'clashes' END AS why FROM j3 x)"""


def _parts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html").unionByName(spark.createDataFrame(PLANTED, "page_id bigint, html string"))
    cut = settled(I.pieces(pages))
    tree = settled(I.elements(cut))
    texts = settled(I.reading(cut, tree))
    asked = spark.createDataFrame(ASKED, E.EDITS).withColumn("edit_id", F.col("edit_id") + 1000000)
    return cut, tree, settled(E.judged(cut, texts, settled(E.blocks(cut, tree)), E.proposed(cut, texts).unionByName(asked)))


@query(f"{_JUDGED} SELECT page_id, edit_id::BIGINT AS edit_id, kind, spot::INTEGER AS spot, upto::INTEGER AS upto, block::INTEGER AS block, lo::INTEGER AS lo, hi::INTEGER AS hi, coalesce(why, 'made') AS verdict FROM vd")
def page_edit_verdicts(spark, sf_dir):
    """Every edit that a page's texts suggest, the block it falls on, what it touches, and whether it is made or why not."""
    verdicts = _parts(spark, sf_dir)[2]
    return verdicts.select("page_id", "edit_id", "kind", "spot", "upto", "block", "lo", "hi", F.coalesce("why", F.lit("made")).alias("verdict"))


@query(rf"""{_JUDGED}, md AS (SELECT * FROM vd WHERE why IS NULL),
ch AS (SELECT page_id, lo AS pos, '' AS before, '<h' || level || '>' AS instead, '' AS after FROM md WHERE kind = 'heading' UNION ALL SELECT page_id, hi, '', '</h' || level || '>', '' FROM md WHERE kind = 'heading'
  UNION ALL SELECT page_id, lo, '<blockquote>', NULL, '' FROM md WHERE kind = 'quote' UNION ALL SELECT page_id, hi, '', NULL, '</blockquote>' FROM md WHERE kind = 'quote'
  UNION ALL SELECT page_id, last, '', ' ', '' FROM md WHERE kind = 'merge' UNION ALL SELECT page_id, next, '', '', '' FROM md WHERE kind = 'merge'
  UNION ALL SELECT m.page_id, m.spot, string_agg('</' || e.name || '>', '' ORDER BY e.first DESC) || string_agg('<' || e.name || '>', '' ORDER BY e.first), NULL, '' FROM md m JOIN el e ON e.page_id = m.page_id AND m.block <= e.first AND e.first < m.spot AND m.spot < e.last WHERE m.kind = 'split' GROUP BY m.page_id, m.spot),
nw AS (SELECT k.page_id, k.pos, coalesce(c.before, '') || coalesce(c.instead, k.piece) || coalesce(c.after, '') AS piece, c.pos IS NOT NULL AS changed FROM pk k LEFT JOIN ch c ON c.page_id = k.page_id AND c.pos = k.pos)
SELECT page_id, count(*) AS pieces, count(*) FILTER (WHERE changed) AS changed, string_agg(piece, '' ORDER BY pos) AS html FROM nw GROUP BY page_id""")
def pages_edited(spark, sf_dir):
    """Every page that has pieces after its edits, with the number of pieces that they changed."""
    cut, tree, verdicts = _parts(spark, sf_dir)
    edited = settled(E.applied(cut, tree, verdicts))
    counts = edited.groupBy("page_id").agg(F.count("*").alias("pieces"), F.count("edit_id").alias("changed"))
    return counts.join(E.rewritten(edited), "page_id")
