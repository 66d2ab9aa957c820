"""Queries over pages as nested intervals, with SQL that compares all positions of a page."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumq.operators import brackets as B
from vellumq.operators import intervals as I
from vellumq.operators.graph import settled
from vellumq.plans import sql as S
from vellumq.plans.webpages import _BODY
from vellumq.plans.words import _docs
from vellumq.session import table

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


#: Pages with what the table's pages lack: table cells, words that tags cut, tags that cross, closers too many, and nothing at all.
PLANTED = [
    (-1, "<table><tr><td>one <b>two</b></td><td>three</td></tr></table> after"),
    (-2, "<p>un<b>cut</b>table <i>wo<span>rds</span></i> here<br>not</p>"),
    (-3, "<div><b>first <i>both</b> second</i> third</div></p></div> last"),
    (-4, "</b><p>open <p>again <h2>A <em>head</h2> text"),
    (-5, None),
    (-6, "no tags &amp; no tree"),
]


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "html").unionByName(spark.createDataFrame(PLANTED, "page_id bigint, html string"))


def _listed(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{n}'" for n in names)


_VALUES = ", ".join(f"({i}, " + ("NULL" if h is None else "'" + h.replace("'", "''") + "'") + ")" for i, h in PLANTED)
_TEXT = "replace(replace(replace(replace(replace(piece, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"
_TREE = rf"""pg AS (SELECT page_id, html FROM pages UNION ALL SELECT * FROM (VALUES {_VALUES}) t),
ct AS (SELECT page_id, regexp_extract_all({_BODY.replace("html", "coalesce(html, '')")}, '<[^>]+>|[^<]+') AS c FROM pg), pc AS (SELECT page_id, len(c) AS n, i - 1 AS pos, c[i] AS piece, lower(regexp_extract(c[i], '^</?([A-Za-z][A-Za-z0-9]*)', 1)) AS name FROM ct, unnest(range(1, len(c) + 1)) AS u(i)),
pk AS (SELECT page_id, n, pos, piece, CASE WHEN piece[1] <> '<' THEN 'text' WHEN piece[1:2] = '</' THEN 'close' WHEN name IN ({_listed(I.VOID)}) OR right(piece, 2) = '/>' THEN 'void' ELSE 'open' END AS kind, CASE WHEN piece[1] = '<' THEN name END AS name FROM pc WHERE piece[1] <> '<' OR name <> ''),
s1 AS (SELECT *, sum(CASE kind WHEN 'open' THEN 1 ELSE -1 END) OVER (PARTITION BY page_id, name ORDER BY pos) AS s FROM pk WHERE kind IN ('open', 'close')),
s2 AS (SELECT *, least(min(s) OVER (PARTITION BY page_id, name ORDER BY pos), 0) AS low FROM s1), s3 AS (SELECT *, coalesce(lag(low) OVER (PARTITION BY page_id, name ORDER BY pos), 0) AS was FROM s2),
s4 AS (SELECT *, s - low + CASE kind WHEN 'close' THEN 1 ELSE 0 END AS level FROM s3 WHERE NOT (kind = 'close' AND low < was)), s5 AS (SELECT *, lead(pos) OVER (PARTITION BY page_id, name, level ORDER BY pos) AS close FROM s4),
pr AS (SELECT page_id, pos AS first, name, close, n FROM s5 WHERE kind = 'open'),
el AS (SELECT x.page_id, x.first, x.name, least(coalesce(any_value(x.close), any_value(x.n)), coalesce(min(y.close), any_value(x.n))) AS last FROM pr x LEFT JOIN pr y ON y.page_id = x.page_id AND y.first < x.first AND x.first < y.close GROUP BY x.page_id, x.first, x.name)"""


@query(f"WITH {_TREE} SELECT x.page_id, x.first::INTEGER AS first, x.last::INTEGER AS last, x.name, (count(y.first) + 1)::INTEGER AS depth, max(y.first)::INTEGER AS parent FROM el x LEFT JOIN el y ON y.page_id = x.page_id AND y.first < x.first AND x.first < y.last GROUP BY ALL")
def page_tree(spark, sf_dir):
    """Every element of every page as an interval, with its depth and parent."""
    return I.nodes(settled(I.elements(settled(I.pieces(_pages(spark, sf_dir))))))


_READING = rf"""WITH {_TREE}, br AS (SELECT *, sum(CASE WHEN kind <> 'text' AND name NOT IN ({_listed(I.INLINE)}) THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY pos) AS breaks, CASE kind WHEN 'text' THEN {_TEXT} END AS plain FROM pk),
jn AS (SELECT page_id, pos, plain, coalesce(lag(breaks) OVER w = breaks AND regexp_matches(lag(plain) OVER w, '{S.W}$') AND regexp_matches(plain, '^{S.W}'), false) AS joins FROM br WHERE kind = 'text' WINDOW w AS (PARTITION BY page_id ORDER BY pos)),
tx AS (SELECT page_id, pos, joins, len(regexp_extract_all(plain, '{S.WORD}')) AS words FROM jn WHERE regexp_matches(plain, '[^ \t\n\f\r]')),
up AS (SELECT t.page_id, t.pos, t.joins, t.words, coalesce(string_agg(e.name, '/' ORDER BY e.first), '') AS path, max(e.first) FILTER (WHERE e.name IN ({_listed(I.HEADS)})) AS head, max(e.first) FILTER (WHERE e.name IN ({_listed(I.CELLS)})) AS cell,
  max(e.first) FILTER (WHERE e.name NOT IN ({_listed(I.INLINE)})) AS block FROM tx t LEFT JOIN el e ON e.page_id = t.page_id AND e.first < t.pos AND t.pos < e.last GROUP BY t.page_id, t.pos, t.joins, t.words)"""


@query(f"{_READING} SELECT page_id, pos::INTEGER AS pos, path, head::INTEGER AS head, cell::INTEGER AS cell, block::INTEGER AS block, lag(pos) OVER w IS NULL AS opens, lead(pos) OVER w IS NULL AS closes, joins, words::INTEGER AS words FROM up WINDOW w AS (PARTITION BY page_id, block ORDER BY pos)")
def page_reading(spark, sf_dir):
    """The texts of every page in reading order, with their path, head, cell and block."""
    cut = settled(I.pieces(_pages(spark, sf_dir)))
    return I.reading(cut, settled(I.elements(cut)))


@query(f"{_READING} SELECT path, count(*) AS texts, sum(words)::BIGINT AS words, count(*) FILTER (WHERE joins) AS joined, count(DISTINCT page_id) AS pages FROM up GROUP BY path")
def page_paths(spark, sf_dir):
    """Texts and words under each path."""
    cut = settled(I.pieces(_pages(spark, sf_dir)))
    rows = I.reading(cut, settled(I.elements(cut)))
    return rows.groupBy("path").agg(F.count("*").alias("texts"), F.sum("words").alias("words"), F.count_if("joins").alias("joined"), F.count_distinct("page_id").alias("pages"))


#: Texts with what the documents lack: brackets within brackets, closers too many, escapes, brackets that stay open, and notes alone.
BRACKETED = [(-1, "a (b [c (d)] e) f) g"), (-2, "x \\\\( y (z \\\\) w) v"), (-3, "open [to the (end"), (-4, "(only)[notes]"), (-5, ") ] \\\\"), (-6, None)]
_BRACKETED = ", ".join(f"({i}, " + ("NULL" if t is None else f"'{t}'") + ")" for i, t in BRACKETED)


@query(rf"""WITH dc AS (SELECT doc_id, text FROM documents UNION ALL SELECT * FROM (VALUES {_BRACKETED}) t), ex AS (SELECT doc_id, regexp_extract_all(text, '{B.PIECE}') AS p FROM dc WHERE regexp_matches(text, '[(\[]')),
pc AS (SELECT doc_id, i AS pos, p[i] AS piece FROM ex, unnest(range(1, len(p) + 1)) AS u(i)), sm AS (SELECT *, sum(CASE WHEN piece IN ('(', '[') THEN 1 WHEN piece IN (')', ']') THEN -1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS s FROM pc),
dp AS (SELECT *, s - least(min(s) OVER (PARTITION BY doc_id ORDER BY pos), 0) AS depth FROM sm), ws AS (SELECT *, coalesce(lag(depth) OVER (PARTITION BY doc_id ORDER BY pos), 0) AS was FROM dp),
pt AS (SELECT *, CASE WHEN depth > 0 OR was > 0 THEN sum(CASE WHEN depth > 0 AND was = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) ELSE 0 END AS part FROM ws)
SELECT doc_id, part::INTEGER AS part, max(depth)::INTEGER AS depth, string_agg(piece, '' ORDER BY pos) AS text FROM pt GROUP BY doc_id, part
UNION ALL SELECT doc_id, 0, 0, '' FROM pt GROUP BY doc_id HAVING min(part) > 0 UNION ALL SELECT doc_id, 0, 0, coalesce(text, '') FROM dc WHERE NOT coalesce(regexp_matches(text, '[(\[]'), false)""")
def bracketed_parts(spark, sf_dir):
    """Body and notes of every document, parted by the depth of brackets."""
    return B.parted(_docs(spark, sf_dir).select("doc_id", "text").unionByName(spark.createDataFrame(BRACKETED, "doc_id bigint, text string")))
