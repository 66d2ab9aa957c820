"""Queries over texts aligned by anchors, and SQL that states every step."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumq.operators import align as A
from vellumq.operators import anchored as N
from vellumq.operators import streams as M
from vellumq.operators import unified as U
from vellumq.operators import witness as V
from vellumq.operators.graph import dealt, settled
from vellumq.plans import sql as S
from vellumq.plans.pairs import _PAIRS
from vellumq.plans.words import _docs

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _round(n: int, width: int) -> str:
    """CTEs of one round: blk{n} -> anc{n}, run{n}, fold{n} (runs with weights), kept{n} (the chain), seg{n} (equal words), and blk{n+1}, the gaps."""
    key, join = "a, b, i0, j0", " AND ".join(f"x.{c} = f.{c}" for c in ("a", "b", "i0", "j0"))
    gram = lambda w: f"array_to_string({w}[p:p + {width - 1}], chr(1))"
    best = "list_max(list_transform({}, lambda s: {{'best': s.best, 'k': s.k}}))"
    state = "list_transform({}, lambda s, k: {{'best': s.best, 'k': -k, 'j': s.j}})"
    before = best.format(f"list_filter({state.format('acc')}, lambda s: s.j < x[1].j)")
    return f"""gram{n} AS (SELECT {key}, 0 AS side, p - 1 AS pl, {gram('wa')} AS g FROM blk{n}, unnest(range(1, len(wa) - {width} + 2)) AS u(p) UNION ALL SELECT {key}, 1, p - 1, {gram('wb')} FROM blk{n}, unnest(range(1, len(wb) - {width} + 2)) AS u(p)),
anc{n} AS (SELECT {key}, i0 + max(pl) FILTER (WHERE side = 0) AS i, j0 + max(pl) FILTER (WHERE side = 1) AS j FROM gram{n} GROUP BY {key}, g HAVING count(*) FILTER (WHERE side = 0) = 1 AND count(*) FILTER (WHERE side = 1) = 1),
isl{n} AS (SELECT *, i - row_number() OVER (PARTITION BY {key} ORDER BY i) AS r, j - i AS d FROM anc{n}),
cut{n} AS (SELECT *, CASE WHEN lag(r) OVER w = r AND lag(d) OVER w = d THEN 0 ELSE 1 END AS new FROM isl{n} WINDOW w AS (PARTITION BY {key} ORDER BY i)),
run{n} AS (SELECT {key}, min(i) AS i, min(j) AS j, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY {key} ORDER BY i) AS isle FROM cut{n}) GROUP BY {key}, isle),
fold{n} AS (SELECT {key}, list_reduce(list_prepend([]::STRUCT(i BIGINT, j BIGINT, n BIGINT, best BIGINT, prev BIGINT)[], list_transform(list({{'i': i, 'j': j, 'n': n}} ORDER BY i), lambda r: [{{'i': r.i, 'j': r.j, 'n': r.n, 'best': 0::BIGINT, 'prev': 0::BIGINT}}])),
  lambda acc, x: list_append(acc, {{'i': x[1].i, 'j': x[1].j, 'n': x[1].n, 'best': x[1].n + coalesce({before}.best, 0), 'prev': coalesce(-{before}.k, 0)::BIGINT}})) AS f FROM run{n} GROUP BY {key}),
kept{n} AS (SELECT {key}, (-{best.format(state.format('f'))}.k)::BIGINT AS k FROM fold{n} UNION ALL SELECT x.a, x.b, x.i0, x.j0, f.f[x.k].prev FROM kept{n} x JOIN fold{n} f ON {join} WHERE f.f[x.k].prev > 0),
chn{n} AS (SELECT x.a, x.b, x.i0, x.j0, f.f[x.k].i AS i, f.f[x.k].j AS j, f.f[x.k].n AS n FROM kept{n} x JOIN fold{n} f ON {join}),
ovr{n} AS (SELECT *, coalesce(greatest(0, lag(i + n + {width - 1}) OVER w - i, lag(j + n + {width - 1}) OVER w - j), 0) AS c FROM chn{n} WINDOW w AS (PARTITION BY {key} ORDER BY i)),
seg{n} AS (SELECT {key}, i + c AS i, j + c AS j, n + {width - 1} - c AS n FROM ovr{n}),
bet{n} AS (SELECT {key}, coalesce(lag(i + n) OVER w, i0) AS u, coalesce(lag(j + n) OVER w, j0) AS v, i, j FROM (SELECT * FROM seg{n} UNION ALL SELECT {key}, i0 + len(wa), j0 + len(wb), 0 FROM blk{n}) WINDOW w AS (PARTITION BY {key} ORDER BY i, j)),
blk{n + 1} AS (SELECT x.a, x.b, x.u AS i0, x.v AS j0, f.wa[x.u - f.i0 + 1:x.i - f.i0] AS wa, f.wb[x.v - f.j0 + 1:x.j - f.j0] AS wb FROM bet{n} x JOIN blk{n} f ON {join} WHERE x.i > x.u AND x.j > x.v)"""


_LEAD = "coalesce(list_position(list_transform(range(1, least(len({0}), len({1})) + 1), lambda k: {0}[k] = {1}[k]), false) - 1, least(len({0}), len({1})))"
_WORDS = f"""WITH RECURSIVE {_PAIRS}, wd AS (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '{S.WORD}'), lambda x: lower(x)) AS w FROM documents),
blk1 AS (SELECT near.a, near.b, 0 AS i0, 0 AS j0, x.w AS wa, y.w AS wb FROM near JOIN wd x ON x.doc_id = near.a JOIN wd y ON y.doc_id = near.b)"""
_ALIGNED = f"{_WORDS}, {_round(1, 3)}"


def _ops(rounds: int) -> str:
    """CTEs from the gaps that these rounds leave to op, the op rows."""
    equal = " UNION ALL ".join(f"SELECT a, b, i, j, n FROM seg{n}" for n in range(1, rounds + 1))
    return f"""hd AS (SELECT *, {_LEAD.format('wa', 'wb')} AS head, list_reverse(wa) AS ra, list_reverse(wb) AS rb FROM blk{rounds + 1}), tl AS (SELECT *, least({_LEAD.format('ra', 'rb')}, least(len(wa), len(wb)) - head) AS tail FROM hd),
eq AS ({equal} UNION ALL SELECT a, b, i0, j0, head FROM tl WHERE head > 0 UNION ALL SELECT a, b, i0 + len(wa) - tail, j0 + len(wb) - tail, tail FROM tl WHERE tail > 0 UNION ALL SELECT a, b, len(wa), len(wb), 0 FROM blk1),
st AS (SELECT *, coalesce(lag(i + n) OVER w, 0) AS u, coalesce(lag(j + n) OVER w, 0) AS v FROM eq WINDOW w AS (PARTITION BY a, b ORDER BY i, j, n DESC)),
gr AS (SELECT *, sum(CASE WHEN i > u OR j > v THEN 1 ELSE 0 END) OVER (PARTITION BY a, b ORDER BY i, j, n DESC) AS g FROM st),
op AS (SELECT a, b, CASE WHEN j = v THEN 'delete' WHEN i = u THEN 'insert' ELSE 'replace' END AS op, u AS i1, i AS i2, v AS j1, j AS j2 FROM st WHERE i > u OR j > v
  UNION ALL SELECT a, b, 'equal', min(i), max(i + n), min(j), max(j + n) FROM gr WHERE n > 0 GROUP BY a, b, g)"""


_GAPS = f"{_round(2, 1)}, {_ops(2)}"
_OPS = f"{_ALIGNED}, {_GAPS}"

#: Two texts each for a rewrite, which no document needs: a numeral that becomes an item, a stop before a deletion, and marks on one side that the other lacks.
PLANTED = [
    (-1, -2, "She named her husband VIII. The second son went off to sea", "She named her husband.\n+ The second son went off to sea"),
    (-3, -4, "all goes well here. by the margin note of hers.\nUnder the tree they sat down", "all goes well here.\nUnder the tree they sat down"),
    (-5, -6, "one two three four\nold words out\n2. apples in the low barn", "one two three four\n+ pears in the low barn"),
    (-7, -8, "the first line stands\nanother stands too", ""),
]
_TEXT = lambda t: " || chr(10) || ".join("'" + x + "'" for x in t.split("\n"))
_LINE_MARK = "regexp_extract(x, '^[ \\t]*([+=]) ', 1)"
_STREAM = f"""flatten(list_transform(string_split(coalesce(@, ''), chr(10)), lambda x: list_prepend(chr(2) || CASE {_LINE_MARK} WHEN '' THEN '¶' ELSE {_LINE_MARK} END, regexp_extract_all(regexp_replace(x, '^[ \\t]*[+=] ', ''), '{M.TOKEN.replace("'", "''")}'))))"""
_STREAMS = f"""WITH RECURSIVE {_PAIRS}, tx AS (SELECT near.a, near.b, x.text AS ta, y.text AS tb FROM near JOIN documents x ON x.doc_id = near.a JOIN documents y ON y.doc_id = near.b UNION ALL SELECT * FROM (VALUES {", ".join(f"({a}, {b}, {_TEXT(x)}, {_TEXT(y)})" for a, b, x, y in PLANTED)}) t),
blk1 AS (SELECT a, b, 0 AS i0, 0 AS j0, {_STREAM.replace("@", "ta")} AS wa, {_STREAM.replace("@", "tb")} AS wb FROM tx), {_round(1, 3)}, {_GAPS},
sq AS (SELECT op.*, row_number() OVER (PARTITION BY a, b ORDER BY i1, j1, i2, j2) - 1 AS seq, CASE op WHEN 'equal' THEN wa[i1 + 1:i1 + 1] ELSE wa[i1 + 1:i2] END AS src, CASE op WHEN 'equal' THEN wb[j1 + 1:j1 + 1] ELSE wb[j1 + 1:j2] END AS tgt FROM op JOIN blk1 USING (a, b)),
ns AS (SELECT *, coalesce(op = 'delete' AND len(src) = 1 AND regexp_matches(src[1], '{M.NUMERAL}') AND lead(op) OVER w = 'equal' AND lead(i2 - i1) OVER w = 1 AND lead(src[1]) OVER w IN ('.', ')') AND lead(op, 2) OVER w = 'insert' AND lead(tgt[1], 2) OVER w = chr(2) || '+', false) AS b0 FROM sq WINDOW w AS (PARTITION BY a, b ORDER BY seq)),
np AS (SELECT *, CASE WHEN b0 THEN 0 WHEN lag(b0) OVER w THEN 1 WHEN lag(b0, 2) OVER w THEN 2 ELSE -1 END AS pl, lag(i1, 2) OVER w AS u, lag(src, 2) OVER w AS s2, lag(src) OVER w AS s1, lead(tgt) OVER w AS t1, lead(j1) OVER w AS v1, lead(j2) OVER w AS v2 FROM ns WINDOW w AS (PARTITION BY a, b ORDER BY seq)),
nu AS (SELECT a, b, seq, CASE pl WHEN 0 THEN 'insert' WHEN 2 THEN 'replace' ELSE op END AS op, CASE pl WHEN 2 THEN u ELSE i1 END AS i1, CASE pl WHEN 0 THEN i1 ELSE i2 END AS i2, CASE pl WHEN 0 THEN v1 ELSE j1 END AS j1, CASE pl WHEN 0 THEN v2 ELSE j2 END AS j2,
  CASE pl WHEN 0 THEN [] WHEN 2 THEN list_concat(s2, s1) ELSE src END AS src, CASE pl WHEN 0 THEN t1 ELSE tgt END AS tgt FROM np WHERE pl <> 1),
mv AS (SELECT *, coalesce(op = 'delete' AND lag(op) OVER w = 'equal' AND lead(op) OVER w = 'equal' AND NOT regexp_matches(src[1], '^[\\p{{L}}\\p{{N}}_\\x02]') AND src[1] = lead(src[1]) OVER w, false) AS m FROM nu WINDOW w AS (PARTITION BY a, b ORDER BY seq)),
ms AS (SELECT *, m::INTEGER AS o, coalesce(lead(m) OVER w, false)::INTEGER AS n1, coalesce(lag(m) OVER w, false)::INTEGER AS p1 FROM mv WINDOW w AS (PARTITION BY a, b ORDER BY seq)),
mo AS (SELECT * FROM (SELECT a, b, seq, op, i1 + o + p1 AS i1, i2 + o + n1 AS i2, j1 + o + p1 AS j1, j2 + o + n1 AS j2, CASE WHEN m THEN list_concat(src[2:], src[1:1]) ELSE src END AS src, tgt FROM ms) WHERE i2 > i1 OR j2 > j1),
mk AS (SELECT *, list_filter(list_transform(src, lambda x, k: CASE WHEN x[1] = chr(2) THEN k - 1 END), lambda k: k IS NOT NULL) AS ks, list_filter(list_transform(tgt, lambda x, k: CASE WHEN x[1] = chr(2) THEN k - 1 END), lambda k: k IS NOT NULL) AS kt FROM mo),
mc AS (SELECT *, op <> 'equal' AND len(ks) > 0 AND len(kt) > 0 AND len(ks) <> len(kt) AS cut, ks[greatest(len(ks) - len(kt), 0) + 1] AS si, kt[greatest(len(kt) - len(ks), 0) + 1] AS ti FROM mk),
rw AS (SELECT * FROM (SELECT a, b, op, i1, i2, j1, j2, src, tgt FROM mc WHERE NOT cut UNION ALL SELECT a, b, 'replace', i1, i1 + si, j1, j1 + ti, src[1:si], tgt[1:ti] FROM mc WHERE cut UNION ALL SELECT a, b, 'replace', i1 + si, i2, j1 + ti, j2, src[si + 1:], tgt[ti + 1:] FROM mc WHERE cut) WHERE i2 > i1 OR j2 > j1),
nr AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY i1, j1, i2, j2) - 1 AS seq FROM rw)"""


@query(f"{_ALIGNED} SELECT near.a, near.b, coalesce(r.anchors, 0)::BIGINT AS anchors, coalesce(r.runs, 0)::BIGINT AS runs, coalesce(c.chain, 0)::BIGINT AS chain FROM near LEFT JOIN (SELECT a, b, sum(n) AS anchors, count(*) AS runs FROM run1 GROUP BY a, b) r USING (a, b) LEFT JOIN (SELECT a, b, sum(n) AS chain FROM chn1 GROUP BY a, b) c USING (a, b)")
def anchor_chains(spark, sf_dir):
    """Anchors of each document and its nearest earlier one, and how many of them rise together."""
    return N.summary(N.lowered_words(V.nearest_pairs(_docs(spark, sf_dir))))


@query(f"{_OPS} SELECT a, b, (row_number() OVER (PARTITION BY a, b ORDER BY i1, j1, i2, j2) - 1)::INTEGER AS seq, op, i1::INTEGER AS i1, i2::INTEGER AS i2, j1::INTEGER AS j1, j2::INTEGER AS j2 FROM op")
def anchored_ops(spark, sf_dir):
    """Equal words and changes of each document against its nearest earlier one, aligned by anchors."""
    return N.operations(N.lowered_words(V.nearest_pairs(_docs(spark, sf_dir))))


@query(f"{_OPS} SELECT op, count(*) AS n, sum(i2 - i1)::BIGINT AS words_a, sum(j2 - j1)::BIGINT AS words_b, count(DISTINCT b) AS pairs FROM op GROUP BY op")
def anchored_totals(spark, sf_dir):
    """How many words each kind of change has."""
    found = N.operations(N.lowered_words(V.nearest_pairs(_docs(spark, sf_dir))))
    return found.groupBy("op").agg(F.count("*").alias("n"), F.sum(F.col("i2") - F.col("i1")).alias("words_a"), F.sum(F.col("j2") - F.col("j1")).alias("words_b"), F.count_distinct("b").alias("pairs"))


@query(f"""{_STREAMS} SELECT a, b, seq::INTEGER AS seq, CASE WHEN op = 'equal' THEN op WHEN i1 = i2 THEN 'insert' WHEN j1 = j2 THEN 'delete' ELSE 'replace' END AS op, i1::INTEGER AS i1, i2::INTEGER AS i2, j1::INTEGER AS j1, j2::INTEGER AS j2, array_to_string(src, ' ') AS src, array_to_string(tgt, ' ') AS tgt FROM nr WHERE op <> 'equal'
UNION ALL SELECT a, b, -1, 'equal', count(*)::INTEGER, sum(i2 - i1)::INTEGER, sum(j2 - j1)::INTEGER, 0, '', '' FROM rw WHERE op = 'equal' GROUP BY a, b""")
def stream_changes(spark, sf_dir):
    """Changes of tokens and block marks of each document against its nearest earlier one after the rewrites, and of four planted pairs; for each pair what is equal, as one row of counts."""
    pairs = V.nearest_pairs(_docs(spark, sf_dir)).unionByName(spark.createDataFrame(PLANTED, "a bigint, b bigint, text_a string, text_b string"))
    own = settled(M.streams(pairs))
    rows = settled(M.rewritten(N.operations(dealt(own, "a", "b")), own))
    shown = rows.filter("op <> 'equal'").select("a", "b", "seq", "op", "i1", "i2", "j1", "j2", F.array_join("src", " ").alias("src"), F.array_join("tgt", " ").alias("tgt"))
    zero, none = F.lit(0), F.lit("")
    same = rows.filter("op = 'equal'").groupBy("a", "b").agg(F.count("*").cast("int").alias("i1"), F.sum(F.col("i2") - F.col("i1")).cast("int").alias("i2"), F.sum(F.col("j2") - F.col("j1")).cast("int").alias("j1"))
    return shown.unionByName(same.select("a", "b", F.lit(-1).alias("seq"), F.lit("equal").alias("op"), "i1", "i2", "j1", zero.alias("j2"), none.alias("src"), none.alias("tgt")))


@query(f"""{_OPS} SELECT a, b, p::INTEGER AS p, (j1 + round_even((p - i1) / greatest(i2 - i1, 1) * (j2 - j1), 0))::INTEGER AS q FROM op, unnest(range(i1, i2)) AS u(p)""")
def position_map(spark, sf_dir):
    """Where every word of a document stands in its nearest later copy."""
    return A.whole_map(N.operations(N.lowered_words(V.nearest_pairs(_docs(spark, sf_dir)))))


_PART = "list_transform({1}[{2} + 1:{3}], lambda x: '{0}' || x)"
_RANGE = "CASE WHEN {1} - {0} = 1 THEN ({0} + 1)::VARCHAR ELSE (CASE WHEN {1} = {0} THEN {0} ELSE {0} + 1 END)::VARCHAR || ',' || ({1} - {0})::VARCHAR END"
_HUNKS = f"""WITH RECURSIVE {_PAIRS}, wd AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
blk1 AS (SELECT near.a, near.b, 0 AS i0, 0 AS j0, x.w AS wa, y.w AS wb FROM near JOIN wd x ON x.doc_id = near.a JOIN wd y ON y.doc_id = near.b), {_round(1, 1)}, {_ops(1)},
oh AS (SELECT *, sum(CASE WHEN op = 'equal' AND i2 - i1 > 6 THEN 1 ELSE 0 END) OVER (PARTITION BY a, b ORDER BY i1, j1, i2, j2) AS h FROM op),
hk AS (SELECT a, b, row_number() OVER (PARTITION BY a, b ORDER BY h) - 1 AS hunk, list({{'i1': i1, 'i2': i2, 'j1': j1, 'j2': j2}} ORDER BY i1, i2, j1, j2) AS cs FROM oh WHERE op <> 'equal' GROUP BY a, b, h),
hr AS (SELECT hk.a, hk.b, hunk, cs, wa, wb, least(3, cs[1].i1, cs[1].j1) AS bf, least(3, len(wa) - cs[-1].i2, len(wb) - cs[-1].j2) AS af FROM hk JOIN blk1 ON blk1.a = hk.a AND blk1.b = hk.b),
hb AS (SELECT *, cs[1].i1 - bf AS i1, cs[-1].i2 + af AS i2, cs[1].j1 - bf AS j1, cs[-1].j2 + af AS j2 FROM hr)"""


@query(f"""{_HUNKS} SELECT a, b, hunk::INTEGER AS hunk, '@@ -' || {_RANGE.format('i1', 'i2')} || ' +' || {_RANGE.format('j1', 'j2')} || ' @@' AS header,
array_to_string(list_concat({_PART.format(' ', 'wa', 'i1', 'cs[1].i1')}, flatten(list_transform(cs, lambda c, k: list_concat(list_concat({_PART.format('-', 'wa', 'c.i1', 'c.i2')}, {_PART.format('+', 'wb', 'c.j1', 'c.j2')}), {_PART.format(' ', 'wa', 'c.i2', 'coalesce(cs[k + 1].i1, i2)')})))), chr(10)) AS body FROM hb""")
def unified_hunks(spark, sf_dir):
    """The unified difference of each document and its nearest earlier one, three lines of context."""
    own = settled(U.lines(V.nearest_pairs(_docs(spark, sf_dir))))
    return U.hunks(own, N.operations(dealt(own, "a", "b"), (1,))).select("a", "b", "hunk", "header", F.array_join("body", "\n").alias("body"))


@query(f"WITH {_PAIRS} SELECT near.a, near.b, sha256(coalesce(text, '')) AS sha256 FROM near JOIN documents ON doc_id = near.b")
def unified_patched(spark, sf_dir):
    """What each document's difference makes of its nearest earlier one: the document."""
    own = settled(U.lines(V.nearest_pairs(_docs(spark, sf_dir))))
    return U.patched(own, U.hunks(own, N.operations(dealt(own, "a", "b"), (1,)))).select("a", "b", F.sha2("text", 256).alias("sha256"))
