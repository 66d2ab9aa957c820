"""Queries over references in their context, with SQL that states every one of them."""

from __future__ import annotations

from vellumq.operators import contexts as C
from vellumq.operators.graph import settled
from vellumq.plans.words import _docs

QUERIES, ORACLES = {}, {}


def query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


#: The verses of the chapters that the texts below name.
CHAPTERS = """Genesis 1 31;Genesis 2 25;Genesis 3 24;Exodus 20 26;1 Samuel 14 52;Psalms 23 6;Psalms 32 11;Psalms 109 31;Psalms 119 176;Song of Solomon 2 17;Isaiah 10 34;Isaiah 27 13;Isaiah 55 13;Hosea 4 19;Daniel 12 13;
Luke 16 31;John 3 36;Romans 5 21;Romans 8 39;Romans 12 21;1 Corinthians 7 40;2 Corinthians 5 21;1 Timothy 2 15;2 Timothy 1 18;2 Timothy 2 26;Philemon 1 25;Jude 1 25;3 John 1 14""".replace("\n", "")
_ROWS = [(b, int(c), int(n)) for b, c, n in (x.rsplit(" ", 2) for x in CHAPTERS.split(";"))]
#: Texts with references, as the documents hold none: partial ones, lists, chains, ranges, numbered names, new lines, what isn't a reference, and what isn't there.
PLANTED = [
    (-1, "As Gen. ii. 7 has it, and ver. 9; so also chap. 1. 3, and verses 4-6."),
    (-2, "Isa. 10. 17. and 27. 4. and 55. 13. So too Hos. 4. 17, 18; 3. 5 and Luke 16: 19-21, 25."),
    (-3, "Compare Ps. 32, 109 and Ps. 119. 9, 11; then Jude 5, 7, Philem. 9 and Philemon 1. 10 with 3 John 4."),
    (-4, "1 Sam 14 27. But 2 Cor. 5. 14, 15, 1 Tim. ii. 6, and II. Tim. i. 9–12; ii. 3: they read Ps 23 5 times, Gen 1 and 2."),
    (-5, "Ps. 23. 4, 5\nver. 6 is on a new line\nRom. 8. 28, xii. 1 & v. 2\n3 Sam. 4. 5, 4 Cor. 1. 1"),
    (-6, "Gen. 99. 3 and ver. 2, Ps. 23. 7, Exod. 20. 12-40, Luke 16. 25-19, Song of Solomon 2. 3, Song of Songs ii. 4, Cant. 2. 5"),
    (-7, "Genuine 4. 5, begins Mark 3rd, Job was 4. John said 3 things; John 3. 16ff, Dan. xii. 2, 2nd. Isa 10:1234 and 27:4"),
    (-8, "ver. 3 before any; Rom. v. 19 after; Chap. 8. 28 and ch. viii. 30; vv. 31, 32. Ch. 99. 1; John. III. 16: Joh. iii. 17"),
    (-9, None),
    (-10, ""),
]
_INT = "try_cast({} AS INTEGER)"


def _text(x) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


def _in(x: str, values) -> str:
    return f"{x} IN ({', '.join(map(_text, values))})"


def _letter(x: str) -> str:
    return f"CASE lower({x}) WHEN 'i' THEN 1 WHEN 'v' THEN 5 WHEN 'x' THEN 10 WHEN 'l' THEN 50 WHEN 'c' THEN 100 ELSE 0 END"


_ROMAN = C.ROMAN.replace("(?=.)", "")
_VALUE = f"list_sum(list_transform(range(1, length(w) + 1), lambda i: CASE WHEN {_letter('w[i]')} < {_letter('w[i + 1]')} THEN -1 ELSE 1 END * {_letter('w[i]')}))::INTEGER"
_O = "OVER (PARTITION BY doc_id ORDER BY pos)"
_R = "OVER (PARTITION BY doc_id, run ORDER BY pos)"
_A = "OVER (PARTITION BY doc_id, run)"
_NOTED = rf"""nm AS (SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(_text, r)) + ')' for r in C.forms())}) t(form, plain, base)),
ch AS (SELECT * FROM (VALUES {', '.join(f"({_text(b)}, {c}, {n})" for b, c, n in _ROWS)}) t(book, chapter, n)),
dc AS (SELECT doc_id, text FROM documents UNION ALL SELECT * FROM (VALUES {', '.join(f'({i}, {_text(t)})' for i, t in PLANTED)}) t),
ct AS (SELECT doc_id, regexp_extract_all(text, '{C.SIGN}') AS p FROM dc WHERE regexp_matches(text, '{C.beginnings()}')),
t0 AS (SELECT doc_id, i AS pos, p[i] AS piece, regexp_replace(p[i], '^[ \t\r]+', '') AS w FROM ct, unnest(range(1, len(p) + 1)) AS u(i)),
t1 AS (SELECT *, length(w) AS len, (sum(length(piece)) {_O} - length(w))::INTEGER AS start, sum((w = chr(10))::INTEGER) {_O} AS line, length(piece) = length(w) AS tight, lag(w) {_O} AS p1, lag(w, 2) {_O} AS p2, lead(w) {_O} AS n1 FROM t0),
t2 AS (SELECT t1.*, plain, base, CASE WHEN {_in('p1', C.ORDINAL)} THEN p1 WHEN p1 = '.' AND {_in('p2', C.ORDINAL)} THEN p2 END AS o FROM t1 LEFT JOIN nm ON regexp_matches(w, '^\p{{Lu}}') AND form = lower(w)),
t3 AS (SELECT *, CASE WHEN base IS NOT NULL AND {_in("(CASE WHEN o IN ('1', '2', '3') THEN o ELSE length(o)::VARCHAR END) || ' ' || base", [b for b in C.R.BOOKS if b[0] in '123'])} THEN (CASE WHEN o IN ('1', '2', '3') THEN o ELSE length(o)::VARCHAR END) || ' ' || base END AS numbered,
  w IN ('Solomon', 'Songs') AND coalesce(p1 = 'of' AND p2 = 'Song', false) AS song FROM t2),
t4 AS (SELECT *, CASE WHEN song THEN 'Song of Solomon' ELSE coalesce(numbered, plain) END AS book, CASE WHEN song THEN 2 WHEN numbered IS NOT NULL THEN CASE WHEN p1 = '.' THEN 2 ELSE 1 END ELSE 0 END AS extra FROM t3),
t5 AS (SELECT *, coalesce(lead(extra) {_O} >= 1, false) OR coalesce(lead(extra, 2) {_O} >= 2, false) AS part, regexp_matches(w, '^[0-9]{{1,3}}$') AND NOT coalesce(lead(tight) {_O} AND regexp_matches(n1, '^\p{{L}}'), false) AS digits,
  lag(book) {_O} IS NOT NULL OR (coalesce(p1 = '.', false) AND lag(book, 2) {_O} IS NOT NULL) AS behind, w <> '' AND regexp_matches(lower(w), '{_ROMAN}') AS rom FROM t4),
t6 AS (SELECT *, rom AND (behind OR (w = lower(w) AND coalesce({_in('n1', C.STOP)} AND lead(digits, 2) {_O}, false))) AS numeral,
  CASE WHEN behind THEN false WHEN {_in('lower(w)', C.VERSE)} THEN coalesce(lead(digits) {_O} OR (n1 = '.' AND lead(digits, 2) {_O}), false) WHEN {_in('lower(w)', C.CHAPTER)} THEN coalesce(lead(digits OR rom) {_O} OR (n1 = '.' AND lead(digits OR rom, 2) {_O}), false) ELSE false END AS leads FROM t5),
t7 AS (SELECT *, CASE WHEN part THEN 'other' WHEN book IS NOT NULL THEN 'name' WHEN leads THEN 'lead' WHEN digits OR numeral THEN 'num' WHEN {_in('lower(w)', C.SEPARATOR)} THEN 'sep' ELSE 'other' END AS kind FROM t6),
sg AS (SELECT *, CASE WHEN kind = 'num' THEN CASE WHEN digits THEN {_INT.format('w')} ELSE {_VALUE} END END AS value, sum((kind NOT IN ('num', 'sep'))::INTEGER) {_O} AS run, lag(kind) {_O} AS k1, lag(kind, 2) {_O} AS k2, lag(kind, 3) {_O} AS k3,
  CASE extra WHEN 0 THEN start WHEN 1 THEN lag(start) {_O} ELSE lag(start, 2) {_O} END AS begin FROM t7),
hd AS (SELECT doc_id, run, CASE WHEN kind = 'name' THEN 'name' WHEN {_in('lower(w)', C.VERSE)} THEN 'verse' ELSE 'chapter' END AS head, book, begin AS start FROM sg WHERE kind IN ('name', 'lead')),
n1 AS (SELECT s.doc_id, s.run, s.pos, s.line, s.n1 AS next, s.value, s.start + s.len AS stop, h.head, h.book, h.start, row_number() OVER (PARTITION BY s.doc_id, s.run ORDER BY s.pos) AS i,
  CASE WHEN k1 IN ('num', 'name', 'lead') THEN '' WHEN k2 IN ('num', 'name', 'lead') THEN lower(p1) WHEN k2 = 'sep' AND k3 IN ('num', 'name', 'lead') THEN lower(p2) || ' ' || lower(p1) ELSE 'x' END AS joint FROM sg s JOIN hd h ON h.doc_id = s.doc_id AND h.run = s.run WHERE s.kind = 'num'),
n2 AS (SELECT *, min((CASE WHEN i = 1 THEN joint IN ('', '.') ELSE {_in('joint', C.BETWEEN)} OR (joint = '' AND i = 2 AND coalesce(next IN ('.', ',', ';', ')'), false)) END)::INTEGER) {_R} AS fits FROM n1),
n3 AS (SELECT * EXCLUDE (stop), lead(joint) {_R} AS then_, CASE WHEN {_in(f'lead(joint) {_R}', C.DASH)} THEN lead(value) {_R} END AS upto, CASE WHEN {_in(f'lead(joint) {_R}', C.DASH)} THEN lead(stop) {_R} ELSE stop END AS stop FROM n2 WHERE fits = 1),
n4 AS (SELECT *, coalesce({_in('book', C.ONE_CHAPTER)} AND NOT (first_value(value) {_R} = 1 AND coalesce({_in(f'first_value(then_) {_R}', C.STOP)}, false)), false) AS single FROM n3),
n5 AS (SELECT *, CASE WHEN head = 'verse' OR single THEN false WHEN i = 1 OR joint[1] = ';' THEN true ELSE coalesce({_in('then_', C.STOP)}, false) AND NOT {_in('joint', (*C.STOP, *C.DASH, ''))} END AS opens FROM n4),
n6 AS (SELECT * EXCLUDE (book), last_value(book IGNORE NULLS) OVER (PARTITION BY doc_id, line ORDER BY pos) AS book, last_value(CASE WHEN opens THEN value WHEN single THEN 1 END IGNORE NULLS) OVER (PARTITION BY doc_id, line ORDER BY pos) AS chapter,
  opens AND coalesce(NOT lead(opens) {_R} AND NOT {_in('then_', C.DASH)}, false) AS absorbed FROM n5),
n7 AS (SELECT n6.*, a.n AS verses, b.n IS NOT NULL AS also FROM n6 LEFT JOIN ch a ON a.book = n6.book AND a.chapter = n6.chapter LEFT JOIN ch b ON b.book = n6.book AND b.chapter = n6.value WHERE NOT {_in('joint', C.DASH)} AND n6.book IS NOT NULL),
n8 AS (SELECT *, coalesce(CASE WHEN opens THEN verses IS NOT NULL AND coalesce(upto > value, true) ELSE value BETWEEN 1 AND verses AND coalesce(upto > value AND upto <= verses, true) END, false) AS fine FROM n7),
n9 AS (SELECT *, head = 'name' AND count(*) {_A} > 1 AND bool_and(i = 1 OR joint = ',') {_A} AND NOT bool_and(fine) {_A} AND bool_and(also AND upto IS NULL AND NOT single) {_A} AS listed FROM n8),
rf AS (SELECT doc_id, run, row_number() {_R} AS n, start, max(stop) {_A} AS "end", head, book, CASE WHEN listed THEN value ELSE chapter END AS chapter, CASE WHEN NOT listed AND NOT opens THEN value END AS verse, upto,
  CASE WHEN listed THEN 'chapters' WHEN opens THEN 'chapter' ELSE 'verses' END AS reading, fine OR listed AS valid, pos FROM n9 WHERE listed OR NOT absorbed)"""


def _resolved(spark, sf_dir):
    documents = _docs(spark, sf_dir).select("doc_id", "text").unionByName(spark.createDataFrame(PLANTED, "doc_id bigint, text string"))
    return documents, C.resolved(settled(C.signs(documents)), spark.createDataFrame(_ROWS, "book string, chapter int, n int"))


@query(f'WITH {_NOTED} SELECT doc_id, run::BIGINT AS run, n::INTEGER AS n, start::INTEGER AS start, "end"::INTEGER AS "end", head, book, chapter::INTEGER AS chapter, verse::INTEGER AS verse, upto::INTEGER AS upto, reading, valid FROM rf')
def references_in_context(spark, sf_dir):
    """Every verse, range and chapter that the documents refer to, with book and chapter from the context, and whether it is there."""
    return _resolved(spark, sf_dir)[1]


@query(rf"""WITH {_NOTED}, r1 AS (SELECT *, lag(chapter) {_R} AS c1, lag(verse) {_R} AS v1, verse || coalesce('–' || upto, '') AS v, {_in('book', C.ONE_CHAPTER)} OR head = 'verse' AS bare FROM rf),
r2 AS (SELECT *, verse IS NOT NULL AND c1 IS NOT DISTINCT FROM chapter AND v1 IS NOT NULL AS again FROM r1),
r3 AS (SELECT *, CASE WHEN c1 IS NULL THEN '' WHEN again OR reading = 'chapters' THEN ', ' ELSE '; ' END || CASE WHEN again OR (bare AND verse IS NOT NULL) THEN v WHEN verse IS NULL THEN chapter || coalesce('–' || upto, '') ELSE chapter || ':' || v END AS x FROM r2),
nw AS (SELECT doc_id, start, max("end") AS e, CASE WHEN any_value(head) = 'name' THEN any_value(book) || ' ' WHEN any_value(head) = 'chapter' THEN 'ch. ' WHEN count(*) > 1 OR count(upto) > 0 THEN 'vv. ' ELSE 'v. ' END || string_agg(x, '' ORDER BY n) AS new FROM r3 GROUP BY doc_id, run, start HAVING bool_and(valid)),
pr AS (SELECT n.*, text, coalesce(lag(e) OVER w, 0) AS was, lead(start) OVER w IS NULL AS final FROM nw n JOIN dc USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY start)),
sp AS (SELECT doc_id, count(*) AS k, string_agg(substr(text, was + 1, start - was) || new || CASE WHEN final THEN substr(text, e + 1) ELSE '' END, '' ORDER BY start) AS text FROM pr GROUP BY doc_id)
SELECT d.doc_id, coalesce(k, 0)::INTEGER AS changed, coalesce(s.text, d.text) AS text FROM dc d LEFT JOIN sp s ON s.doc_id = d.doc_id""")
def references_restyled(spark, sf_dir):
    """Every document, with its references in one form where they are there."""
    documents, rows = _resolved(spark, sf_dir)
    return C.restyled(documents, settled(C.written(rows)))  # as a table its size is known beforehand, and few references don't shuffle all texts
