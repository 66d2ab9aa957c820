"""Queries over names in documents, with SQL that looks up every run of one, three and five signs and takes the leftmost longest, one after another."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumq.operators import names as N
from vellumq.operators import references as R
from vellumq.plans.words import _docs
from vellumq.session import table

QUERIES, ORACLES = {}, {}


def query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


#: Texts with what the documents lack: names without blanks, in capitals, within other words, within longer names, side by side, at the ends.
PLANTED = [(-1, "1 John and 1John, JOHN; Song of Solomon, SONGOFSOLOMON"), (-2, "Johnny, aJohn, John2, 11 John, 1 Johns"), (-3, "Mark Luke John"), (-4, "Song of Solomons and 2 Kings"), (-5, None), (-6, "Ruth"), (-7, "éRuth Ruthé Ruth-Ruth")]
_VALUES = ", ".join(f"({i}, " + ("NULL" if t is None else f"'{t}'") + ")" for i, t in PLANTED)
_FOUND = rf"""b0 AS (SELECT DISTINCT regexp_extract(text, '^[A-Za-z]+ [A-Za-z]+') AS name FROM benchmark UNION SELECT * FROM (VALUES {', '.join(f"('{b}')" for b in R.BOOKS)}) t),
fm AS (SELECT form, min(name) AS name FROM (SELECT name, unnest([name, upper(name), replace(name, ' ', ''), upper(replace(name, ' ', ''))]) AS form FROM b0) WHERE form <> '' GROUP BY form),
dc AS (SELECT doc_id, source, text FROM documents UNION ALL SELECT doc_id, 'planted', text FROM (VALUES {_VALUES}) t(doc_id, text)),
pt AS (SELECT doc_id, source, regexp_extract_all(text, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]') AS p FROM dc WHERE text IS NOT NULL),
ps AS (SELECT doc_id, source, unnest(p) AS w, generate_subscripts(p, 1) AS i FROM pt), pc AS (SELECT *, (sum(length(w)) OVER (PARTITION BY doc_id ORDER BY i) - length(w))::INTEGER AS start FROM ps),
gr AS (SELECT doc_id, source, start, unnest([w, w || lead(w, 1) OVER x || lead(w, 2) OVER x, w || lead(w, 1) OVER x || lead(w, 2) OVER x || lead(w, 3) OVER x || lead(w, 4) OVER x]) AS form FROM pc WINDOW x AS (PARTITION BY doc_id ORDER BY i)),
met AS MATERIALIZED (SELECT doc_id, source, start, start + length(form) AS stop, form, name, row_number() OVER (PARTITION BY doc_id ORDER BY start, length(form) DESC) AS r FROM gr JOIN fm USING (form)),
hit AS (SELECT doc_id, source, start, stop, form, name FROM met WHERE r = 1 UNION ALL
  SELECT doc_id, source, start, stop, form, name FROM (SELECT m.*, row_number() OVER (PARTITION BY m.doc_id ORDER BY m.r) AS k FROM hit h JOIN met m ON m.doc_id = h.doc_id AND m.start >= h.stop) WHERE k = 1)"""


def _found(spark, sf_dir):
    named = table(spark, sf_dir, "benchmark").select(F.regexp_extract("text", "^[A-Za-z]+ [A-Za-z]+", 0).alias("name")).union(spark.createDataFrame([(b,) for b in R.BOOKS], "name string")).filter("name <> ''").distinct()
    documents = _docs(spark, sf_dir).select("doc_id", "text", "source").unionByName(spark.createDataFrame([(i, t, "planted") for i, t in PLANTED], "doc_id bigint, text string, source string"))
    return documents, N.found(documents, N.variants(named))


@query(f'WITH RECURSIVE {_FOUND} SELECT doc_id, start, (start + length(form))::INTEGER AS "end", form, name FROM hit')
def names_found(spark, sf_dir):
    """Every name of a book, and every opening of a benchmark item, in every document, with its place."""
    return _found(spark, sf_dir)[1]


@query(f"WITH RECURSIVE {_FOUND} SELECT source, name, count(*) AS n, count(DISTINCT doc_id) AS docs, count(DISTINCT form) AS forms FROM hit GROUP BY source, name")
def names_by_source(spark, sf_dir):
    """How often each source has each name, in how many documents and forms."""
    documents, rows = _found(spark, sf_dir)
    each = rows.groupBy("doc_id", "name", "form").agg(F.count("*").alias("n"))
    return each.join(documents.select("doc_id", "source"), "doc_id").groupBy("source", "name").agg(F.sum("n").alias("n"), F.count_distinct("doc_id").alias("docs"), F.count_distinct("form").alias("forms"))
