"""Queries over outlines, rules, references, scans, ordered folds and streams, with their oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators import graph as G
from vellumq.operators import ordered as O
from vellumq.operators import outline as U
from vellumq.operators import references as R
from vellumq.operators import rules as Y
from vellumq.operators import scans as P
from vellumq.operators import select as C
from vellumq.plans import sql as S
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


@query()
def outline_levels(spark, sf_dir):
    """Levels of numbered lines."""
    return U.outlines(_docs(spark, sf_dir))


@query()
def house_rules(spark, sf_dir):
    """Violations of the house rules, by rule."""
    return Y.house(_docs(spark, sf_dir)).groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))


@query()
def citation_styles(spark, sf_dir):
    """How references name books, the commonest 25 forms."""
    return R.styles(R.references(_docs(spark, sf_dir)))


_MARKS = """t0 AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), t1 AS (SELECT doc_id, li, [{'kind': 'm', 'text': '¶'}] || list_transform(regexp_extract_all(l[li], '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s]'), lambda x: {'kind': CASE WHEN regexp_matches(x, '^[\\p{L}\\p{N}_]') THEN 'w' ELSE 'x' END, 'text': x}) AS x FROM t0, unnest(range(1, len(l) + 1)) AS u(li)),
t2 AS (SELECT doc_id, li, i, x[i].kind AS kind, x[i].text AS text FROM t1, unnest(range(1, len(x) + 1)) AS u(i)), t3 AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY li, i) - 1 AS pos, kind, text FROM t2)"""


def _stream(spark, sf_dir):
    sign = F.lit(r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]")
    one = lambda x: F.struct(F.when(x.rlike(r"^[\p{L}\p{N}_]"), "w").otherwise("x").alias("kind"), x.alias("text"))
    line = lambda s: F.concat(F.array(F.struct(F.lit("m").alias("kind"), F.lit("¶").alias("text"))), F.transform(F.regexp_extract_all(s, sign, F.lit(0)), one))
    rows = _docs(spark, sf_dir).filter("text is not null").select("doc_id", F.posexplode(F.flatten(F.transform(T.lines(F.col("text")), line))).alias("pos", "x"))
    return rows.select("doc_id", "pos", "x.kind", "x.text")


@query(f"""WITH {_MARKS}, s AS (SELECT *, lag(text, 1) OVER w AS t1, lag(text, 2) OVER w AS t2, lag(kind, 1) OVER w AS k1, lag(kind, 3) OVER w AS k3 FROM t3 WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
p AS (SELECT *, coalesce(k1 IS NULL OR k1 = 'm' OR (t1 IN ('.', '!', '?') AND NOT coalesce((t1 = '.' AND regexp_matches(t2, '^([0-9]+|[ivxlc]+)$') AND k3 = 'm') OR (t1 = '.' AND lower(t2) IN ('i', 'e')) OR (t1 = '!' AND lower(t2) IN ('oh', 'ah', 'alas', 'o')), false)), true) AS plain FROM s),
q AS (SELECT *, kind = 'w' AND (plain OR coalesce(lag(text) OVER w IN ('—', '–') AND lag(plain) OVER w, false)) AS start FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
SELECT doc_id, count(*) FILTER (start) AS starts, count(*) FILTER (kind = 'w') AS words FROM q GROUP BY doc_id""")
def sentence_starts(spark, sf_dir):
    """Words that begin a sentence, by the state before them."""
    rows = O.sentence_starts(_stream(spark, sf_dir))
    return rows.groupBy("doc_id").agg(F.count(F.when(F.col("start"), 1)).alias("starts"), F.count(F.when(F.col("kind") == "w", 1)).alias("words"))


@query(f"WITH {_MARKS}, b AS (SELECT *, count(*) FILTER (kind = 'm') OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS block FROM t3) SELECT doc_id, block, count(*) FILTER (kind = 'w') AS words FROM b GROUP BY ALL")
def block_words(spark, sf_dir):
    """Words of each block, numbered by the marks so far."""
    return O.block_numbers(_stream(spark, sf_dir)).groupBy("doc_id", "block").agg(F.count(F.when(F.col("kind") == "w", 1)).alias("words"))


@query(f"""WITH {_MARKS}, u AS (SELECT *, kind = 'w' AND upper(text) = text AND lower(text) <> text AS it FROM t3), g AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - row_number() OVER (PARTITION BY doc_id, it ORDER BY pos) AS island FROM u)
SELECT doc_id, CAST(min(pos) AS INTEGER) AS first, CAST(max(pos) AS INTEGER) AS last, count(*) AS n FROM g WHERE it GROUP BY doc_id, island""")
def emphasis_runs(spark, sf_dir):
    """Runs of emphasised words; capitals stand for italics."""
    shouted = (F.col("kind") == "w") & (F.upper("text") == F.col("text")) & (F.lower("text") != F.col("text"))
    return O.italic_runs(_stream(spark, sf_dir).withColumn("italic", shouted))


@query("""SELECT conv_id AS scan, count(*) AS pages, count(*) AS same FROM conversations GROUP BY 1""")
def scan_round_trip(spark, sf_dir):
    """Pages exported with their marks and read back: all are the same; turns stand for pages."""
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("scan"), F.col("turn").cast("int").alias("page"), "text")
    back = P.read_back(P.exported(pages)).withColumnRenamed("text", "back")
    both = pages.join(back, ["scan", "page"], "left")
    return both.groupBy("scan").agg(F.count("*").alias("pages"), F.count(F.when(F.col("text") == F.col("back"), 1)).alias("same"))


@query("""SELECT l_orderkey AS page, min(l_partkey) AS "left", min(l_suppkey) AS top, max(l_partkey + CAST(l_quantity AS BIGINT)) AS "right", max(l_suppkey + l_linenumber) AS bottom, count(*) AS words FROM lineitem GROUP BY 1""")
def line_boxes(spark, sf_dir):
    """Boxes around a group's boxes; order lines stand for words."""
    rows = table(spark, sf_dir, "lineitem").select(F.lit(5).alias("level"), F.col("l_orderkey").alias("page"), F.lit(1).alias("block_num"), F.lit(1).alias("par_num"), F.lit(1).alias("line_num"), F.col("l_linenumber").alias("word_num"), F.col("l_partkey").alias("left"), F.col("l_suppkey").alias("top"), F.col("l_quantity").cast("long").alias("width"), F.col("l_linenumber").cast("long").alias("height"), F.lit("w").alias("text"))
    return P.lines(rows).select("page", "left", "top", "right", "bottom", F.size("words").cast("long").alias("words"))


@query("""SELECT o_custkey AS book, count(*) AS pages, CASE WHEN count(*) >= 25 THEN 22 WHEN count(*) >= 15 THEN 19 WHEN count(*) >= 5 THEN 16 ELSE 13 END AS margin FROM orders GROUP BY 1""")
def margin_steps(spark, sf_dir):
    """A step function by a small range join: the margin that a number of pages asks for; customers' orders stand for pages."""
    books = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("book")).agg(F.count("*").alias("pages"))
    return P.inside_margin(books, spark.createDataFrame([(0, 13), (5, 16), (15, 19), (25, 22)], "least int, margin int"))


@query("""SELECT strftime(ts, '%Y.%m.%d') AS release, count(*) AS n, min(event_id) AS first_event FROM events GROUP BY 1""")
def release_days(spark, sf_dir):
    """Release names by day."""
    return table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy.MM.dd").alias("release")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query(r"""SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM pages""")
def page_slugs(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.slug(F.col("url")).alias("slug"))


@query(r"""SELECT doc_id, length(replace(replace(replace(coalesce(text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS html_chars, length(regexp_replace(coalesce(text, ''), '([\\#\[\]*_$@<>`])', '\\\1', 'g')) AS markup_chars, length(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS collapsed_chars FROM documents""")
def escaped_sizes(spark, sf_dir):
    """Lengths of texts as escaped for two renderers, and collapsed."""
    t = F.coalesce("text", F.lit(""))
    return _docs(spark, sf_dir).select("doc_id", F.length(T.escaped_html(t)).cast("long").alias("html_chars"), F.length(T.escaped_markup(t)).cast("long").alias("markup_chars"), F.length(T.collapsed(t)).cast("long").alias("collapsed_chars"))


@query(rf"""WITH r AS (SELECT lang, unnest(regexp_extract_all(coalesce(text, ''), '[À-ÖØ-öø-ɏ]+|[Ͱ-Ͽἀ-῿]+|[֐-׿]+')) AS x FROM documents)
SELECT lang, CASE WHEN regexp_matches(x, '^[À-ɏ]') THEN 'latin' WHEN regexp_matches(x, '^[֐-׿]') THEN 'hebrew' ELSE 'greek' END AS script, count(*) AS runs, CAST(sum(length(x)) AS BIGINT) AS letters FROM r GROUP BY ALL""")
def script_runs(spark, sf_dir):
    """Runs of letters beyond ASCII, by script."""
    x = _docs(spark, sf_dir).select("lang", F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[À-ÖØ-öø-ɏ]+|[Ͱ-Ͽἀ-῿]+|[֐-׿]+"), F.lit(0))).alias("x"))
    script = F.when(F.col("x").rlike("^[À-ɏ]"), "latin").when(F.col("x").rlike("^[֐-׿]"), "hebrew").otherwise("greek")
    return x.groupBy("lang", script.alias("script")).agg(F.count("*").alias("runs"), F.sum(F.length("x")).cast("long").alias("letters"))


@query(f"""WITH {S.TOK}, w AS (SELECT DISTINCT lower(word) AS w FROM tok), k AS (SELECT w, {S.loose('w')} AS k FROM w) SELECT k AS key, list_sort(list(w))[1] AS first, count(*) AS n FROM k WHERE k <> '' GROUP BY k HAVING count(*) >= 3""")
def loose_families(spark, sf_dir):
    """Families of three spellings or more under the loose key."""
    w = _docs(spark, sf_dir).select(F.explode(T.words(F.col("text"))).alias("w")).select(F.lower("w").alias("w")).distinct()
    return w.withColumn("key", T.loose_key(F.col("w"))).filter("key <> ''").groupBy("key").agg(F.min("w").alias("first"), F.count("*").alias("n")).filter("n >= 3")


@query()
def marked_lines(spark, sf_dir):
    """The strongest sentences as lines for a reader, the strongest word marked."""
    top = C.budget_top(C.scored_sentences(_docs(spark, sf_dir)), 0.02).filter("strongest is not null").select("doc_id", "sent_no", "score", "strongest")
    from vellumq.operators.tokens import sentences

    texts = sentences(_docs(spark, sf_dir)).select("doc_id", "sent_no", T.spaced_words(F.col("s")).alias("w"))
    return texts.join(top, ["doc_id", "sent_no"]).select("doc_id", "sent_no", C.marked_line(F.col("w"), F.col("strongest"), F.col("score"), F.col("doc_id")).alias("line"))


@query(f"""WITH {S.TOK} SELECT lower(word) AS word, count(*) AS n FROM tok GROUP BY 1""")
def incremental_counts(spark, sf_dir):
    """Words counted from a stream of files: the totals are those of all texts at once."""
    from vellumq.streaming import batches as B

    out = f"{G.shared_folder(spark)}/counts-{uuid.uuid4().hex}"
    G.dropped_at_exit(spark, out)
    schema = table(spark, sf_dir, "documents").schema
    B.counted_by_word(B.arriving(spark, f"{sf_dir}/documents.parque*", schema), f"{out}/rows", f"{out}/state").awaitTermination()
    return B.totals(spark, f"{out}/rows")


@query("""WITH t AS (SELECT event_id, ts, user_id FROM events), p AS (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM t) SELECT user_id, count(*) AS events, count(*) FILTER (before IS NULL OR ts - before > INTERVAL 1 HOUR) AS sessions FROM p GROUP BY 1""")
def event_sessions(spark, sf_dir):
    """An extension: runs of a user's events with an hour at most between."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.lag("ts").over(w).alias("before"))
    return rows.groupBy("user_id").agg(F.count("*").alias("events"), F.count(F.when(F.col("before").isNull() | (F.col("ts") - F.expr("interval 1 hour") > F.col("before")), 1)).alias("sessions"))
