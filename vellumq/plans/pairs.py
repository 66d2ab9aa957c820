"""Queries over pairs and groups of texts, with their oracles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators import align as A
from vellumq.operators import anchored as N
from vellumq.operators import graph as G
from vellumq.operators import sync as Z
from vellumq.operators import witness as V
from vellumq.plans import sql as S
from vellumq.plans.words import _docs

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


_PAIRS = f"""{S.LINE}, k AS (SELECT doc_id, lower(trim(regexp_replace(s, '\\s+', ' ', 'g'))) AS key, count(*) AS n FROM line GROUP BY ALL HAVING length(lower(trim(regexp_replace(s, '\\s+', ' ', 'g')))) >= 20),
sz AS (SELECT doc_id, count(*) AS size FROM line GROUP BY 1),
held AS (SELECT doc_id, any_value(size) AS size, sum(n) AS long, string_agg(key || chr(1) || n, chr(2) ORDER BY key) AS whole FROM k JOIN sz USING (doc_id) GROUP BY doc_id),
cl AS (SELECT doc_id, size, long, min(doc_id) OVER (PARTITION BY size, whole) AS first FROM held),
kk AS (SELECT k.*, size FROM k JOIN cl USING (doc_id) WHERE doc_id = first),
sh AS (SELECT x.doc_id AS a, y.doc_id AS b, least(any_value(x.size), any_value(y.size)) AS size, CAST(sum(least(x.n, y.n)) AS BIGINT) AS shared FROM kk x JOIN kk y ON x.key = y.key AND x.doc_id < y.doc_id GROUP BY ALL),
lp AS (SELECT a, b, shared FROM sh WHERE shared >= greatest(1, 0.3 * size) OR shared >= 12 UNION ALL SELECT first, doc_id, CAST(long AS BIGINT) FROM cl WHERE doc_id <> first AND (long >= greatest(1, 0.3 * size) OR long >= 12)),
near AS (SELECT b, arg_max(a, (shared, -a)) AS a FROM lp GROUP BY b)"""


@query(f"WITH {_PAIRS} SELECT * FROM lp")
def line_pairs(spark, sf_dir):
    """Texts that share lines: 30 % of the shorter's, or twelve; and each copy of a text with its first."""
    return V.line_pairs(_docs(spark, sf_dir))


@query(f"WITH RECURSIVE {_PAIRS}, e AS (SELECT a, b FROM lp UNION ALL SELECT b, a FROM lp), r AS (SELECT a AS x, a AS y FROM e UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a) SELECT x AS node, min(y) AS component FROM r GROUP BY x")
def components(spark, sf_dir):
    """Groups of documents connected by shared lines."""
    return G.components(V.line_links(_docs(spark, sf_dir)))


@query(f"""WITH {_PAIRS}, w AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '{S.WORD}'))) AS w FROM documents), c AS (SELECT doc_id, w, count(*) AS n FROM w GROUP BY ALL), t AS (SELECT doc_id, sum(n) AS t FROM c GROUP BY 1),
m AS (SELECT near.a, near.b, sum(least(x.n, y.n)) AS m FROM near JOIN c x ON x.doc_id = near.a JOIN c y ON y.doc_id = near.b AND x.w = y.w GROUP BY ALL)
SELECT near.a, near.b, round(2 * coalesce(m, 0) / greatest(coalesce(ta.t, 0) + coalesce(tb.t, 0), 1), 6) AS ratio FROM near LEFT JOIN m USING (a, b) LEFT JOIN t ta ON ta.doc_id = near.a LEFT JOIN t tb ON tb.doc_id = near.b""")
def bag_ratio(spark, sf_dir):
    """Shared words of each document and its nearest earlier one."""
    return V.bag_ratio(V.nearest_pairs(_docs(spark, sf_dir)))


@query(f"""WITH RECURSIVE {_PAIRS}, e AS (SELECT a, b FROM lp UNION ALL SELECT b, a FROM lp), r AS (SELECT a AS x, a AS y FROM e UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a), g AS (SELECT x AS doc_id, min(y) AS "group" FROM r GROUP BY x),
c AS (SELECT "group", count(*) AS copies FROM g GROUP BY 1), l AS (SELECT DISTINCT "group", doc_id, lower(trim(regexp_replace(s, '\\s+', ' ', 'g'))) AS key FROM line JOIN g USING (doc_id))
SELECT "group", key, count(*) AS holders, any_value(copies) AS copies FROM l JOIN c USING ("group") WHERE key <> '' GROUP BY ALL HAVING count(*) >= 2 AND count(*) = any_value(copies) - 1""")
def agreement_n(spark, sf_dir):
    """Lines that all copies of a group but one hold."""
    docs = _docs(spark, sf_dir)
    groups = G.components(V.line_links(docs)).select(F.col("node").alias("doc_id"), F.col("component").alias("group"))
    return V.agreement(docs.select("doc_id", "text").join(groups, "doc_id"))


@query()
def drift_ops(spark, sf_dir):
    """Opcodes of each document against its nearest earlier one."""
    return A.ops(V.nearest_pairs(_docs(spark, sf_dir)))


@query(f"""WITH {_PAIRS}, t AS (SELECT doc_id, CAST(len(regexp_extract_all(text, '{S.WORD}')) AS BIGINT) AS n FROM documents)
SELECT near.a, near.b, ta.n AS words_a, tb.n AS words_b FROM near JOIN t ta ON ta.doc_id = near.a JOIN t tb ON tb.doc_id = near.b""")
def drift_tiles(spark, sf_dir):
    """The opcodes of each pair tile both texts: the spans of either side add up to its words."""
    return N.operations(N.lowered_words(V.nearest_pairs(_docs(spark, sf_dir)))).groupBy("a", "b").agg(F.sum(F.col("i2") - F.col("i1")).alias("words_a"), F.sum(F.col("j2") - F.col("j1")).alias("words_b"))


@query()
def drift_summary(spark, sf_dir):
    return V.drift(V.nearest_pairs(_docs(spark, sf_dir)))


@query()
def change_classes(spark, sf_dir):
    """Differences by kind."""
    return A.changes(V.nearest_pairs(_docs(spark, sf_dir))).groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("b").alias("pairs"))


@query()
def decision_classes(spark, sf_dir):
    return A.decisions(V.nearest_pairs(_docs(spark, sf_dir))).groupBy("kind", "old", "new").agg(F.count("*").alias("n"))


@query()
def alignment_clusters(spark, sf_dir):
    return A.clusters(V.nearest_pairs(_docs(spark, sf_dir)))


@query()
def note_match(spark, sf_dir):
    """Lines of each document paired with those of its nearest earlier one, by place and likeness."""
    return A.note_pairs(V.nearest_pairs(_docs(spark, sf_dir)))


@query()
def block_pairs(spark, sf_dir):
    return A.block_pairs(V.nearest_pairs(_docs(spark, sf_dir)))


@query()
def collate_candidates(spark, sf_dir):
    """Places where two copies of a text or more have words that it lacks."""
    docs = _docs(spark, sf_dir)
    pairs = V.line_pairs(docs).select("a", "b")
    texts = docs.select("doc_id", "text")
    rows = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return V.collate(G.settled(V.witness_words(rows))).withColumn("words", F.array_join("words", " "))


@query()
def slips3(spark, sf_dir):
    """Places where a copy of a group, from the third on, departs from the first and the second keeps to it."""
    docs = _docs(spark, sf_dir)
    groups = G.components(V.line_links(docs))
    order = Window.partitionBy("component").orderBy("node")
    ranked = groups.select(F.first("node").over(order).alias("early"), F.nth_value("node", 2).over(order).alias("witness"), F.col("node").alias("doc"), F.row_number().over(order).alias("at")).filter("at >= 3").drop("at")
    texts = docs.select("doc_id", "text")
    for key, name in (("early", "early_text"), ("witness", "witness_text"), ("doc", "text")):
        ranked = ranked.join(texts.select(F.col("doc_id").alias(key), F.col("text").alias(name)), key)
    return V.slips(ranked)


@query(rf"""WITH {S.LINE}, p AS (SELECT doc_id, line_no AS n, s FROM line), q AS (SELECT doc_id, n, array_to_string(list_transform(regexp_extract_all(translate(replace(lower(regexp_replace(s, '#\w+\[|[\]\\]', ' ', 'g')), 'ſ', 's'), 'vj', 'ui'), '[a-z]+'), lambda x: CASE WHEN length(x) > 3 AND right(x, 1) = 'e' THEN left(x, -1) ELSE x END)[1:12], ' ') AS key FROM p)
SELECT key, count(*) AS n, count(DISTINCT doc_id) AS docs FROM q WHERE key <> '' GROUP BY key HAVING count(*) > 1""")
def paragraph_keys(spark, sf_dir):
    """Openings that several paragraphs share."""
    rows = _docs(spark, sf_dir).filter("text is not null").select("doc_id", F.explode(T.lines(F.col("text"))).alias("s")).select("doc_id", T.paragraph_key(F.col("s")).alias("key")).filter("key <> ''")
    each = rows.groupBy("key", "doc_id").agg(F.count("*").alias("n"))
    return each.groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("docs")).filter("n > 1")


@query()
def forward_match(spark, sf_dir):
    """Each paragraph of a document with the likeliest paragraph ahead in its nearest later copy."""
    pairs = V.nearest_pairs(_docs(spark, sf_dir))

    def side(text: str):
        rows = pairs.select(F.col("b").alias("doc"), F.posexplode(T.lines(F.col(text))).alias("n", "s"))
        return rows.select("doc", "n", T.paragraph_key(F.col("s")).alias("key")).filter(F.size(F.split("key", " ")) >= 4)

    return V.forward_match(side("text_a"), side("text_b"))


@query()
def sync_decisions(spark, sf_dir):
    """Decisions that make each document's nearest earlier text read as it, by type, and the checks that failed (none)."""
    pairs = V.nearest_pairs(_docs(spark, sf_dir))

    def as_xml(text):
        escaped = T.escaped_html(text)
        return F.concat(F.lit("<div><p>"), F.replace(escaped, F.lit("\n"), F.lit("</p><p>")), F.lit("</p></div>"))

    review = F.regexp_replace(F.regexp_replace("text_b", r"([\\#\[\]])", r"\\$1"), r"(?m)^(\s*)([=+-])", "$1")
    rows = Z.sync(pairs.select("a", "b", as_xml(F.col("text_a")).alias("xml"), review.alias("review")))
    return rows.select("a", "b", F.size("decisions").cast("long").alias("decisions"), F.size(F.filter("decisions", lambda d: d["editor"].isNotNull())).cast("long").alias("by_editor"), F.array_join("failed", ",").alias("failed"))


@query()
def structure_changes(spark, sf_dir):
    """Changes of block marks between each document and its nearest earlier one, by kind."""
    blank = lambda c: F.replace(F.regexp_replace(c, r"([\\#\[\]])", r"\\$1"), F.lit("\n"), F.lit("\n\n"))
    pairs = V.nearest_pairs(_docs(spark, sf_dir)).select("a", "b", blank("text_a").alias("text_a"), blank("text_b").alias("text_b"))
    return Z.structure(pairs).groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("b").alias("pairs"))


@query()
def chapter_facets(spark, sf_dir):
    """Pairs whose words, italics, notes, headings or lists are the same."""
    return Z.facets(V.nearest_pairs(_docs(spark, sf_dir))).groupBy("facet").agg(F.count("*").alias("pairs"), F.count(F.when(F.col("same"), 1)).alias("same"))
