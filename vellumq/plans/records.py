"""Queries over events, labels, conversations and fingerprints, with their oracles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators import gates as Q
from vellumq.operators import graph as G
from vellumq.operators.rules import reasons
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


@query("""SELECT conv_id, turn, last_user FROM (SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS last_user FROM conversations) WHERE role = 'assistant'""")
def carry_user_turn(spark, sf_dir):
    """The last user turn before each assistant turn."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(w).alias("last_user"))
    return rows.filter("role = 'assistant'").select("conv_id", "turn", "last_user")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_event(spark, sf_dir):
    """The newest event of each user and type."""
    return Q.latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


_GATES = {"long enough": "length(coalesce(text, '')) >= 200", "no junk": "length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[*&$%#|!]', '', 'g')) <= 20", "no loops": "NOT regexp_matches(coalesce(text, ''), 'lorem ipsum')"}


def _gated(spark, sf_dir):
    t = F.coalesce("text", F.lit(""))
    rules = {"long enough": F.length(t) >= 200, "no junk": F.length(t) - F.length(F.regexp_replace(t, "[*&$%#|!]", "")) <= 20, "no loops": ~t.rlike("lorem ipsum")}
    return _docs(spark, sf_dir).select("doc_id", "lang", "source", reasons({k: ~c for k, c in rules.items()}).alias("problems"))


_PROBLEMS = "SELECT doc_id, lang, source, list_filter([" + ", ".join(f"CASE WHEN NOT ({c}) THEN '{k}' END" for k, c in _GATES.items()) + "], lambda x: x IS NOT NULL) AS problems FROM documents"


@query(f"WITH p AS ({_PROBLEMS}) SELECT gate, count(*) AS n FROM (SELECT unnest(problems) AS gate FROM p) GROUP BY gate")
def doc_gates(spark, sf_dir):
    """Documents that fail each gate."""
    return _gated(spark, sf_dir).select(F.explode("problems").alias("gate")).groupBy("gate").agg(F.count("*").alias("n"))


@query(f"""WITH p AS ({_PROBLEMS}) SELECT state, count(*) AS n FROM (SELECT CASE WHEN len(problems) = 0 AND coalesce(quality, 0) = 1 THEN 'done' WHEN len(problems) > 0 THEN 'held' ELSE 'ready' END AS state FROM p LEFT JOIN labels USING (doc_id)) GROUP BY 1""")
def sign_off_state(spark, sf_dir):
    """Documents by release state: signed by a label, held back by a gate, or ready."""
    facts = _gated(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "problems", F.array().cast("array<string>").alias("changed"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("signed"))
    return Q.state(facts).groupBy("state").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT d.source, mode(quality) AS q FROM (SELECT * FROM documents) d JOIN (SELECT * FROM labels WHERE quality = 1) l USING (doc_id) GROUP BY 1)
SELECT d.doc_id, coalesce(l.quality, s.q, 0) AS quality, CASE WHEN l.quality IS NOT NULL THEN 'own' WHEN s.q IS NOT NULL THEN 'source' ELSE 'default' END AS origin FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN s USING (source)""")
def inherit_meta(spark, sf_dir):
    """A document's quality: its own, else its source's, else the default."""
    docs, labels = _docs(spark, sf_dir).select("doc_id", "source"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    own = docs.join(labels, "doc_id", "left")
    good = own.filter("quality = 1").select("source", F.lit(1).alias("q")).distinct()
    rows = own.join(good, "source", "left")
    return rows.select("doc_id", F.coalesce("quality", "q", F.lit(0)).alias("quality"), F.when(F.col("quality").isNotNull(), "own").when(F.col("q").isNotNull(), "source").otherwise("default").alias("origin"))


@query(r"""WITH a AS (SELECT CAST(doc_id AS VARCHAR) AS key, sha256(coalesce(text, '')) AS h FROM documents UNION ALL SELECT 'page ' || page_id, sha256(coalesce(html, '')) FROM pages), b AS (SELECT CAST(doc_id AS VARCHAR) AS key, sha256(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS h FROM documents UNION ALL SELECT 'item ' || item_id, sha256(coalesce(text, '')) FROM benchmark)
SELECT key, CASE WHEN a.h IS NULL THEN 'added' WHEN b.h IS NULL THEN 'gone' WHEN a.h = b.h THEN 'same' ELSE 'changed' END AS change FROM a FULL JOIN b USING (key)""")
def golden_compare(spark, sf_dir):
    """Two snapshots of fingerprints: texts as they are with the pages, and texts with white space collapsed with the benchmark: all four outcomes show."""
    d = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("key"), "text")
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("page "), "page_id").alias("key"), F.col("html").alias("text"))
    items = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("item "), "item_id").alias("key"), "text")
    old = Q.fingerprints(d.unionByName(pages), "key", "text", "raw")
    new = Q.fingerprints(d.withColumn("text", T.collapsed(F.col("text"))).unionByName(items), "key", "text", "collapsed")
    return Q.compared(old, new)


@query("""WITH f AS (SELECT source, CAST(doc_id AS VARCHAR) AS key, sha256(coalesce(text, '')) AS d FROM documents),
b AS (SELECT source, left(sha256(key), 3) AS branch, count(*) AS n, sha256(string_agg(d || '  ' || key, chr(10) ORDER BY key)) AS d FROM f GROUP BY ALL)
SELECT source, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(branch || ':' || d, chr(10) ORDER BY branch)) AS sha256 FROM b GROUP BY source""")
def manifests(spark, sf_dir):
    """A digest over the ordered digests of each source's documents."""
    d = _docs(spark, sf_dir)
    return Q.manifest(d.select("source", F.col("doc_id").cast("string").alias("key"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256")), "source")


@query("""WITH t AS (SELECT user_id AS unit, (event_id % 3 + 1) AS major, event_id % 13 AS minor FROM events), v AS (SELECT unit, max([major, minor]) AS m FROM t GROUP BY unit)
SELECT unit, CAST(m[1] AS INTEGER) AS major, CAST(m[2] AS INTEGER) AS minor, 'v' || m[1] || '.' || (m[2] + 1) AS next FROM v""")
def latest_version(spark, sf_dir):
    """The highest version of each unit, compared number by number, and the next point version; events stand for tags."""
    tag = F.concat(F.lit("v"), F.col("event_id") % 3 + 1, F.lit("."), F.col("event_id") % 13)
    v = Q.latest_version(table(spark, sf_dir, "events").select(F.col("user_id").alias("unit"), tag.alias("tag")))
    return v.select("unit", F.col("version")[0].alias("major"), F.col("version")[1].alias("minor"), F.concat(F.lit("v"), F.array_join(Q.next_point(F.col("version")).cast("array<string>"), ".")).alias("next"))


@query("""WITH RECURSIVE g AS (SELECT 'r' || n_regionkey AS "from", 'n' || n_nationkey AS "to" FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey FROM orders),
r AS (SELECT 'r' || r_regionkey AS start, 'r' || r_regionkey AS node FROM region UNION SELECT r.start, g."to" FROM r JOIN g ON r.node = g."from")
SELECT start, count(*) AS reached FROM r GROUP BY start""")
def reference_closure(spark, sf_dir):
    """All that is reachable from each region along references; regions, nations, customers, suppliers and orders stand for files that name others."""
    def edges(name, a, x, b, y):
        return table(spark, sf_dir, name).select(F.concat(F.lit(a), x).alias("from"), F.concat(F.lit(b), y).alias("to"))

    e = edges("nation", "r", "n_regionkey", "n", "n_nationkey").union(edges("customer", "n", "c_nationkey", "c", "c_custkey")).union(edges("supplier", "n", "s_nationkey", "s", "s_suppkey")).union(edges("orders", "c", "o_custkey", "o", "o_orderkey"))
    start = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("start"))
    return G.closure(e, start).groupBy("start").agg(F.count("*").alias("reached"))


@query("""SELECT event_type, CAST(props::JSON->>'$.v' AS VARCHAR) AS v, count(*) AS n, round(avg(value), 4) AS mean FROM events GROUP BY ALL""")
def event_props(spark, sf_dir):
    """A field of the events' JSON."""
    return table(spark, sf_dir, "events").groupBy("event_type", F.get_json_object("props", "$.v").alias("v")).agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"))


@query("""SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, grouping(lang, source) AS g FROM documents GROUP BY ROLLUP (lang, source)""")
def size_rollup(spark, sf_dir):
    """An extension: documents and characters by language and source, with totals."""
    return _docs(spark, sf_dir).rollup("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.grouping_id().alias("g"))


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def price_summary(spark, sf_dir):
    """An extension: a bench over the bulk tables."""
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))
