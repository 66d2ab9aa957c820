"""Secret scans with corpus-wide ownership frequency.

Only DataFrame functions. Base patterns and a general key pattern propose spans in whole texts. Every
proposed value is hashed, and hashes are counted over the corpus: documents, and distinct owners
(``source``). A value that many owners hold is a widely copied example; a value of few owners looks live. General
keys are kept if they look live and are not inside a base span; base spans always stay, with their verdict beside.

Positions: a text split at a pattern and all its matches alternate; a running sum of their lengths, over exploded rows,
gives code-point positions in linear time. Only rows of matches are shuffled. Counting is a partial aggregate by (hash, owner),
then by hash, so a value in a third of all rows costs a row a task.

Defined results: null and empty texts have no spans; a null source is an owner like any other; a null doc_id stays null;
repeated rows are scanned each for itself and count as one owner; empty tables give no rows; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumq.llm import shared

#: The base patterns, and the least length of what must be long.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
#: The general pattern: 20 characters or more of which one is a digit.
KEY = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "key")
GUARD = {"assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "access": "AKIA", "hex": HEX, "key": KEY}


def _matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """For each match: characters since the match before, its own, whether it is long enough, a hash of its value; null without matches."""
    gaps = F.transform(F.split(text, pattern), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.zip_with(whole, value, lambda w, v: F.struct(F.length(w).alias("own"), (F.length(v) >= least).alias("ok"), F.when(F.length(v) >= least, F.sha2(v, 256)).alias("hash")))
    rows = F.zip_with(F.slice(gaps, 1, F.size(whole)), rows, lambda g, r: F.struct(g.alias("gap"), r["own"].alias("own"), r["ok"].alias("ok"), r["hash"].alias("hash")))
    return F.when(text.rlike(GUARD[kind]), F.struct(F.lit(KINDS.index(kind)).alias("kind"), rows.alias("rows")))


def spans(documents: DataFrame, max_owners: int = 2) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of all rows; and row, kind, start, end, hash, n_docs, n_owners, live of all spans kept."""
    text = F.coalesce("text", F.lit(""))
    found = documents.select("doc_id", F.coalesce("source", F.lit("")).alias("owner"), text.alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "owner",
        F.array_compact(F.array(_matches(F.col("text"), "assign", ASSIGN, 1, 6), _matches(F.col("text"), "access", ACCESS, 0, 20), _matches(F.col("text"), "hex", HEX, 0, 24), _matches(F.col("text"), "key", KEY, 0, 20))).alias("found"),
    )
    found = shared.written(found, "secrets")
    rows = found.filter(F.size("found") > 0).select("row", "owner", F.explode("found").alias("x")).select("row", "owner", "x.kind", F.posexplode("x.rows").alias("at", "x")).select("row", "owner", "kind", "at", "x.*")
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("own")).over(Window.partitionBy("row", "kind").orderBy("at"))).filter("ok")
    placed = placed.select("row", "owner", "kind", (F.col("end") - F.col("own")).alias("start"), "end", "hash")
    inside = F.coalesce(F.max(F.when(F.col("kind") < 3, F.col("end"))).over(Window.partitionBy("row").orderBy("start", "kind")) >= F.col("end"), F.lit(False))
    placed = placed.withColumn("inside", inside).filter("kind < 3 or not inside").drop("inside")
    owned = placed.select("hash", "owner", "row").distinct().groupBy("hash", "owner").agg(F.count("*").alias("n"))
    owned = owned.groupBy("hash").agg(F.sum("n").alias("n_docs"), F.count("*").alias("n_owners"))
    judged = placed.join(owned, "hash").withColumn("live", F.col("n_owners") <= max_owners).filter("kind < 3 or live")
    return found.select("row", "doc_id"), judged.select("row", "kind", "start", "end", "hash", "n_docs", "n_owners", "live")


def _told(column: str, keep=None) -> Column:
    names = F.array(*map(F.lit, KINDS))
    rows = F.filter(column, keep) if keep else F.col(column)
    return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets in every whole text: base spans, and general keys that few owners have. Odd rows as in the module's text."""
    rows, found = spans(shared.table(spark, sf_dir, "documents"))
    each = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("s"))
    out = rows.join(each, "row", "left").withColumn("s", F.coalesce("s", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean>>")))

    def n(keep) -> Column:
        return F.size(F.filter("s", keep)).cast("long")

    def of(kind: int):
        return lambda x: x["kind"] == kind

    return out.select(
        "doc_id", *[n(of(i)).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        F.sha2(_told("s", lambda x: x["kind"] < 3), 256).alias("base_sha256"), _told("s").alias("spans"),
        n(lambda x: x["live"]).alias("n_live"), n(lambda x: ~x["live"]).alias("n_example"),
    )


def _sql_matches(kind: int, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT r, owner, {kind} AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'s': list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), 'l': length(m[i]), 'v': v[i]}})) AS x
  FROM (SELECT r, owner, regexp_split_to_array(t, '{quoted}') AS p, regexp_extract_all(t, '{quoted}') AS m, regexp_extract_all(t, '{quoted}', {group}) AS v, {least} AS least FROM docs) WHERE len(m) > 0"""


ORACLE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
raw AS ({_sql_matches(0, ASSIGN, 1, 6)} UNION ALL {_sql_matches(1, ACCESS, 0, 20)} UNION ALL {_sql_matches(2, HEX, 0, 24)} UNION ALL {_sql_matches(3, "[A-Za-z0-9+/_-]{20,}", 0, 20)}),
placed AS (
  SELECT r, owner, kind, CAST(x.s AS BIGINT) AS s, CAST(x.s + x.l AS BIGINT) AS e, x.v AS v FROM raw
  WHERE length(x.v) >= CASE kind WHEN 0 THEN 6 WHEN 2 THEN 24 ELSE 20 END AND (kind < 3 OR regexp_matches(x.v, '[0-9]'))),
kept AS (SELECT * FROM placed p WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM placed b WHERE b.r = p.r AND b.kind < 3 AND b.s <= p.s AND b.e >= p.e)),
owned AS (SELECT v, count(DISTINCT owner) AS n_owners FROM kept GROUP BY v),
judged AS (SELECT r, kind, s, e, n_owners <= 2 AS live FROM kept JOIN owned USING (v) WHERE kind < 3 OR n_owners <= 2),
each AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(['assign', 'access', 'hex', 'key'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3) AS base,
    string_agg(['assign', 'access', 'hex', 'key'][kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example FROM judged GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN each USING (r)
"""
