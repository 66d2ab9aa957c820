"""Queries over web pages, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators import html as H
from vellumq.plans import sql as S
from vellumq.session import table

QUERIES, ORACLES = {}, {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


_BODY = r"regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g')"


def _plain(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{sign}')"
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


@query(f"SELECT page_id, CAST(len(regexp_extract_all(t, '{S.WORD}')) AS BIGINT) AS words, sha256(t) AS sha256 FROM (SELECT page_id, {_plain(_BODY)} AS t FROM pages)")
def page_text_words(spark, sf_dir):
    """Words of each page's text."""
    t = H.stripped(H.body(F.col("html")))
    return table(spark, sf_dir, "pages").select("page_id", t.alias("t")).select("page_id", F.size(T.words(F.col("t"))).cast("long").alias("words"), F.sha2("t", 256).alias("sha256"))


_CUT = rf"c AS (SELECT page_id, string_split(regexp_replace({_BODY}, '(?i)<({H.BLOCKS})(\s[^>]*)?>', chr(1) || '\1' || chr(2), 'g'), chr(1)) AS p FROM pages), b0 AS (SELECT page_id, i - 2 AS block, lower(string_split(p[i], chr(2))[1]) AS tag, {_plain('string_split(p[i], chr(2))[-1]')} AS text FROM c, unnest(range(2, len(p) + 1)) AS u(i)), b AS (SELECT * FROM b0 WHERE text <> '')"


@query(f"WITH {_CUT} SELECT tag, count(*) AS blocks, CAST(sum(len(regexp_extract_all(text, '{S.WORD}'))) AS BIGINT) AS words FROM b GROUP BY tag")
def page_blocks(spark, sf_dir):
    """Blocks and words by tag."""
    b = H.ordered_blocks(table(spark, sf_dir, "pages"))
    return b.groupBy("tag").agg(F.count("*").alias("blocks"), F.sum(F.size(T.words(F.col("text")))).alias("words"))


@query(f"WITH {_CUT} SELECT page_id, CAST(block AS INTEGER) AS block, CAST(tag[2:2] AS INTEGER) AS level, text FROM b WHERE regexp_matches(tag, '^h[1-6]$')")
def page_headings(spark, sf_dir):
    return H.headings(table(spark, sf_dir, "pages"))


@query(rf"""WITH l AS (SELECT page_id, unnest(regexp_extract_all({_BODY}, '(?is)<a\s[^>]*href\s*=\s*["'']([^"'']*)["''][^>]*>.*?</a>')) AS x FROM pages) SELECT page_id, regexp_extract(x, '(?is)href\s*=\s*["'']([^"'']*)["'']', 1) AS href, {_plain('x')} AS text FROM l""")
def page_links(spark, sf_dir):
    return H.links(table(spark, sf_dir, "pages"))


@query(r"""SELECT lower(t) AS tag, count(*) AS n, count(DISTINCT page_id) AS pages FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([A-Za-z][A-Za-z0-9]*)', 1)) AS t FROM pages) GROUP BY 1""")
def tag_inventory(spark, sf_dir):
    """Tags of all pages: counts of structure."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit("<([A-Za-z][A-Za-z0-9]*)"), F.lit(1))).alias("t"))
    each = rows.groupBy(F.lower("t").alias("tag"), "page_id").agg(F.count("*").alias("n"))
    return each.groupBy("tag").agg(F.sum("n").alias("n"), F.count("*").alias("pages"))


@query(rf"""WITH t AS (SELECT page_id, {_plain(_BODY)} AS t FROM pages), k AS (SELECT page_id, unnest([{{'kind': 'spacing', 'n': len(regexp_extract_all(t, '[\p{{L}}\p{{N}}_] [,;:!?]( |$)'))}}, {{'kind': 'punctuation', 'n': len(regexp_extract_all(t, '[,;:][,;:.][^0-9]'))}}, {{'kind': 'glued', 'n': len(regexp_extract_all(t, '[a-z][,;:][A-Za-z]|[a-z]\.[A-Z][a-z]'))}}]) AS x FROM t)
SELECT x.kind AS kind, CAST(sum(x.n) AS BIGINT) AS n, count(*) FILTER (x.n > 0) AS pages FROM k GROUP BY 1""")
def page_lints(spark, sf_dir):
    """Rules of spacing and punctuation over the pages' texts, one pass for all."""
    from vellumq.operators.rules import portable_counts

    t = table(spark, sf_dir, "pages").select("page_id", H.stripped(H.body(F.col("html"))).alias("t"))
    x = t.select("page_id", F.explode(portable_counts(F.col("t"))).alias("x"))
    return x.groupBy("x.kind").agg(F.sum("x.n").cast("long").alias("n"), F.count(F.when(F.col("x.n") > 0, 1)).alias("pages"))
