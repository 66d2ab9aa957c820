"""Web pages as texts, blocks, headings and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumq.functions import text as T

#: Tags that begin a block.
BLOCKS = "p|h[1-6]|li|blockquote|td|th|div|article"


def body(html: Column) -> Column:
    """Scripts, styles and comments left out: a script may hold what looks like a tag."""
    t = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>", " ")
    return F.regexp_replace(t, r"(?s)<!--.*?-->", " ")


def unescaped(text: Column) -> Column:
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def stripped(html: Column) -> Column:
    return F.trim(T.collapsed(unescaped(F.regexp_replace(html, "<[^>]+>", " "))))


def ordered_blocks(pages: DataFrame) -> DataFrame:
    """page_id, block, tag, text: runs of a page that begin with a block tag; unclosed tags end where the next begins."""
    cut = F.split(F.regexp_replace(body(F.col("html")), rf"(?i)<({BLOCKS})(\s[^>]*)?>", "\u0001$1\u0002"), "\u0001")
    rows = pages.select("page_id", F.posexplode(F.slice(cut, 2, F.size(cut))).alias("block", "x"))
    return rows.select("page_id", "block", F.lower(F.substring_index("x", "\u0002", 1)).alias("tag"), stripped(F.substring_index("x", "\u0002", -1)).alias("text")).filter("text <> ''")


def headings(pages: DataFrame) -> DataFrame:
    """page_id, block, level, text."""
    return ordered_blocks(pages).filter(F.col("tag").rlike("^h[1-6]$")).select("page_id", "block", F.substring("tag", 2, 1).cast("int").alias("level"), "text")


def nested(headings: DataFrame, group: str, order: str = "block") -> DataFrame:
    """Each heading with the place of the last earlier one of a lesser level, its parent."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # the last place of each level so far; the parent is the greatest of those of lesser levels
    last = [F.max(F.when(F.col("level") == n, F.col(order))).over(w) for n in range(1, 7)]
    # a place counts only if no heading of a lesser or equal level came after it, which the greatest place says by itself
    parent = F.array_max(F.array(*[F.when(F.col("level") > n, x) for n, x in enumerate(last, 1)]))
    return headings.withColumn("parent", parent)


def links(pages: DataFrame) -> DataFrame:
    """page_id, href, text."""
    found = F.regexp_extract_all(body(F.col("html")), F.lit(r"""(?is)<a\s[^>]*href\s*=\s*["']([^"']*)["'][^>]*>.*?</a>"""), F.lit(0))
    rows = pages.select("page_id", F.explode(found).alias("x"))
    return rows.select("page_id", F.regexp_extract("x", r"""(?is)href\s*=\s*["']([^"']*)["']""", 1).alias("href"), stripped(F.col("x")).alias("text"))


def anchored(references: DataFrame, notes: DataFrame) -> DataFrame:
    """References (page_id, href) with the note (page_id, id, text) they name: by '#id', else by the bare id."""
    by = notes.select(F.col("page_id").alias("__p"), F.col("id").alias("__i"), "text")
    key = F.regexp_replace("href", "^.*#", "")
    return references.join(by, (F.col("page_id") == F.col("__p")) & (key == F.col("__i")), "left").drop("__p", "__i")
