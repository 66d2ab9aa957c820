"""Markup as nested intervals: each element is the range of positions between its tags, so ancestors, containment and reading order are joins on ranges.

1. ``pieces``: tags and texts of a page, numbered.
2. ``matched``: tags of one name are matched by running sums. The sum of openers less closers, kept from falling below zero, is a tag's level; an opener and the next closer of its level are a pair.
   Closers beyond zero close nothing.
3. ``elements``: an element ends at its own closer or where an element around it ends, whichever comes first; so intervals are nested whatever the markup is, and an element that is never closed ends with what
   holds it. Ends of elements around are found by a join on buckets of positions.
4. ``placed`` joins positions with the intervals around them; ``reading`` gives the texts in order with their path, head, cell and block.

Nothing is folded over a page, no pair of positions is compared outside a bucket, and a page may be as long as its windows' partitions allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators import html as H
from vellumq.operators.graph import settled

#: Elements without a closer, elements that stand within a line and may stand within a word, heads and table cells.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
INLINE = ("a", "abbr", "b", "cite", "code", "em", "i", "mark", "q", "s", "small", "span", "strong", "sub", "sup", "u", "wbr")
HEADS = ("h1", "h2", "h3", "h4", "h5", "h6")
CELLS = ("td", "th")
BUCKET = 64


def pieces(pages: DataFrame) -> DataFrame:
    """page_id, pos, piece, kind (open, close, void, text), name, n: the tags and texts of each page, n of them; declarations are left out."""
    cut = F.regexp_extract_all(H.body(F.coalesce("html", F.lit(""))), F.lit("(<[^>]+>|[^<]+)"), 1)
    rows = pages.select("page_id", cut.alias("cut")).select("page_id", F.size("cut").alias("n"), F.posexplode("cut").alias("pos", "piece"))
    tag = F.col("piece").startswith("<")
    name = F.lower(F.regexp_extract("piece", "^</?([A-Za-z][A-Za-z0-9]*)", 1))
    kind = F.when(~tag, "text").when(F.col("piece").startswith("</"), "close").when(name.isin(*VOID) | F.col("piece").endswith("/>"), "void").otherwise("open")
    return rows.select("page_id", "pos", "piece", kind.alias("kind"), F.when(tag, name).alias("name"), "n").filter("kind = 'text' OR name <> ''")


def matched(cut: DataFrame) -> DataFrame:
    """page_id, first, name, close, n: each opener with the closer of its level, or null."""
    order = Window.partitionBy("page_id", "name").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tags = cut.filter(F.col("kind").isin("open", "close")).withColumn("sum", F.sum(F.when(F.col("kind") == "open", 1).otherwise(-1)).over(so_far))
    tags = tags.withColumn("low", F.least(F.min("sum").over(so_far), F.lit(0)))
    stray = (F.col("kind") == "close") & (F.col("low") < F.coalesce(F.lag("low").over(order), F.lit(0)))
    level = F.col("sum") - F.col("low") + F.when(F.col("kind") == "close", 1).otherwise(0)
    tags = tags.withColumn("stray", stray).filter("NOT stray").withColumn("level", level)
    beside = Window.partitionBy("page_id", "name", "level").orderBy("pos")
    return tags.withColumn("close", F.lead("pos").over(beside)).filter("kind = 'open'").select("page_id", F.col("pos").alias("first"), "name", "close", "n")


def _bucketed(intervals: DataFrame, first: str, last: str) -> DataFrame:
    return intervals.withColumn("bucket", F.explode(F.sequence(F.expr(f"{first} div {BUCKET}"), F.expr(f"{last} div {BUCKET}"))))


def elements(cut: DataFrame) -> DataFrame:
    """page_id, first, last, name: nested intervals; positions strictly between are inside."""
    pairs = settled(matched(cut))
    around = _bucketed(pairs.filter("close IS NOT NULL").select("page_id", F.col("first").alias("p"), F.col("close").alias("q")), "p", "q")
    ends = pairs.select("page_id", "first", F.expr(f"first div {BUCKET}").alias("bucket")).join(around, ["page_id", "bucket"]).filter("p < first AND first < q").groupBy("page_id", "first").agg(F.min("q").alias("end"))
    last = F.least(F.coalesce("close", "n"), F.coalesce("end", "n"))
    return pairs.join(ends, ["page_id", "first"], "left").select("page_id", "first", last.alias("last"), "name")


def placed(points: DataFrame, tree: DataFrame) -> DataFrame:
    """The points (page_id, pos) with ``up``: the elements around each, (first, last, name) from the outermost in; a point without any has none."""
    around = _bucketed(tree.select("page_id", F.col("first").alias("p"), F.col("last").alias("q"), "name"), "p", "q")
    met = points.select("page_id", "pos", F.expr(f"pos div {BUCKET}").alias("bucket")).join(around, ["page_id", "bucket"]).filter("p < pos AND pos < q")
    up = met.groupBy("page_id", "pos").agg(F.array_sort(F.collect_list(F.struct(F.col("p").alias("first"), F.col("q").alias("last"), "name"))).alias("up"))
    return points.join(up, ["page_id", "pos"], "left")


def nodes(tree: DataFrame) -> DataFrame:
    """page_id, first, last, name, depth, parent: the elements with their depth, from 1, and where their parent begins."""
    rows = placed(tree.withColumnRenamed("first", "pos"), tree)
    return rows.select("page_id", F.col("pos").alias("first"), "last", "name", (F.size(F.coalesce("up", F.array())) + 1).alias("depth"), F.get("up", F.size("up") - 1)["first"].alias("parent"))


def within(up: Column, names: tuple[str, ...]) -> Column:
    """Where the innermost element of these names begins."""
    return F.array_max(F.transform(F.filter(up, lambda x: x["name"].isin(*names)), lambda x: x["first"]))


def reading(cut: DataFrame, tree: DataFrame) -> DataFrame:
    """page_id, pos, path, head, cell, block, opens, closes, joins, words: texts that hold more than blanks, in order.

    path: the names around; head, cell, block: where the innermost head, cell and container begin; opens and closes: whether it is the first and the last text of that container; joins: whether its first word goes
    on from the text before, with nothing but tags within a line between them.
    """
    order = Window.partitionBy("page_id").orderBy("pos")
    breaks = F.sum(F.when((F.col("kind") != "text") & ~F.col("name").isin(*INLINE), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    texts = cut.withColumn("breaks", breaks).filter("kind = 'text'").withColumn("plain", H.unescaped(F.col("piece")))
    word = r"[\p{L}\p{N}_]"
    joins = (F.lag("breaks").over(order) == F.col("breaks")) & F.lag("plain").over(order).rlike(word + "$") & F.col("plain").rlike("^" + word)
    texts = texts.withColumn("joins", F.coalesce(joins, F.lit(False))).filter(F.col("plain").rlike(r"[^ \t\n\f\r]"))
    rows = placed(texts.select("page_id", "pos", "joins", F.size(T.words(F.col("plain"))).alias("words")), tree)
    up = F.coalesce("up", F.array().cast("array<struct<first:int,last:int,name:string>>"))
    block = F.array_max(F.transform(F.filter(up, lambda x: ~x["name"].isin(*INLINE)), lambda x: x["first"]))
    rows = rows.select("page_id", "pos", F.array_join(F.transform(up, lambda x: x["name"]), "/").alias("path"), within(up, HEADS).alias("head"), within(up, CELLS).alias("cell"), block.alias("block"), "joins", "words")
    own = Window.partitionBy("page_id", "block").orderBy("pos")
    return rows.select("page_id", "pos", "path", "head", "cell", "block", F.lag("pos").over(own).isNull().alias("opens"), F.lead("pos").over(own).isNull().alias("closes"), "joins", "words")
