"""Edits of a page's tree of nested intervals: split, merge, quote and heading as rewrites of its tags, with a reason for each that can't be made.

1. ``judged`` places each edit at the block of its text by joins, and says why it can't be made there, if so.
2. Edits that touch overlapping intervals clash. Spans are taken by where they begin, the longer one first; a span that a span before it reaches into is left out, by a running greatest end, so no two edits are
   compared. Splits of one block agree with each other; of other edits of one span the least number stays.
3. ``applied`` gives the pieces with what each edit puts before, in place of and after them, and what stood there; ``undone`` gives the pieces back, ``rewritten`` the pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellumq.operators import intervals as I

#: Blocks that can be cut, and those that can become a heading.
CUT = ("p", "li", "dd", "dt", "blockquote", "div", *I.HEADS)
HEADED = ("p", "div")
EDITS = "page_id bigint, edit_id bigint, kind string, spot int, upto int, level int"


def blocks(cut: DataFrame, tree: DataFrame) -> DataFrame:
    """page_id, first, last, name, parent, closed, holds, next: each element that isn't within a line, where its parent begins, whether it has a closer of its own, whether a block is within it, and the first piece after it that isn't blank."""
    rows = I.placed(tree.withColumnRenamed("first", "pos"), tree).withColumnRenamed("pos", "first").filter(~F.col("name").isin(*I.INLINE))
    outer = F.array_max(F.transform(F.filter("up", lambda x: ~x["name"].isin(*I.INLINE)), lambda x: x["first"]))
    rows = rows.select("page_id", "first", "last", "name", F.get("up", F.size("up") - 1)["first"].alias("parent"), outer.alias("outer"))
    inner = rows.filter("outer IS NOT NULL").select("page_id", F.col("outer").alias("first"), F.lit(True).alias("holds")).distinct()
    solid = cut.filter("kind <> 'text' OR piece RLIKE '[^ \\\\t\\\\n\\\\f\\\\r]'")
    ends = solid.select("page_id", F.col("pos").alias("last"), F.when(F.col("kind") == "close", F.col("name")).alias("closer"), F.lead("pos").over(Window.partitionBy("page_id").orderBy("pos")).alias("next"))
    held = rows.drop("outer").join(inner, ["page_id", "first"], "left").join(ends, ["page_id", "last"], "left")
    return held.select("page_id", "first", "last", "name", "parent", F.coalesce(F.col("closer") == F.col("name"), F.lit(False)).alias("closed"), F.coalesce("holds", F.lit(False)).alias("holds"), "next")


def judged(cut: DataFrame, texts: DataFrame, held: DataFrame, edits: DataFrame) -> DataFrame:
    """The edits (page_id, edit_id, kind, spot, upto, level; edit_id is unique in a page) with block, lo, hi (what they touch) and why: null if made, else the reason.

    texts: ``intervals.reading``; held: ``blocks``. spot: a text's position; a quotation goes on to the block of ``upto``.
    """
    place = texts.select("page_id", F.col("pos").alias("spot"), "block", "opens", F.lit(True).alias("there"))
    until = texts.select("page_id", F.col("pos").alias("upto"), F.col("block").alias("b2"), F.lit(True).alias("there2"))
    own = held.withColumnRenamed("first", "block")
    second = held.select("page_id", F.col("first").alias("b2"), F.col("last").alias("last2"), F.col("parent").alias("parent2"), F.col("closed").alias("closed2"))
    after = held.select("page_id", F.col("first").alias("next"), F.col("last").alias("last3"), F.col("name").alias("name3"), F.col("closed").alias("closed3"))
    rows = edits.join(place, ["page_id", "spot"], "left").join(own, ["page_id", "block"], "left").join(until, ["page_id", "upto"], "left").join(second, ["page_id", "b2"], "left").join(after, ["page_id", "next"], "left")
    kind = F.col("kind")
    why = (
        F.when(F.col("there").isNull() | ((kind == "quote") & F.col("there2").isNull()), "no text")
        .when(F.col("block").isNull() | ((kind == "quote") & F.col("b2").isNull()), "no block")
        .when((kind == "split") & ~F.col("name").isin(*CUT), "no paragraph")
        .when((kind == "split") & F.col("opens"), "first")
        .when((kind == "heading") & ~F.col("name").isin(*HEADED), "no paragraph")
        .when((kind == "heading") & F.col("holds"), "holds blocks")
        .when((kind == "quote") & (~F.col("parent").eqNullSafe(F.col("parent2")) | (F.col("b2") < F.col("block"))), "crosses")
        .when((kind != "split") & (~F.col("closed") | ((kind == "quote") & ~F.col("closed2"))), "open")
        .when((kind == "merge") & F.col("name3").isNull(), "nothing next")
        .when((kind == "merge") & (F.col("name3") != F.col("name")), "other name")
        .when((kind == "merge") & ~F.col("closed3"), "open")
    )
    hi = F.when(kind == "quote", F.col("last2")).when(kind == "merge", F.col("last3")).otherwise(F.col("last"))
    rows = rows.withColumn("why", why).select("page_id", "edit_id", "kind", "spot", "upto", "level", "block", F.col("last").alias("end"), "next", F.when(F.col("why").isNull(), F.col("block")).alias("lo"), F.when(F.col("why").isNull(), hi).alias("hi"), "why")
    spans = rows.filter("why IS NULL").groupBy("page_id", "lo", "hi").agg(F.min("edit_id").alias("head"), F.min_by("kind", "edit_id").alias("head_kind"))
    before = Window.partitionBy("page_id").orderBy("lo", F.desc("hi")).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("reached", F.coalesce(F.max("hi").over(before) >= F.col("lo"), F.lit(False)))
    rows = rows.join(spans, ["page_id", "lo", "hi"], "left")
    least = F.min("edit_id").over(Window.partitionBy("page_id", "lo", "hi", "kind", "spot"))
    agrees = (F.col("edit_id") == F.col("head")) | ((kind == "split") & (F.col("head_kind") == "split") & (F.col("edit_id") == least))
    return rows.withColumn("why", F.when(F.col("why").isNotNull(), F.col("why")).when(F.col("reached"), "overlaps").when(~agrees, "clashes")).drop("head", "head_kind", "reached")


def applied(cut: DataFrame, tree: DataFrame, verdicts: DataFrame) -> DataFrame:
    """page_id, pos, piece, edit_id, was: the pieces after the edits that can be made; edit_id: the edit that changed a piece; was: the piece before it."""
    made = verdicts.filter("why IS NULL")
    names = F.transform(F.filter("up", lambda x: x["first"] >= F.col("block")), lambda x: x["name"])
    splits = I.placed(made.filter("kind = 'split'").select("page_id", F.col("spot").alias("pos"), "edit_id", "block"), tree)
    closers = F.array_join(F.transform(F.reverse(names), lambda x: F.concat(F.lit("</"), x, F.lit(">"))), "")
    openers = F.array_join(F.transform(names, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    none, empty = F.lit(None).cast("string"), F.lit("")
    at_text = splits.select("page_id", "pos", "edit_id", F.concat(closers, openers).alias("before"), none.alias("instead"), empty.alias("after"))

    def change(pos, before, instead, after):
        return F.struct(pos.alias("pos"), before.alias("before"), instead.alias("instead"), after.alias("after"))

    head = F.concat(F.lit("h"), F.col("level").cast("string"), F.lit(">"))
    both = (
        F.when(F.col("kind") == "heading", F.array(change(F.col("lo"), empty, F.concat(F.lit("<"), head), empty), change(F.col("hi"), empty, F.concat(F.lit("</"), head), empty)))
        .when(F.col("kind") == "quote", F.array(change(F.col("lo"), F.lit("<blockquote>"), none, empty), change(F.col("hi"), empty, none, F.lit("</blockquote>"))))
        .when(F.col("kind") == "merge", F.array(change(F.col("end"), empty, F.lit(" "), empty), change(F.col("next"), empty, empty, empty)))
    )
    at_tags = made.filter("kind <> 'split'").select("page_id", "edit_id", F.explode(both).alias("c")).select("page_id", "c.pos", "edit_id", "c.before", "c.instead", "c.after")
    rows = cut.select("page_id", "pos", F.col("piece").alias("was")).join(at_text.unionByName(at_tags), ["page_id", "pos"], "left")
    piece = F.concat(F.coalesce("before", empty), F.coalesce("instead", "was"), F.coalesce("after", empty))
    return rows.select("page_id", "pos", piece.alias("piece"), "edit_id", "was")


def undone(edited: DataFrame) -> DataFrame:
    """page_id, pos, piece: the pieces before the edits."""
    return edited.select("page_id", "pos", F.col("was").alias("piece"))


def rewritten(edited: DataFrame) -> DataFrame:
    """page_id, html: the pieces of each page, put together."""
    pieces = edited.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("own"))
    return pieces.select("page_id", F.array_join(F.transform("own", lambda x: x["piece"]), "").alias("html"))


def proposed(cut: DataFrame, texts: DataFrame) -> DataFrame:
    """The edits that the pages' own texts suggest: a split after a line break, a heading at a paragraph of at most four words, a quotation from a block of twenty words or more to the next that begins, and a merge where a block ends without a stop."""
    order = Window.partitionBy("page_id").orderBy("pos")
    raw = cut.withColumn("broken", F.coalesce(F.lag("name").over(order) == "br", F.lit(False))).filter("kind = 'text'").select("page_id", "pos", "broken", F.col("piece").rlike(r"[.!?][ \t\n\f\r]*$").alias("stopped"))
    begun = F.first(F.when(F.col("opens"), F.col("pos")), ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    rows = texts.withColumn("begun", begun).join(raw, ["page_id", "pos"])
    kinds = {"split": F.col("broken"), "heading": F.col("opens") & F.col("closes") & (F.col("words") <= 4), "quote": F.col("opens") & (F.col("words") >= 20) & F.col("begun").isNotNull(), "merge": F.col("closes") & ~F.col("stopped")}
    wanted = F.array(*[F.when(on, F.struct(F.lit(n).alias("n"), F.lit(kind).alias("kind"))) for n, (kind, on) in enumerate(kinds.items())])
    each = rows.select("page_id", "pos", "begun", F.explode(F.filter(wanted, lambda x: x.isNotNull())).alias("e"))
    return each.select("page_id", (F.col("pos") * 4 + F.col("e.n")).cast("bigint").alias("edit_id"), "e.kind", F.col("pos").alias("spot"), F.when(F.col("e.kind") == "quote", F.col("begun")).alias("upto"), F.when(F.col("e.kind") == "heading", 3).alias("level"))
