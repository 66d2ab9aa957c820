"""Ordered folds over token tables: neighbours, runs, counters, spacing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order(*keys: str, by: str = "pos") -> Window:
    return Window.partitionBy(*keys).orderBy(by)


def sentence_starts(tokens: DataFrame) -> DataFrame:
    """Tokens (doc_id, pos, kind, text) with start: the first word of a block, or the first after . ! ? -- but not after the stop of a numeral that opens a block, of i. or e., nor after the ! of oh, ah, alas, o. A dash just after a start keeps it."""
    w = order("doc_id")
    lag = lambda n: F.lag("text", n).over(w)
    kind = lambda n: F.lag("kind", n).over(w)
    stop = lag(1).isin(".", "!", "?")
    numeral = (lag(1) == ".") & lag(2).rlike(r"^([0-9]+|[ivxlc]+)$") & (kind(3) == "m")
    short = (lag(1) == ".") & F.lower(lag(2)).isin("i", "e")
    sigh = (lag(1) == "!") & F.lower(lag(2)).isin("oh", "ah", "alas", "o")
    plain = kind(1).isNull() | (kind(1) == "m") | (stop & ~F.coalesce(numeral | short | sigh, F.lit(False)))
    # a dash passes the state of its own place on
    rows = tokens.withColumn("__plain", F.coalesce(plain, F.lit(True)))
    dash = F.lag("text").over(w).isin("—", "–") & F.lag("__plain").over(w)
    return rows.withColumn("start", (F.col("kind") == "w") & (F.col("__plain") | F.coalesce(dash, F.lit(False)))).drop("__plain")


def carried(rows: DataFrame, value: Column, name: str, *keys: str, by: str = "pos") -> DataFrame:
    """The last value that isn't null, carried forward."""
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(order(*keys, by=by).rowsBetween(Window.unboundedPreceding, 0)))


def block_numbers(tokens: DataFrame) -> DataFrame:
    """The number of marks so far."""
    return tokens.withColumn("block", F.sum((F.col("kind") == "m").cast("int")).over(order("doc_id").rowsBetween(Window.unboundedPreceding, 0)))


def near_page_marks(tokens: DataFrame, k: int = 4) -> DataFrame:
    """Tokens with catch: whether the same word stands within k tokens of a page mark beside it."""
    w = order("doc_id")
    around = w.rowsBetween(-k, k)
    marked = F.max((F.col("kind") == "p").cast("int")).over(around) == 1
    return tokens.withColumn("catch", marked & (F.size(F.filter(F.collect_list("text").over(around), lambda x: x == F.col("text"))) > 1))


def italic_runs(tokens: DataFrame) -> DataFrame:
    """doc_id, first, last, n of runs of italic tokens: islands of the difference of two row numbers."""
    w, own = order("doc_id"), Window.partitionBy("doc_id", "italic").orderBy("pos")
    rows = tokens.withColumn("island", F.row_number().over(w) - F.row_number().over(own)).filter("italic")
    return rows.groupBy("doc_id", "island").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("n")).drop("island")


def level_counters(points: DataFrame) -> DataFrame:
    """Points (doc_id, pos, level) with parent, the last point above before it (-1: none), and number: a count at each level that starts again under each new point above.

    A point stands once for each of its text's levels from its own down: as itself, and as one that begins a new count there. Levels are as many as the text has.
    """
    levels = points.groupBy("doc_id").agg(F.collect_set("level").alias("levels"))
    each = points.join(levels, "doc_id").withColumn("under", F.explode(F.filter("levels", lambda x: x >= F.col("level")))).drop("levels")
    before = Window.partitionBy("doc_id", "under").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    parent = F.coalesce(F.max(F.when(F.col("level") < F.col("under"), F.col("pos"))).over(before), F.lit(-1))
    rows = each.withColumn("parent", parent).filter("level = under").drop("under")
    return rows.withColumn("number", F.row_number().over(Window.partitionBy("doc_id", "level", "parent").orderBy("pos")))


def joined_tokens(words: Column) -> Column:
    """Tokens as running text: no space before closing signs, none after opening ones."""
    spaced = F.array_join(words, " ")
    spaced = F.regexp_replace(spaced, r" ([,.;:!?)\]”’])", "$1")
    return F.regexp_replace(spaced, r"([(\[“‘]) ", "$1")


def page_break_spaces(tokens: DataFrame) -> DataFrame:
    """A space that stands before a page mark moves behind it: rows (doc_id, pos, kind, text), kind s for spaces and p for marks."""
    w = order("doc_id")
    before, after = F.lag("kind").over(w), F.lead("kind").over(w)
    kind = F.when((F.col("kind") == "s") & (after == "p"), "p").when((F.col("kind") == "p") & (before == "s"), "s").otherwise(F.col("kind"))
    text = F.when((F.col("kind") == "s") & (after == "p"), F.lead("text").over(w)).when((F.col("kind") == "p") & (before == "s"), F.lag("text").over(w)).otherwise(F.col("text"))
    return tokens.select("doc_id", "pos", kind.alias("kind"), text.alias("text"))


def spacing_changes(target: DataFrame, source: DataFrame) -> DataFrame:
    """Neighbouring words that one text joins and the other parts: rows (doc_id, pos, text), met by their joined form."""
    def pairs(rows: DataFrame) -> DataFrame:
        return rows.withColumn("next", F.lead("text").over(order("doc_id"))).filter("next is not null")

    apart = pairs(target).select("doc_id", "pos", F.lower(F.concat("text", "next")).alias("joined"), F.lit("parted").alias("change"))
    whole = source.select("doc_id", F.lower("text").alias("joined")).distinct()
    return apart.join(whole, ["doc_id", "joined"], "left_semi")


def split_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks (doc_id, pos, split) with block, previous and next: a split begins a new block that is linked to the one it was part of."""
    w = order("doc_id")
    rows = blocks.withColumn("block", F.sum(F.col("split").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.withColumn("previous", F.when(F.col("split"), F.lag("block").over(w))).withColumn("next", F.when(F.lead("split").over(w), F.lead("block").over(w)))


def nested_items(items: DataFrame) -> DataFrame:
    """List items (doc_id, pos, depth) with parent: the last earlier item one depth less. An item stands at its own depth, and as a parent at the next."""
    each = items.withColumn("x", F.explode(F.array(F.struct(F.col("depth").cast("long").alias("at"), F.lit(None).cast("long").alias("held")), F.struct((F.col("depth") + 1).cast("long").alias("at"), F.col("pos").cast("long").alias("held")))))
    before = Window.partitionBy("doc_id", "x.at").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("parent", F.max("x.held").over(before)).filter("x.held is null").drop("x")


def gap_fill(orig: Column, new: Column) -> Column:
    """What an editor's word puts into a gap (marked …): null unless the printed ends fit."""
    head, tail = F.substring_index(orig, "…", 1), F.substring_index(orig, "…", -1)
    inside = F.substring(new, F.length(head) + 1, F.length(new) - F.length(head) - F.length(tail))
    return F.when(orig.contains("…") & new.startswith(head) & new.endswith(tail) & (F.length(new) >= F.length(head) + F.length(tail)), inside)
