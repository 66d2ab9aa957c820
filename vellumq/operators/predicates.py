"""Predicates and selections over blocks, divisions and records."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators.layers import reading


def empty_in_edition(choices: DataFrame, element: str) -> DataFrame:
    """Elements that an edition leaves out altogether: every reading in them is empty."""
    return choices.groupBy(element).agg(F.bool_and(F.trim(reading()) == "").alias("empty")).filter("empty").select(element)


def verse_divisions(blocks: DataFrame, share: float = 0.8) -> DataFrame:
    """Divisions whose words stand in verse for the most part; blocks: division, kind, text."""
    n = F.size(T.words(F.col("text")))
    rows = blocks.groupBy("division").agg(F.sum(n).alias("words"), F.sum(F.when(F.col("kind").isin("l", "lg"), n).otherwise(0)).alias("verse"))
    return rows.filter((F.col("words") > 0) & (F.col("verse") >= share * F.col("words"))).select("division")


def sections(divisions: DataFrame, first: int, last: int, parent: str = "parent", order: str = "pos") -> DataFrame:
    """Sub-divisions from the first to the last by number, from 1, both included."""
    return divisions.withColumn("number", F.row_number().over(Window.partitionBy(parent).orderBy(order))).filter(F.col("number").between(first, last))


def top_divisions(divisions: DataFrame) -> DataFrame:
    """Divisions without a parent."""
    return divisions.filter(F.col("parent").isNull())


def bracket_depth(before: Column) -> Column:
    """How many brackets a text leaves open: a closer too many closes nothing, an escaped bracket is none."""
    signs = F.regexp_extract_all(F.regexp_replace(before, r"(?s)\\.", ""), F.lit(r"([()\[\]])"), 1)
    return F.aggregate(signs, F.lit(0), lambda d, c: F.when(c.isin("(", "["), d + 1).otherwise(F.greatest(d - 1, F.lit(0))))


def ends_sentence(after: Column) -> Column:
    """Whether a stop before this text ends a sentence: nothing follows, or neither a small letter nor a sign that goes on."""
    return ~after.rlike(r"^\s*[\p{Ll},;:)]")


def footnote_numbers(notes: DataFrame, book: str = "doc_id", order: str = "pos") -> DataFrame:
    """Notes with their number in reading order."""
    return notes.withColumn("number", F.row_number().over(Window.partitionBy(book).orderBy(order)))


def after_level(blocks: DataFrame, doc: str = "doc_id", order: str = "pos") -> DataFrame:
    """Blocks with whether the block before is set in, and whether it is of the same list."""
    w = Window.partitionBy(doc).orderBy(order)
    return blocks.withColumn("after_level", F.coalesce(F.lag("level").over(w) > 0, F.lit(False))).withColumn("same_list", F.coalesce(F.lag("list").over(w) == F.col("list"), F.lit(False)))


def paragraph_offset(words: DataFrame, doc: str = "doc_id", order: str = "pos") -> DataFrame:
    """Words with their place in their paragraph; opens: whether a word opens one."""
    start = F.max(F.when(F.col("opens"), F.col(order))).over(Window.partitionBy(doc).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return words.withColumn("offset", F.col(order) - start)


def cell_ends(tokens: DataFrame) -> DataFrame:
    """First and last token with text of each cell; tokens: cell, pos, text."""
    return tokens.filter(F.trim("text") != "").groupBy("cell").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))


def record_part(records: DataFrame, edition: str) -> DataFrame:
    """What of a record (unit, fields: map) concerns an edition: fields without another edition's prefix, the own prefix taken off."""
    kept = F.map_filter("fields", lambda k, _: ~k.contains(".") | k.startswith(f"{edition}."))
    return records.select("unit", F.transform_keys(kept, lambda k, _: F.regexp_replace(k, f"^{edition}[.]", "")).alias("fields"))


def own_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Units whose part isn't the same in two states; maps are compared by their sorted entries."""
    entries = lambda c: F.array_sort(F.map_entries(c))
    both = old.select("unit", entries("fields").alias("was")).join(new.select("unit", entries("fields").alias("now")), "unit", "full_outer")
    return both.filter(~F.col("was").eqNullSafe(F.col("now"))).select("unit")


def belongs(files: DataFrame, reached: DataFrame) -> DataFrame:
    """path, edition: a file belongs to the edition whose start reaches it, to 'both' if several do, to 'none' if none; reached: start (an edition), node (a path)."""
    n = reached.groupBy(F.col("node").alias("path")).agg(F.count_distinct("start").alias("n"), F.min("start").alias("one"))
    return files.select("path").join(n, "path", "left").select("path", F.when(F.col("n").isNull(), "none").when(F.col("n") > 1, "both").otherwise(F.col("one")).alias("edition"))


def stripped_accents(rows: DataFrame, column: str, name: str = "key") -> DataFrame:
    """The column without accents, lower case, as a new column: Spark has no function for Unicode's decomposition."""
    def strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [None if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)).lower() for t in batch.column(column).to_pylist()]
            yield batch.append_column(name, pa.array(keys, pa.string()))

    from pyspark.sql.types import StringType, StructField, StructType

    return rows.mapInArrow(strip, StructType([*rows.schema.fields, StructField(name, StringType())]))


def witness_ranks(paragraphs: DataFrame, witness: DataFrame) -> DataFrame:
    """doc, n, rank: the rank of a later edition's mark for each numbered paragraph that matches one of its paragraphs ahead; witness: doc, n, key, rank."""
    from vellumq.operators.witness import forward_match

    marked = witness.filter("rank is not null")
    return forward_match(paragraphs, marked.select("doc", "n", "key")).join(marked.select("doc", F.col("n").alias("k"), "rank"), ["doc", "k"]).select("doc", "n", "rank")


#: A later edition's marks, from the outermost level in.
MARKS = (r"^[IVX]{1,4}\.", r"^\d{1,2}\.", r"^\(\d{1,2}\.?\)", r"^\[\d{1,2}\.?\]", r"^\d{1,2}(?:st|nd|rd|th|dly|ly)\.?", r"^\(\d{1,2}(?:st|nd|rd|th|dly|ly)\.?\)", r"^\[\d{1,2}(?:st|nd|rd|th|dly|ly)\.?\]")


def mark_rank(text: Column) -> Column:
    """The level of the mark that opens a paragraph, from 0; null without one."""
    return F.coalesce(*[F.when(text.rlike(m + r"(\s|$)"), F.lit(i)) for i, m in enumerate(MARKS)])
