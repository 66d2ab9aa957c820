"""Ordered tables of words, sentences and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumq.functions import text as T


def tokens(documents: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the kept columns, pos, word: a row for each word."""
    return documents.select("doc_id", *keep, F.posexplode(T.words(F.col("text"))).alias("pos", "word"))


def sentences(documents: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the kept columns, sent_no, s."""
    return documents.select("doc_id", *keep, F.posexplode(T.sentences(F.col("text"))).alias("sent_no", "s"))


def lines(documents: DataFrame, *keep: str) -> DataFrame:
    return documents.select("doc_id", *keep, F.posexplode(T.lines(F.col("text"))).alias("line_no", "s"))


def reading_stream(documents: DataFrame) -> DataFrame:
    """doc_id, pos, kind, text: a mark for each line that begins a block, then its words, in reading order."""
    marked = F.flatten(F.transform(T.lines(F.col("text")), lambda s: F.concat(F.array(F.struct(F.lit("m").alias("kind"), F.lit("¶").alias("text"))), F.transform(T.words(s), lambda w: F.struct(F.lit("w").alias("kind"), w.alias("text"))))))
    return documents.filter("text is not null").select("doc_id", F.posexplode(marked).alias("pos", "x")).select("doc_id", "pos", "x.kind", "x.text")


def blocks(documents: DataFrame) -> DataFrame:
    """doc_id, line_no, block: runs of lines that aren't empty, with the number of the first (from 1)."""
    rows = lines(documents).withColumn("blank", F.trim("s") == "")
    order = Window.partitionBy("doc_id").orderBy("line_no")
    rows = rows.withColumn("part", F.sum(F.col("blank").cast("int")).over(order)).filter("not blank")
    return rows.groupBy("doc_id", "part").agg((F.min("line_no") + 1).alias("line_no"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "s"))), lambda x: x["s"]), "\n").alias("block")).drop("part")


def places(found: Column, keep) -> Column:
    """Positions of an array's elements that keep."""
    return F.filter(F.transform(found, lambda x, i: F.when(keep(x), i)), lambda i: i.isNotNull())


def doubled_places(found: Column) -> Column:
    """Positions of words that the next word repeats, but for those that may stand twice."""
    pairs = F.zip_with(found, F.slice(found, 2, F.size(found)), lambda x, n: F.struct(x.alias("x"), n.alias("n")))
    return places(pairs, lambda p: (p["x"] == p["n"]) & p["x"].rlike(r"^[\p{L}\p{N}_]+$") & ~p["x"].isin(*T.FINE_DOUBLED))


def around(found: Column, at: Column, k: int) -> Column:
    """The elements k on either side of a place, and the place's own."""
    first = F.greatest(at - k, F.lit(0))
    return F.slice(found, first + 1, at + k + 1 - first)


def keyword_in_context(documents: DataFrame, word: str, k: int = 6) -> DataFrame:
    """doc_id, pos, context of each place of a word, ignoring case. Stays within the row: nothing is shuffled, and only the places found are exploded."""
    w = F.col("w")
    hits = F.transform(places(w, lambda x: F.lower(x) == word), lambda i: F.struct(i.alias("pos"), F.array_join(around(w, i, k), " ").alias("context")))
    found = documents.select("doc_id", T.words(F.col("text")).alias("w")).filter(F.exists("w", lambda x: F.lower(x) == word))
    return found.select("doc_id", F.explode(hits).alias("x")).select("doc_id", "x.pos", "x.context")


def proximity(documents: DataFrame, a: str, b: str, k: int = 3) -> DataFrame:
    """doc_id, pos of each a that has a b within k words."""
    w = F.col("w")
    found = documents.select("doc_id", F.transform(T.words(F.col("text")), F.lower).alias("w")).filter(F.array_contains("w", a) & F.array_contains("w", b))
    return found.select("doc_id", F.explode(F.filter(places(w, lambda x: x == a), lambda i: F.array_contains(around(w, i, k), b))).alias("pos"))


def without_references(found: Column) -> Column:
    """Words without scripture references: numbers, and names of books before a number."""
    numbered = F.zip_with(found, F.concat(F.slice(found, 2, F.size(found)), F.array(F.lit(""))), lambda w, n: F.struct(w.alias("w"), n.alias("n")))
    kept = F.filter(numbered, lambda x: ~x["w"].rlike("^[0-9]+$") & ~(x["w"].isin(*T.BOOKS) & x["n"].rlike("^[0-9]+$")))
    return F.transform(kept, lambda x: x["w"])


def modern_words(found: Column) -> Column:
    """'&' as 'and'; roman numerals left out."""
    return F.filter(F.transform(found, lambda w: F.when(w == "&", "and").otherwise(w)), lambda w: ~w.rlike(r"^[ivxlc]+$"))


def looped(documents: DataFrame, n: int = 4, times: int = 8, least: int = 40) -> DataFrame:
    """doc_id, most: texts of more than ``least`` words in which some run of n words stands ``times`` times or more.

    Whether a text has one is seen within its row: in its sorted runs one equals that ``times - 1`` places on. Only the texts found are counted exactly.
    """
    def once(value: Column) -> Column:
        """The value as a generated column, so that no expression over it computes it again."""
        return F.explode(F.array(value))

    w = F.transform(T.spaced_words(F.col("text")), F.lower)
    long = documents.select("doc_id", once(w).alias("w")).filter(F.size("w") > least)
    runs = F.col("h")
    for k in range(2, n + 1):
        runs = F.zip_with(runs, F.slice("h", k, F.size("h")), lambda a, b: F.xxhash64(a, b))
    rows = long.select("*", once(F.transform("w", lambda x: F.xxhash64(x))).alias("h")).select("doc_id", "w", once(F.sort_array(F.slice(runs, 1, F.size("h") - n + 1))).alias("g"))
    repeated = F.exists(F.zip_with("g", F.slice("g", times, F.size("g")), lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x)
    grams = rows.filter((F.size("g") >= times) & repeated).select("doc_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))).alias("g"))
    return grams.groupBy("doc_id", "g").count().groupBy("doc_id").agg(F.max("count").alias("most")).filter(F.col("most") >= times)
