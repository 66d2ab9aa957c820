"""Token streams with block marks, and the rewrites that an alignment of them needs.

A stream is the tokens of a text in order, each line opened by a mark: ``\\x02+`` for an item, ``\\x02=`` for a heading, ``\\x02¶`` for anything else. Streams are aligned like words
(``anchored.operations``); then op rows are rewritten where the shortest alignment isn't the reader's: each rewrite looks at an op and its neighbours in a window and stays within the pair.

* ``numeral_stops``: a printed numeral that the other text drops for an item's mark is that item's label, and goes with the mark.
* ``stops_before_gaps``: a deletion that begins with the same sign as the text behind it gives that sign back to its sentence.
* ``marks_apart``: a change with marks on both sides, more on one, is cut so that what remains has as many on either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumq.operators.anchored import PAIR

MARK = "\x02"
#: A word, or one sign.
TOKEN = r"[\p{L}\p{N}_]+(?:['’][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_ \t\n\f\r]"
NUMERAL = r"^([0-9]{1,3}|[ivxlcIVXLC]+)$"


def stream(text: Column) -> Column:
    """The tokens of all lines, each line opened by its mark."""

    def line(x: Column) -> Column:
        sign = F.regexp_extract(x, r"^[ \t]*([+=]) ", 1)
        mark = F.concat(F.lit(MARK), F.when(sign == "", "¶").otherwise(sign))
        body = F.when(sign == "", x).otherwise(F.regexp_replace(x, r"^[ \t]*[+=] ", ""))
        return F.concat(F.array(mark), F.regexp_extract_all(body, F.lit(f"({TOKEN})"), 1))

    return F.flatten(F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), line))


def streams(pairs: DataFrame) -> DataFrame:
    """a, b, wa, wb: the streams of each pair's texts."""
    return pairs.select(*PAIR, stream(F.col("text_a")).alias("wa"), stream(F.col("text_b")).alias("wb"))


def with_tokens(ops: DataFrame, pairs: DataFrame) -> DataFrame:
    """The op rows with ``src`` and ``tgt``: the tokens of a change, or the first of what is equal."""
    lists = ops.groupBy(*PAIR).agg(F.collect_list(F.struct("seq", "op", "i1", "i2", "j1", "j2")).alias("ops"))  # one alignment's
    size = lambda o, k: F.when(o["op"] == "equal", 1).otherwise(o[f"{k}2"] - o[f"{k}1"])
    told = F.transform("ops", lambda o: F.struct(*(o[c].alias(c) for c in ("seq", "op", "i1", "i2", "j1", "j2")), F.slice("wa", o["i1"] + 1, size(o, "i")).alias("src"), F.slice("wb", o["j1"] + 1, size(o, "j")).alias("tgt")))
    return lists.join(pairs.select(*PAIR, "wa", "wb"), list(PAIR)).select(*PAIR, F.inline(told))


def _near(column: str | Column, k: int) -> Column:
    """The column k op rows further on in the pair."""
    return (F.lead(column, k) if k > 0 else F.lag(column, -k)).over(Window.partitionBy(*PAIR).orderBy("seq"))


def numeral_stops(rows: DataFrame) -> DataFrame:
    """A numeral deleted, its stop kept, an item's mark inserted: the stop is inserted where the numeral was, and numeral and stop are replaced by what opens the item."""
    first = lambda c: F.get(F.col(c), 0)
    begins = (F.col("op") == "delete") & (F.size("src") == 1) & first("src").rlike(NUMERAL) & (_near("op", 1) == "equal") & (_near(F.col("i2") - F.col("i1"), 1) == 1) & _near(first("src"), 1).isin(".", ")") & (_near("op", 2) == "insert") & (_near(first("tgt"), 2) == MARK + "+")
    told = rows.withColumn("begins", F.coalesce(begins, F.lit(False))).withColumn("place", F.when(F.col("begins"), 0).when(_near("begins", -1), 1).when(_near("begins", -2), 2).otherwise(-1))
    place = F.col("place")
    told = told.withColumn("first_src", _near("src", -2)).withColumn("stop_src", _near("src", -1)).withColumn("u", _near("i1", -2)).withColumn("stop_tgt", _near("tgt", 1)).withColumn("v", _near("j1", 1)).withColumn("w", _near("j2", 1))
    return told.filter("place <> 1").select(
        *PAIR, "seq", F.when(place == 0, "insert").when(place == 2, "replace").otherwise(F.col("op")).alias("op"),
        F.when(place == 2, F.col("u")).otherwise(F.col("i1")).alias("i1"), F.when(place == 0, F.col("i1")).otherwise(F.col("i2")).alias("i2"), F.when(place == 0, F.col("v")).otherwise(F.col("j1")).alias("j1"), F.when(place == 0, F.col("w")).otherwise(F.col("j2")).alias("j2"),
        F.when(place == 0, F.array().cast("array<string>")).when(place == 2, F.concat("first_src", "stop_src")).otherwise(F.col("src")).alias("src"), F.when(place == 0, F.col("stop_tgt")).otherwise(F.col("tgt")).alias("tgt"),
    )


def stops_before_gaps(rows: DataFrame) -> DataFrame:
    """A deletion between equal words that begins with the sign that the words behind it begin with: what is equal before takes its sign, and it takes theirs."""
    sign = F.get(F.col("src"), 0)
    moved = (F.col("op") == "delete") & (_near("op", -1) == "equal") & (_near("op", 1) == "equal") & ~sign.rlike(r"^[\p{L}\p{N}_\x02]") & (sign == _near(sign, 1))
    told = rows.withColumn("moved", F.coalesce(moved, F.lit(False)))
    by = lambda flag: F.when(flag, 1).otherwise(0)
    own, after, before = by(F.col("moved")), by(F.coalesce(_near("moved", 1), F.lit(False))), by(F.coalesce(_near("moved", -1), F.lit(False)))
    out = told.select(*PAIR, "seq", "op", (F.col("i1") + own + before).alias("i1"), (F.col("i2") + own + after).alias("i2"), (F.col("j1") + own + before).alias("j1"), (F.col("j2") + own + after).alias("j2"), F.when(F.col("moved"), F.concat(F.slice("src", 2, F.greatest(F.size("src") - 1, F.lit(0))), F.slice("src", 1, 1))).otherwise(F.col("src")).alias("src"), "tgt")
    return out.filter("i2 > i1 OR j2 > j1")


def marks_apart(rows: DataFrame) -> DataFrame:
    """A change with marks on both sides, and more on one: the surplus ones, with what stands before the rest, are a change of their own."""
    places = lambda c: F.filter(F.transform(F.col(c), lambda x, k: F.when(x.startswith(MARK), k)), lambda k: k.isNotNull())
    told = rows.withColumn("ms", places("src")).withColumn("mt", places("tgt"))
    cut = (F.col("op") != "equal") & (F.size("ms") > 0) & (F.size("mt") > 0) & (F.size("ms") != F.size("mt"))
    at = lambda own, other: F.get(F.col(own), F.greatest(F.size(own) - F.size(other), F.lit(0)))
    told = told.withColumn("si", at("ms", "mt")).withColumn("ti", at("mt", "ms"))
    head = F.struct(F.lit("replace").alias("op"), F.col("i1"), (F.col("i1") + F.col("si")).alias("i2"), F.col("j1"), (F.col("j1") + F.col("ti")).alias("j2"), F.slice("src", 1, F.col("si")).alias("src"), F.slice("tgt", 1, F.col("ti")).alias("tgt"))
    rest = lambda c, k: F.slice(c, F.col(k) + 1, F.size(c) - F.col(k))
    tail = F.struct(F.lit("replace").alias("op"), (F.col("i1") + F.col("si")).alias("i1"), F.col("i2"), (F.col("j1") + F.col("ti")).alias("j1"), F.col("j2"), rest("src", "si").alias("src"), rest("tgt", "ti").alias("tgt"))
    whole = F.struct("op", "i1", "i2", "j1", "j2", "src", "tgt")
    return told.select(*PAIR, "seq", F.inline(F.when(cut, F.array(head, tail)).otherwise(F.array(whole)))).filter("i2 > i1 OR j2 > j1")


def rewritten(ops: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b, seq, op, i1, i2, j1, j2, src, tgt after all rewrites, numbered anew; they tile both streams as the ops did."""
    rows = marks_apart(stops_before_gaps(numeral_stops(with_tokens(ops, pairs))))
    seq = F.row_number().over(Window.partitionBy(*PAIR).orderBy("i1", "j1", "i2", "j2")) - 1
    named = F.when(F.col("op") == "equal", "equal").when(F.col("i1") == F.col("i2"), "insert").when(F.col("j1") == F.col("j2"), "delete").otherwise("replace")
    return rows.select(*PAIR, seq.alias("seq"), named.alias("op"), "i1", "i2", "j1", "j2", "src", "tgt")
