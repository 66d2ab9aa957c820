"""Straight quotation marks turned by what stands before them and by which quotations are open: a machine with a stack over the marks of a line.

Only the marks are steps of the fold; the text between them is left where it is. A line is a paragraph: no quotation goes beyond it. The state is the stack, one letter for each open quotation, so a step costs its depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumq.functions import text as T

MARK = "(['\"])"
#: What stands before a mark: a number, a letter, white space or an opening bracket. All else, an earlier mark too, is other.
NUMBER, LETTER, OPENER = r"\p{N}$", r"\p{L}$", r"[\s\p{Z}(\[{]$"
#: The signs of a single (s) and a double (d) mark: opening, closing, prime; and the apostrophe.
SIGNS = {"s": ("‘", "’", "′"), "d": ("“", "”", "″")}
APOSTROPHE = "’"


def _before(piece: Column, k: Column) -> Column:
    """n, l, o or x: what the mark after the k-th piece has before it; a line begins as if after a space."""
    empty = piece == ""
    return F.when(empty & (k == 0), "o").when(empty, "x").when(piece.rlike(NUMBER), "n").when(piece.rlike(LETTER), "l").when(piece.rlike(OPENER), "o").otherwise("x")


def turned(line: Column) -> Column:
    """A struct of the line's text with its marks turned, how deep its quotations go (deepest) and how many stay open (left). A null line gives an empty one.

    After a number a mark is a prime, unless a quotation of its kind is the innermost open one; a single mark after a letter is an apostrophe, unless so; a mark of the innermost open quotation closes it, unless it
    stands after a space or an opening bracket; any other mark opens one.
    """
    line = F.coalesce(line, F.lit(""))
    pieces = F.split(line, "['\"]", -1)
    marks = F.regexp_extract_all(line, F.lit(MARK), F.lit(1))
    steps = F.transform(marks, lambda m, k: F.struct(F.when(m == '"', "d").otherwise("s").alias("kind"), _before(F.get(pieces, k), k).alias("before")))
    start = F.struct(F.lit("").alias("stack"), F.lit("").alias("signs"), F.lit(0).alias("deepest"))

    def step(at: Column, x: Column) -> Column:
        own = F.right(at["stack"], F.lit(1)) == x["kind"]
        sign = lambda n: F.when(x["kind"] == "d", SIGNS["d"][n]).otherwise(SIGNS["s"][n])
        stays = ~own & ((x["before"] == "n") | ((x["before"] == "l") & (x["kind"] == "s")))
        closes = own & (x["before"] != "o")
        stack = F.when(stays, at["stack"]).when(closes, F.left(at["stack"], F.length(at["stack"]) - 1)).otherwise(F.concat(at["stack"], x["kind"]))
        put = F.when(stays & (x["before"] == "n"), sign(2)).when(stays, APOSTROPHE).when(closes, sign(1)).otherwise(sign(0))
        return F.struct(stack.alias("stack"), F.concat(at["signs"], put, F.lit(",")).alias("signs"), F.greatest(at["deepest"], F.length(stack)).alias("deepest"))

    def end(at: Column) -> Column:
        signs = F.split(at["signs"], ",", -1)  # one more than marks, the last empty, as pieces are
        return F.struct(F.array_join(F.zip_with(pieces, signs, lambda x, y: F.concat(x, y)), "").alias("text"), at["deepest"].alias("deepest"), F.length(at["stack"]).alias("left"))

    return F.aggregate(steps, start, step, end)


def texts(documents: DataFrame) -> DataFrame:
    """doc_id, marks, deepest, left, text: each text with its marks turned, line by line; how many there are, how deep quotations go, how many are left open at the ends of lines. A null text is empty; nothing is moved."""
    whole = F.coalesce("text", F.lit(""))
    lines = F.transform(T.lines(whole), turned)
    rows = documents.select("doc_id", F.size(F.regexp_extract_all(whole, F.lit(MARK), F.lit(1))).alias("marks"), F.when(whole.rlike(MARK), lines).alias("ls"), whole.alias("own"))
    many = F.aggregate("ls", F.lit(0), lambda n, x: n + x["left"])
    return rows.select("doc_id", "marks", F.coalesce(F.array_max(F.transform("ls", lambda x: x["deepest"])), F.lit(0)).alias("deepest"), F.coalesce(many, F.lit(0)).alias("left"), F.coalesce(F.array_join(F.transform("ls", lambda x: x["text"]), "\n"), "own").alias("text"))
