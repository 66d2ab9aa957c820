"""Unified differences: op rows over lines become hunks with context, and hunks give the other text back.

Lines are aligned by anchors (``anchored.operations``, single lines). Changes with at most twice the context between them are one hunk: islands of op rows in a window. A hunk's body is put together from slices of both
sides' lines, in Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumq.operators import anchored as N

PAIR = N.PAIR


def lines(pairs: DataFrame) -> DataFrame:
    """a, b, wa, wb: the lines of each pair's texts; a null text has one empty line."""
    return pairs.select(*PAIR, *(F.split(F.coalesce(F.col(c), F.lit("")), "\n", -1).alias(n) for c, n in (("text_a", "wa"), ("text_b", "wb"))))


def _range(start: Column, size: Column) -> Column:
    """'line,lines' as unified differences have it: one line alone has no count, none is named by the line before."""
    first = F.when(size == 0, start).otherwise(start + 1).cast("string")
    return F.when(size == 1, first).otherwise(F.concat(first, F.lit(","), size.cast("string")))


def hunks(pairs: DataFrame, ops: DataFrame, context: int = 3) -> DataFrame:
    """a, b, hunk, i1, i2, j1, j2, header, body: hunks of the op rows over lines; the range of each in both texts, and its lines with ' ', '-' or '+' before them."""
    order = Window.partitionBy(*PAIR).orderBy("seq")
    apart = (F.col("op") == "equal") & (F.col("i2") - F.col("i1") > 2 * context)
    changed = ops.withColumn("hunk", F.sum(apart.cast("int")).over(order)).filter("op <> 'equal'")
    lists = changed.groupBy(*PAIR, "hunk").agg(F.array_sort(F.collect_list(F.struct("i1", "i2", "j1", "j2"))).alias("cs"))
    lists = lists.withColumn("hunk", F.row_number().over(Window.partitionBy(*PAIR).orderBy("hunk")) - 1)
    rows = lists.join(pairs, list(PAIR))
    first, last = F.get("cs", F.lit(0)), F.get("cs", F.size("cs") - 1)
    before = F.least(F.lit(context), first["i1"], first["j1"])
    after = F.least(F.lit(context), F.size("wa") - last["i2"], F.size("wb") - last["j2"])
    rows = rows.withColumn("before", before).withColumn("after", after).withColumn("i1", first["i1"] - before).withColumn("i2", last["i2"] + after).withColumn("j1", first["j1"] - before).withColumn("j2", last["j2"] + after)
    part = lambda sign, words, u, v: F.transform(F.slice(words, u + 1, v - u), lambda x: F.concat(F.lit(sign), x))

    def change(c: Column, k: Column) -> Column:
        following = F.coalesce(F.get("cs", k + 1)["i1"], F.col("i2"))
        return F.concat(part("-", "wa", c["i1"], c["i2"]), part("+", "wb", c["j1"], c["j2"]), part(" ", "wa", c["i2"], following))

    body = F.concat(part(" ", "wa", F.col("i1"), first["i1"]), F.flatten(F.transform("cs", change)))
    header = F.concat(F.lit("@@ -"), _range(F.col("i1"), F.col("i2") - F.col("i1")), F.lit(" +"), _range(F.col("j1"), F.col("j2") - F.col("j1")), F.lit(" @@"))
    return rows.select(*PAIR, "hunk", "i1", "i2", "j1", "j2", header.alias("header"), body.alias("body"))


def patched(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """a, b, text: the first text of each pair with its hunks applied. Only their bodies and the ranges of the first text are read; a body whose old lines aren't there raises."""
    lists = found.groupBy(*PAIR).agg(F.array_sort(F.collect_list(F.struct("i1", "i2", "body"))).alias("hs"))
    rows = pairs.select(*PAIR, "wa").join(lists, list(PAIR), "left").withColumn("hs", F.coalesce("hs", F.array().cast(lists.schema["hs"].dataType)))
    bare = lambda body, signs: F.transform(F.filter(body, lambda x: F.left(x, F.lit(1)).isin(*signs)), lambda x: F.substr(x, F.lit(2)))

    def step(h: Column, k: Column) -> Column:
        u = F.coalesce(F.get("hs", k - 1)["i2"], F.lit(0))
        old = F.slice("wa", h["i1"] + 1, h["i2"] - h["i1"])
        new = F.when(old == bare(h["body"], (" ", "-")), bare(h["body"], (" ", "+"))).otherwise(F.array(F.raise_error(F.lit("a hunk doesn't fit the text")).cast("string")))
        return F.concat(F.slice("wa", u + 1, h["i1"] - u), new)

    done = F.coalesce(F.get("hs", F.size("hs") - 1)["i2"], F.lit(0))
    out = F.concat(F.flatten(F.transform("hs", step)), F.slice("wa", done + 1, F.size("wa") - done))
    return rows.select(*PAIR, F.array_join(out, "\n").alias("text"))
