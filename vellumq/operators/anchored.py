"""Alignment by anchors: what stands once in each of two texts ties them, and only what lies between is looked at again.

A pair is a row (a, b, wa, wb) of two sequences of words. Rounds of anchors go from runs of words to single ones:

1. ``anchors``: runs of ``width`` words that the block holds once on either side: neighbours in one sorted list of both sides' runs.
2. ``runs``: anchors that follow each other on both sides are one run (islands of a list).
3. ``chain``: the heaviest chain of runs that rises on both sides; of equal ones that with the earliest runs. A tree of prefixes over a block's runs: their number times its logarithm.
4. ``gaps``: what lies between the chain's runs is a block of the next round.

In the last gaps, equal words at either end are taken. Everything else is a change. A block is a row, and all of a round stays within it: no words are shuffled, and only those of gaps are written;
a gap without common words that stand once costs nothing more, however long it is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from vellumq.functions import text as T
from vellumq.operators.graph import settled

PAIR = ("a", "b")
ROUNDS = (3, 1)


def lowered_words(pairs: DataFrame) -> DataFrame:
    """a, b, wa, wb: the lower-cased words of each pair's texts."""
    return pairs.select(*PAIR, *(F.transform(T.words(F.coalesce(F.col(c), F.lit(""))), F.lower).alias(n) for c, n in (("text_a", "wa"), ("text_b", "wb"))))


def whole(pairs: DataFrame) -> DataFrame:
    """The pairs as blocks of the first round."""
    zero = F.lit(0)
    return pairs.select(*PAIR, zero.alias("i0"), zero.alias("j0"), "wa", "wb")


def _with(value: Column, make: Callable[[Column], Column]) -> Column:
    """make(value), the value worked out once though make names it many times."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def _there(rows: Column, what: Callable[[Column, Column], Column]) -> Column:
    """What is made of a list's entries and their places, where it is something."""
    return F.filter(F.transform(rows, what), lambda x: x.isNotNull())


def anchors(width: int) -> Column:
    """(i, j), rising in i: where a run of ``width`` words that the block holds once on either side begins, within the block. Both sides' runs are sorted in one list, in which an anchor's two stand alone together."""

    def side(words: str, of: int) -> Column:
        own = F.col(words)
        row = lambda run, k: F.struct(run.alias("run"), F.lit(of).alias("side"), k.alias("at"))
        if width == 1:
            return F.transform(own, row)
        last = F.size(own) - width
        runs_ = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: row(F.concat_ws("\x01", *(F.get(own, k + m) for m in range(width))), k))
        return F.filter(runs_, lambda x: last >= 0)

    def alone(rows: Column) -> Column:
        other = lambda x, k: F.coalesce(F.get(rows, k)["run"] != x["run"], F.lit(True))
        met = lambda x, k: (x["side"] == 0) & ~other(x, k + 1) & (F.get(rows, k + 1)["side"] == 1) & other(x, k - 1) & other(x, k + 2)
        return _there(rows, lambda x, k: F.when(met(x, k), F.struct(x["at"].alias("i"), F.get(rows, k + 1)["at"].alias("j"))))

    return F.sort_array(_with(F.sort_array(F.concat(side("wa", 0), side("wb", 1))), alone))


def runs(found: Column) -> Column:
    """(i, j, n): anchors that follow each other on both sides, as one run of n."""

    def begun(rows: Column) -> Column:
        follows = lambda x, k: (F.get(rows, k - 1)["i"] + 1 == x["i"]) & (F.get(rows, k - 1)["j"] + 1 == x["j"])
        first = _there(rows, lambda x, k: F.when(~F.coalesce(follows(x, k), F.lit(False)), F.struct(x["i"].alias("i"), x["j"].alias("j"), k.alias("k"))))
        return _with(first, lambda s: F.transform(s, lambda x, m: F.struct(x["i"].alias("i"), x["j"].alias("j"), (F.coalesce(F.get(s, m + 1)["k"], F.size(rows)) - x["k"]).alias("n"))))

    return _with(found, begun)


def heaviest(places: Sequence[int], weights: Sequence[int]) -> list[int]:
    """Which of these make the heaviest chain of rising places; of equal ones that with the earliest. A tree of prefixes holds the best chain that ends before a place."""
    rank = {j: k for k, j in enumerate(sorted(places), 1)}
    tree = [(0, 1)] * (len(rank) + 1)  # weight, the negative of the last one's number
    last: list[int] = []
    best = (0, 1)
    for k, (j, n) in enumerate(zip(places, weights, strict=True)):
        at, before = rank[j] - 1, (0, 1)
        while at:
            before, at = max(before, tree[at]), at & (at - 1)
        last.append(-before[1])
        now, at = (before[0] + n, -k), rank[j]
        while at < len(tree):
            tree[at], at = max(tree[at], now), at + (at & -at)
        best = max(best, now)
    kept, k = [], -best[1]
    while k >= 0:
        kept.append(k)
        k = last[k]
    return kept[::-1]


@F.udf(ArrayType(IntegerType()), useArrow=True)
def _heaviest(places, weights):
    return heaviest([int(j) for j in places], [int(n) for n in weights])


def chained(blocks: DataFrame, width: int) -> DataFrame:
    """The blocks with ``runs`` and with ``chain``, those of the heaviest chain of them that rises on both sides."""
    found = blocks.withColumn("runs", runs(anchors(width)))
    kept = found.withColumn("kept", _heaviest(F.col("runs")["j"], F.col("runs")["n"]))
    return kept.withColumn("chain", F.transform("kept", lambda k: F.get(F.col("runs"), k))).drop("kept")


def segments(width: int) -> Column:
    """(i, j, n): the equal words of a block's chain, in its texts; where two runs' last and first words overlap, the earlier run keeps them."""

    def cut(x: Column, k: Column) -> Column:
        before = F.get(F.col("chain"), k - 1)
        end = before["n"] + width - 1
        over = F.coalesce(F.greatest(F.lit(0), before["i"] + end - x["i"], before["j"] + end - x["j"]), F.lit(0))
        return F.struct((F.col("i0") + x["i"] + over).alias("i"), (F.col("j0") + x["j"] + over).alias("j"), (x["n"] + width - 1 - over).alias("n"))

    return F.transform("chain", cut)


def gaps(blocks: DataFrame, lone: bool = False) -> DataFrame:
    """The blocks with ``gaps``, (i0, j0, wa, wb): what lies between the ``equal`` words and has words on both sides; with ``lone`` also what has them on one side."""
    end = F.array(F.struct((F.col("i0") + F.size("wa")).alias("i"), (F.col("j0") + F.size("wb")).alias("j"), F.lit(0).alias("n")))

    def between(rows: Column) -> Column:
        after = lambda k, c: F.coalesce(F.get(rows, k - 1)[c] + F.get(rows, k - 1)["n"], F.col(f"{c}0"))
        return F.filter(F.transform(rows, lambda x, k: F.struct(after(k, "i").alias("u"), after(k, "j").alias("v"), x["i"].alias("i"), x["j"].alias("j"))), lambda g: (g["i"] > g["u"]) | (g["j"] > g["v"]) if lone else (g["i"] > g["u"]) & (g["j"] > g["v"]))

    def words(g: Column, c: str, u: str, i: str, first: str) -> Column:  # a slice would unpack all words for each gap
        said = F.transform(F.sequence(g[u] - F.col(first), g[i] - F.col(first) - 1), lambda k: F.get(F.col(c), k))
        return F.when(g[i] > g[u], said).otherwise(F.array().cast("array<string>")) if lone else said

    found = blocks.withColumn("gaps", _with(F.concat("equal", end), between))
    return found.withColumn("gaps", F.transform("gaps", lambda g: F.struct(g["u"].alias("i0"), g["v"].alias("j0"), words(g, "wa", "u", "i", "i0").alias("wa"), words(g, "wb", "v", "j", "j0").alias("wb"))))


def _trimmed(blocks: DataFrame) -> DataFrame:
    """The blocks with la, lb, their words' numbers, and head and tail: how many words are equal at the beginning, and at the end where they are others."""

    def leading(x: Column, y: Column) -> Column:
        """How many first words agree."""
        short = F.least(F.size(x), F.size(y))
        first = F.array_position(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), False).cast("int")
        return F.when(first == 0, short).otherwise(F.least(short, first - 1))

    head = blocks.withColumn("head", leading(F.col("wa"), F.col("wb"))).withColumn("la", F.size("wa")).withColumn("lb", F.size("wb"))
    return head.withColumn("tail", F.least(leading(F.reverse("wa"), F.reverse("wb")), F.least("la", "lb") - F.col("head")))


def ends(blocks: DataFrame) -> DataFrame:
    """a, b, i, j, n: equal words at the beginning of a block, and at its end where they are others."""
    both = F.array(F.struct(F.col("i0").alias("i"), F.col("j0").alias("j"), F.col("head").alias("n")), F.struct((F.col("i0") + F.col("la") - F.col("tail")).alias("i"), (F.col("j0") + F.col("lb") - F.col("tail")).alias("j"), F.col("tail").alias("n")))
    return _trimmed(blocks).select(*PAIR, F.inline(both)).filter("n > 0")


def changed(pairs: DataFrame, rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
    """a, b, i1, i2, j1, j2, wa, wb: the operations but the equal ones, with their words. A round's gaps that have words on one side are changes already, and so is what the ends of the last gaps leave; as each is cut out of its block, no text is joined again."""
    same, none, zero = F.col("wa") == F.col("wb"), F.array().cast("array<string>"), F.lit(0)
    blocks = pairs.select(*PAIR, zero.alias("i0"), zero.alias("j0"), *(F.when(same, none).otherwise(F.col(c)).alias(c) for c in ("wa", "wb")))
    both, out = (F.size("wa") > 0) & (F.size("wb") > 0), None
    for width in rounds:
        done = settled(gaps(chained(blocks, width).withColumn("equal", segments(width)), lone=True).select(*PAIR, "gaps"))
        each = done.select(*PAIR, F.inline("gaps"))
        lone, blocks = each.filter(~both), each.filter(both)
        out = lone if out is None else out.unionByName(lone)
    left = lambda c, n: F.slice(c, F.col("head") + 1, F.col(n) - F.col("head") - F.col("tail")).alias(c)
    rest = _trimmed(blocks).filter("greatest(la, lb) > head + tail").select(*PAIR, *((F.col(c) + F.col("head")).alias(c) for c in ("i0", "j0")), left("wa", "la"), left("wb", "lb"))
    end = lambda c, words: F.col(c) + F.size(words)
    return out.unionByName(rest).select(*PAIR, F.col("i0").alias("i1"), end("i0", "wa").alias("i2"), F.col("j0").alias("j1"), end("j0", "wb").alias("j2"), "wa", "wb")


def matched(pairs: DataFrame, rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
    """a, b, i, j, n: equal words of both sides, rising, and the end of both (n = 0). Each round's equal words and gaps are a table; of the words it has those of the gaps alone. Equal texts are one run, as their anchors would find, and have no block."""
    same = F.col("wa") == F.col("wb")
    none, zero = F.array().cast("array<string>"), F.lit(0)
    sides = pairs.select(*PAIR, same.alias("same"), F.size("wa").alias("la"), F.size("wb").alias("lb"), *(F.when(same, none).otherwise(F.col(c)).alias(c) for c in ("wa", "wb")))
    blocks = sides.select(*PAIR, zero.alias("i0"), zero.alias("j0"), "wa", "wb", "same", "la", "lb")
    out = None
    for width in rounds:
        found = gaps(chained(blocks, width).withColumn("equal", segments(width)))
        if out is None:
            point = lambda i, j, n: F.array(F.struct(i.alias("i"), j.alias("j"), n.alias("n")))
            found = found.withColumn("equal", F.concat(F.when(F.col("same"), point(zero, zero, F.col("la"))).otherwise(F.col("equal")), point(F.col("la"), F.col("lb"), zero)))
        done = settled(found.select(*PAIR, "equal", "gaps"))
        equal = done.select(*PAIR, F.inline("equal"))
        out = equal if out is None else out.unionByName(equal)
        blocks = done.select(*PAIR, F.inline("gaps"))
    return out.unionByName(ends(blocks))


def operations(pairs: DataFrame, rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
    """a, b, seq, op, i1, i2, j1, j2: equal, replace, delete and insert, in order; they tile both sequences. The pairs are aligned in the tasks they come in: who makes them deals them, while they are texts."""
    order = Window.partitionBy(*PAIR).orderBy("i", "j", F.desc("n"))
    before = lambda c: F.coalesce(F.lag(F.col(c) + F.col("n")).over(order), F.lit(0))
    rows = matched(pairs, rounds).select(*PAIR, before("i").alias("u"), before("j").alias("v"), "i", "j", "n")
    apart = (F.col("i") > F.col("u")) | (F.col("j") > F.col("v"))
    changed = rows.filter(apart).select(*PAIR, F.when(F.col("j") == F.col("v"), "delete").when(F.col("i") == F.col("u"), "insert").otherwise("replace").alias("op"), F.col("u").alias("i1"), F.col("i").alias("i2"), F.col("v").alias("j1"), F.col("j").alias("j2"))
    runs_ = rows.withColumn("run", F.sum(apart.cast("int")).over(order)).filter("n > 0").groupBy(*PAIR, "run")
    same = runs_.agg(F.lit("equal").alias("op"), F.min("i").alias("i1"), F.max(F.col("i") + F.col("n")).alias("i2"), F.min("j").alias("j1"), F.max(F.col("j") + F.col("n")).alias("j2")).drop("run")
    seq = F.row_number().over(Window.partitionBy(*PAIR).orderBy("i1", "j1", "i2", "j2")) - 1
    return same.unionByName(changed).select(*PAIR, seq.alias("seq"), "op", "i1", "i2", "j1", "j2")


def summary(pairs: DataFrame, width: int = ROUNDS[0]) -> DataFrame:
    """a, b, anchors, runs, chain: of the first round, how many anchors and runs there are and how many anchors the heaviest chain has."""
    total = lambda c, n: F.aggregate(F.col(c)["n"], F.lit(0).cast("long"), lambda s, x: s + x).alias(n)
    return chained(whole(pairs), width).select(*PAIR, total("runs", "anchors"), F.size("runs").cast("long").alias("runs"), total("chain", "chain"))
