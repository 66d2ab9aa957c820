"""Unified differences: those of the standard library where lines stand once, and hunks that give the other text whatever the lines are."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from vellumq.operators import anchored as N
from vellumq.operators import unified as U


def made(spark, texts):
    rows = spark.createDataFrame([(2 * i, 2 * i + 1, *t) for i, t in enumerate(texts)], "a bigint, b bigint, text_a string, text_b string").repartition(3)
    own = U.lines(rows).cache()
    return own, U.hunks(own, N.operations(own, (1,))).cache()


def edited(r, lines, pool):
    out = [x for x in lines if r.random() > 0.08]
    for _ in range(r.randrange(4)):
        out.insert(r.randrange(len(out) + 1), pool())
    return out


def test_hunks_as_in_the_standard_library(spark):
    r, n = random.Random(5), iter(range(10**6))
    texts = []
    for size in [3, 10, 30, 60] * 6:
        lines = [f"line {next(n)}" for _ in range(size)]
        texts.append(("\n".join(lines), "\n".join(edited(r, lines, lambda: f"new {next(n)}")) or "all new"))
    _, found = made(spark, texts)
    got = {}
    for h in found.orderBy("a", "hunk").collect():
        got.setdefault(h.a // 2, []).extend([h.header, *h.body])
    for i, (x, y) in enumerate(texts):
        assert got.get(i, []) == list(difflib.unified_diff(x.split("\n"), y.split("\n"), lineterm=""))[2:], (x, y)


def test_patches_give_the_other_text(spark):
    r = random.Random(6)
    texts = [("", ""), (None, "a"), ("a\nb", None), ("a", "a"), ("x\n\n\n", "\n\nx\n"), ("-a\n+b\n c", "+b\n-a\n c\n@@"), ("é\nsame", "É\nsame")]
    for _ in range(40):
        lines = [r.choice(["a", "b", "", "c d", " e"]) for _ in range(r.randrange(50))]
        texts.append(("\n".join(lines), "\n".join(edited(r, lines, lambda: r.choice(["a", "z", ""])))))
    own, found = made(spark, texts)
    got = {x.a // 2: x.text for x in U.patched(own, found).collect()}
    assert got == {i: y or "" for i, (_, y) in enumerate(texts)}
    assert {h.a // 2 for h in found.collect()} == {i for i, (x, y) in enumerate(texts) if (x or "") != (y or "")}


def test_a_hunk_that_does_not_fit(spark):
    own, found = made(spark, [("a\nb\nc", "a\nq\nc")])
    other = own.withColumn("wa", F.array(F.lit("a"), F.lit("other"), F.lit("c")))
    with pytest.raises(Exception, match="doesn't fit"):
        U.patched(other, found).collect()
