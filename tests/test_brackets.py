"""Body and notes parted by brackets: literal cases, and random texts against a loop over characters."""

import random

from vellumq.operators import brackets as B


def parts(text):
    """The same, one character after another."""
    out, depth, deepest, now, i = {0: [0, ""]}, 0, 0, 0, 0
    while i < len(text):
        c = text[i : i + 2] if text[i] == "\\" else text[i]
        i += len(c)
        if c in ("(", "["):
            depth += 1
            if depth == 1:
                now += 1
                out[now] = [0, ""]
        part = out[now] if depth else out[0]
        part[0], part[1] = max(part[0], depth), part[1] + c
        if c in (")", "]") and depth:
            depth -= 1
    return {(k, d, t) for k, (d, t) in out.items()}


def found(spark, texts):
    got = {i: set() for i in range(len(texts))}
    for r in B.parted(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)).collect():
        got[r.doc_id].add((r.part, r.depth, r.text))
    return got


def test_literal_cases(spark):
    got = found(spark, ["a (b [c (d)] e) f) g", "x \\( y (z \\) w) v", "open [to the (end", "(only)[notes]", None, ""])
    assert got[0] == {(0, 0, "a  f) g"), (1, 3, "(b [c (d)] e)")}
    assert got[1] == {(0, 0, "x \\( y  v"), (1, 1, "(z \\) w)")}
    assert got[2] == {(0, 0, "open "), (1, 2, "[to the (end")}
    assert got[3] == {(0, 0, ""), (1, 1, "(only)"), (2, 1, "[notes]")}
    assert got[4] == got[5] == {(0, 0, "")}


def test_random_texts(spark):
    r = random.Random(1)
    texts = ["".join(r.choice(["(", ")", "[", "]", "\\", "a", "é b", "\n"]) for _ in range(r.randrange(60))) for _ in range(120)]
    got = found(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == parts(t), t
