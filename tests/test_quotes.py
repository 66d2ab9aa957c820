"""Quotation marks turned: literal cases, and random lines against a loop over characters."""

import random
import unicodedata

from vellumq.operators import quotes as Q


def loop(line):
    """The same, one character after another, with a list as the stack."""
    out, stack, deepest, last = "", [], 0, " "
    for c in line:
        kind = {"'": "s", '"': "d"}.get(c)
        if kind:
            opening, closing, prime = Q.SIGNS[kind]
            within = stack[-1:] == [kind]
            if within and not (last.isspace() or last in "([{"):
                stack.pop()
                c = closing
            elif not within and unicodedata.category(last)[0] == "N":
                c = prime
            elif not within and kind == "s" and last.isalpha():
                c = Q.APOSTROPHE
            else:
                stack.append(kind)
                c = opening
            deepest = max(deepest, len(stack))
        out, last = out + c, c
    return out, deepest, len(stack)


def found(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    return {r.doc_id: r for r in Q.texts(rows).collect()}


def test_literal_cases(spark):
    got = found(spark, ["\"We say 'yes'.\" They're 6' tall", "('a')\n\"b", "", None, "none\n", "'80s \"\"", "x" * 5000 + "'\"" * 300])
    assert got[0].text == "“We say ‘yes’.” They’re 6′ tall" and (got[0].marks, got[0].deepest, got[0].left) == (6, 2, 0)
    assert got[1].text == "(‘a’)\n“b" and (got[1].deepest, got[1].left) == (1, 1)
    assert [(got[i].text, got[i].marks, got[i].deepest, got[i].left) for i in (2, 3, 4)] == [("", 0, 0, 0), ("", 0, 0, 0), ("none\n", 0, 0, 0)]
    assert got[5].text == "‘80s “”" and got[6].marks == 600


def test_random_lines(spark):
    r = random.Random(4)
    texts = ["\n".join("".join(r.choice(["'", '"', "'", '"', " ", "a", "é", "5", "½", "(", "[", ",", " "]) for _ in range(r.randrange(25))) for _ in range(r.randrange(1, 4))) for _ in range(300)]
    got = found(spark, texts)
    for i, t in enumerate(texts):
        want = [loop(x) for x in t.split("\n")]
        assert (got[i].text, got[i].deepest, got[i].left) == ("\n".join(w[0] for w in want), max(w[1] for w in want), sum(w[2] for w in want)), t
        assert len(got[i].text) == len(t)
