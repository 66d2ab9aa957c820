"""Alignment by anchors against brute force, and the rewrites of streams, each on texts of its own."""

import random
import time

import pytest
from pyspark.sql import functions as F

from vellumq.operators import anchored as N
from vellumq.operators import streams as M

SCHEMA = "a bigint, b bigint, text_a string, text_b string"


def pairs(spark, texts):
    return spark.createDataFrame([(2 * i, 2 * i + 1, *t) for i, t in enumerate(texts)], SCHEMA).repartition(3)


def changed(r, words):
    """The words with some left out, put in, exchanged, and a stretch moved."""
    out = [w for w in words if r.random() > 0.1]
    for _ in range(len(out) // 8):
        out.insert(r.randrange(len(out) + 1), r.choice(["new", "word", "here", words[0]]))
    if len(out) > 20:
        at, to = r.randrange(len(out) - 10), r.randrange(len(out) - 10)
        piece, out = out[at : at + 6], out[:at] + out[at + 6 :]
        out[to:to] = piece
    return out


@pytest.fixture(scope="module")
def texts():
    r = random.Random(8)
    made = []
    for n in (1, 5, 30, 120):
        words = [f"w{r.randrange(n)}" for _ in range(n)]
        made += [(" ".join(words), " ".join(changed(r, words))) for _ in range(3)]
    words = [f"x{i}" for i in range(60)]
    return [*made, (" ".join(words), " ".join(words[40:] + words[:40])), ("same text here", "same text here"), ("", "some words"), (None, None), ("all of it goes", None), ("a a a a", "a a"), ("p q r", "s t u"), ("the end", "The END")]


def rising(points):
    """The greatest number of points that rise on both sides."""
    points = sorted(points)
    best = []
    for k, (_, j) in enumerate(points):
        best.append(1 + max([best[m] for m in range(k) if points[m][1] < j], default=0))
    return max(best, default=0)


def once(words, width):
    grams = [tuple(words[k : k + width]) for k in range(len(words) - width + 1)]
    return {g: k for k, g in enumerate(grams) if grams.count(g) == 1}


def test_chains_by_brute_force(spark, texts):
    got = {r.a: r for r in N.summary(N.lowered_words(pairs(spark, texts))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        x, y = (once((s or "").lower().split(), 3) for s in t)
        points = [(x[g], y[g]) for g in x.keys() & y.keys()]
        assert (got[2 * i].anchors, got[2 * i].chain) == (len(points), rising(points)), t


@pytest.mark.parametrize("rounds", [(3, 1), (1,), (4, 2, 1, 1)])
def test_operations_tile_and_equal_words_are_equal(spark, texts, rounds):
    got = {}
    for r in N.operations(N.lowered_words(pairs(spark, texts)), rounds).orderBy("a", "seq").collect():
        got.setdefault(r.a // 2, []).append(r)
    for i, t in enumerate(texts):
        x, y = ((s or "").lower().split() for s in t)
        u = v = 0
        for n, o in enumerate(got.get(i, [])):
            assert (o.seq, o.i1, o.j1) == (n, u, v)
            u, v = o.i2, o.j2
            assert (o.op == "equal") == (x[o.i1 : o.i2] == y[o.j1 : o.j2])
            assert o.op == ("equal" if o.op == "equal" else "insert" if o.i1 == o.i2 else "delete" if o.j1 == o.j2 else "replace")
        assert (u, v) == (len(x), len(y))
    same = texts.index(("same text here", "same text here"))
    assert [(o.op, o.i2) for o in got[same]] == [("equal", 3)]
    turned = next(i for i, t in enumerate(texts) if t[0] and t[0].startswith("x0 ") and "x59 x0 " in t[1])
    assert sum(o.i2 - o.i1 for o in got[turned] if o.op == "equal") == 40  # of two runs the longer one


REWRITES = [
    ("he owned farm IX. The river\nwas near to us", "he owned farm.\n+ The river\nwas near to us"),
    ("it was very late! quoth one of them!\nThen all of us left", "it was very late!\nThen all of us left"),
    ("first words of the page\nlost line\n3) plums and pears grow", "first words of the page\n+ quinces and pears grow"),
    ("a plain line of words\nand one more of them", "a plain line of words\nand two more of them"),
]


def rewritten(spark, texts):
    own = M.streams(pairs(spark, texts))
    out = {}
    for r in M.rewritten(N.operations(own), own).orderBy("a", "seq").collect():
        out.setdefault(r.a // 2, []).append(r)
    return {r.a // 2: (r.wa, r.wb) for r in own.collect()}, out


def test_rewrites(spark):
    streams, out = rewritten(spark, REWRITES)
    changes = lambda i: [(o.op, o.src, o.tgt) for o in out[i] if o.op != "equal"]
    assert changes(0) == [("insert", [], ["."]), ("replace", ["IX", "."], ["\x02+"])]
    assert changes(1) == [("delete", ["quoth", "one", "of", "them", "!"], [])]
    assert changes(2) == [("delete", ["\x02¶", "lost", "line"], []), ("replace", ["\x02¶", "3", ")", "plums"], ["\x02+", "quinces"])]
    assert changes(3) == [("replace", ["one"], ["two"])]
    for i, (x, y) in streams.items():  # still tiles, and what a change says stands there
        assert [(o.i1, o.j1) for o in out[i]] == [(0, 0), *[(o.i2, o.j2) for o in out[i][:-1]]] and (out[i][-1].i2, out[i][-1].j2) == (len(x), len(y))
        assert all(o.src == x[o.i1 : o.i2] and o.tgt == y[o.j1 : o.j2] if o.op != "equal" else x[o.i1 : o.i2] == y[o.j1 : o.j2] for o in out[i])


def test_rewrites_keep_random_streams_whole(spark):
    r = random.Random(3)
    piece = lambda: r.choice(["one", "two", "three", "IV", ".", ")", "!", "\n", "\n+ ", "\n= ", "four"])
    made = []
    for _ in range(40):
        left = [piece() for _ in range(r.randrange(30))]
        made.append((" ".join(left).replace(" \n", "\n"), " ".join(changed(r, left) if left else []).replace(" \n", "\n")))
    streams, out = rewritten(spark, made)
    for i, (x, y) in streams.items():
        assert [(o.i1, o.j1) for o in out[i]] == [(0, 0), *[(o.i2, o.j2) for o in out[i][:-1]]] and (out[i][-1].i2, out[i][-1].j2) == (len(x), len(y))
        assert all(x[o.i1 : o.i2] == y[o.j1 : o.j2] for o in out[i] if o.op == "equal")
        assert all(o.src == x[o.i1 : o.i2] and o.tgt == y[o.j1 : o.j2] for o in out[i] if o.op != "equal")


def test_streams(spark):
    rows = spark.createDataFrame([("= A head\n  + it’s 5.\n\nx",), (None,), ("",)], "t string").select(M.stream(F.col("t")).alias("s")).collect()
    assert rows[0].s == ["\x02=", "A", "head", "\x02+", "it’s", "5", ".", "\x02¶", "\x02¶", "x"] and rows[1].s == rows[2].s == ["\x02¶"]


def test_heaviest_chain_by_brute_force():
    r = random.Random(5)
    for _ in range(200):
        places = r.sample(range(40), r.randrange(12))
        weights = [r.randrange(1, 4) for _ in places]
        best, state = (0, 1), []
        for j, n in zip(places, weights, strict=True):  # the greatest weight before, of the first place that has it
            before = max([(w, -k) for k, (w, _, at) in enumerate(state) if at < j], default=(0, 1))
            state.append((before[0] + n, -before[1], j))
        k = max([(w, -k) for k, (w, _, _) in enumerate(state)], default=best)[1]
        want = []
        while k <= 0:
            want.append(-k)
            k = -state[-k][1]
        assert N.heaviest(places, weights) == want[::-1]


def test_chains_of_many_runs_without_their_square(spark):
    words = [f"x{k}" for k in range(12_000)]
    text_a, text_b = " ".join(words), " ".join(w for k in range(0, 12_000, 2) for w in (words[k + 1], words[k]))
    rows = spark.createDataFrame([(0, 1, text_a, text_b)], SCHEMA)
    begun = time.time()
    got = N.operations(N.lowered_words(rows), (1,)).filter("op = 'equal'").agg(F.sum(F.col("i2") - F.col("i1"))).collect()[0][0]
    assert got == 6_000 and time.time() - begun < 40


def test_rounds_shuffle_no_words(spark):
    rows = pairs(spark, [("one two three four", "one two four three")])
    plan = N.chained(N.whole(N.lowered_words(rows)), 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the test's own repartition


def test_rounds_write_the_words_of_gaps_alone(spark, monkeypatch):
    tables = []

    def held(df, settled=N.settled):
        tables.append(df)
        return settled(df)

    monkeypatch.setattr(N, "settled", held)
    words = [f"x{k}" for k in range(500)]
    rows = pairs(spark, [(" ".join(words), " ".join([*words[:250], "other", "words", *words[251:]])), (" ".join(words), " ".join(words))])
    got = N.operations(N.lowered_words(rows)).orderBy("a", "seq").collect()
    assert [(o.op, o.i1, o.i2, o.j1, o.j2) for o in got] == [("equal", 0, 250, 0, 250), ("replace", 250, 251, 250, 252), ("equal", 251, 500, 252, 501), ("equal", 0, 500, 0, 500)]
    strings = lambda x: 1 if isinstance(x, str) else sum(map(strings, x)) if isinstance(x, (list, tuple)) else 0
    assert sum(strings(r) for t in tables for r in t.collect()) <= 6  # one word and two, in either round's gaps
    assert tables[0]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange") == 1  # the test's own repartition: texts are dealt before, words are not
