import pytest
from pyspark.sql import functions as F

from vellumq.functions import text as T
from vellumq.operators import select as C
from vellumq.operators import tokens as K

WORDS = [(0, "He", 0.0, None, -15.0), (1, "came", -1.0, "went", -1.0), (2, "to", -0.1, "to", -0.1), (3, "them.", -2.0, None, -15.0), (4, "And", 0.0, None, -15.0), (5, "or", -16.0, "the", -0.5), (6, "God", -0.2, None, -15.0), (7, "spoke.", -1.0, None, -15.0)]


def scored(spark):
    rows = spark.createDataFrame(WORDS, "i int, word string, lp double, best string, best_lp double")
    rows = rows.withColumn("sent_no", F.when(F.col("i") < 4, 0).otherwise(1)).withColumn("at", F.when(F.col("i") < 4, F.col("i")).otherwise(F.col("i") - 4))
    return rows.select(F.lit(1).alias("doc_id"), "sent_no", "at", "word", T.word_score(F.col("word"), F.col("lp"), F.col("best"), F.col("best_lp")).alias("score"))


def test_strongest_sentence(spark):
    s = C.sentence_scores(scored(spark))
    by = {r.sent_no: r for r in s.collect()}
    assert by[1].score == 15.0 and by[1].strongest == 1 and by[0].score == 2.0
    assert [r.sent_no for r in C.budget_top(s, 0.5).collect()] == [1]
    assert C.budget_top(s, 0.0).count() == 0 and C.budget_top(s, 1.0).count() == 2


def test_ties_by_the_second_word(spark):
    rows = [(1, 0, 4, [15.0, 2.0]), (1, 1, 4, [15.0, 9.0]), (1, 2, 4, [3.0])]
    s = spark.createDataFrame(rows, "doc_id long, sent_no int, words long, strength array<double>")
    assert [r.sent_no for r in C.budget_top(s, 0.3).collect()] == [1]
    two = spark.createDataFrame([(1, 0, 1, [15.0, 9.0]), (1, 1, 1, [15.0])], "doc_id long, sent_no int, words long, strength array<double>")
    assert [r.sent_no for r in C.budget_top(two, 0.5).collect()] == [1]  # of two equal up to the shorter's end the shorter comes first


def test_running_budget_by_brute_force(spark):
    import random

    r = random.Random(3)
    data = [(i, r.randint(1, 9)) for i in range(500)]
    rows = spark.createDataFrame(data, "k int, w int").repartition(5)
    used, want = 0, set()
    for k, w in data:
        if used >= 700:
            break
        want.add(k)
        used += w
    assert {x.k for x in C.taken(rows, [F.col("k").asc()], "w", F.lit(700)).collect()} == want


def test_sample_is_stable(spark):
    rows = spark.createDataFrame([(i, 3) for i in range(300)], "k int, w int")
    a, b = (sorted(x.k for x in C.hash_sample(rows.repartition(n), 5, 0.1, "w", "k").collect()) for n in (1, 7))
    assert a == b and len(a) == 30
    assert a != sorted(x.k for x in C.hash_sample(rows, 6, 0.1, "w", "k").collect())


def test_spans(spark):
    targets = spark.createDataFrame([("f", 10, 11), ("f", 500, 501), ("g", 10, 11)], "file string, w1 int, w2 int")
    flags = spark.createDataFrame([("f", 14, 15), ("f", 600, 601), ("f", 3, 8)], "file string, a int, b int")
    assert {(r.file, r.w1) for r in C.spans_hit(targets, flags).collect()} == {("f", 10)}
    got = C.caught(targets, flags).first()
    assert (got.planted, got.caught, got.flags, got.false_alarms) == (3, 1, 3, 1)
    inside = C.covered_by(targets, spark.createDataFrame([("f", 11, 20)], "file string, a int, b int"))
    assert [r.w1 for r in inside.collect()] == [10]


def test_planted(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(30 + i))) for i in range(0, 90, 10)] + [(999, None)], "doc_id long, text string")
    got = C.plant_doubles(docs).collect()
    assert {r.doc_id for r in got} == {i for i in range(10, 90, 10)}
    for r in got:
        w = r.text.split()
        assert w[r["at"]] == w[r["at"] + 1] == r.word and len(w) == 31 + r.doc_id
    flagged = spark.createDataFrame([(1, "a b b c that that x x x")], "doc_id long, text string").select(K.doubled_places(T.spaced_words(F.col("text")))).first()[0]
    assert flagged == [1, 6, 7]


def test_chunks(spark):
    docs = spark.createDataFrame([(1, "a b\nc d e\nf\n" + "g " * 12), (2, None), (3, "")], "doc_id long, text string")
    assert [(r.doc_id, r.chunk, r.first_line, r.lines, r.words) for r in C.chunks(docs, 5).orderBy("doc_id", "chunk").collect()] == [(1, 0, 0, 2, 5), (1, 1, 2, 1, 1), (1, 2, 3, 1, 12), (3, 0, 0, 1, 0)]


def test_marked_line(spark):
    row = spark.createDataFrame([(["Two", "ship", "sailed", "north"],)], "w array<string>")
    line = lambda guess: row.select(C.marked_line(F.col("w"), F.lit(1), F.lit(7.25), F.lit(12), guess)).first()[0]
    assert line(F.lit("ships")) == "12  7.3 Two [[ship]](ships?) sailed north"
    assert line(F.lit(None).cast("string")) == line(None) == "12  7.3 Two [[ship]] sailed north"


def test_words_in_context(spark):
    docs = spark.createDataFrame([(1, "a b From c d"), (2, None), (3, "from")], "doc_id long, text string")
    assert {(r.doc_id, r.pos, r.context) for r in K.keyword_in_context(docs, "from", 1).collect()} == {(1, 2, "b From c"), (3, 0, "from")}
    assert [(r.doc_id, r.pos) for r in K.proximity(spark.createDataFrame([(1, "x y b x q q q q x")], "doc_id long, text string"), "x", "b", 2).orderBy("pos").collect()] == [(1, 0), (1, 3)]
    refs = spark.createDataFrame([(["see", "Gen", "3", "4", "Mark", "it"],)], "w array<string>")
    assert refs.select(K.without_references(F.col("w"))).first()[0] == ["see", "Mark", "it"]
    assert refs.select(K.modern_words(F.array(F.lit("&"), F.lit("xiv"), F.lit("a")))).first()[0] == ["and", "a"]
    blocks = K.blocks(spark.createDataFrame([(1, "\na\nb\n\n \nc")], "doc_id long, text string")).orderBy("line_no").collect()
    assert [(r.line_no, r.block) for r in blocks] == [(2, "a\nb"), (6, "c")]


@pytest.mark.parametrize(("n", "found"), [(41, True), (39, False)])
def test_looped(spark, n, found):
    docs = spark.createDataFrame([(1, " ".join(["go"] * n))], "doc_id long, text string")
    assert (K.looped(docs).count() == 1) == found
