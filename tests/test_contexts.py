"""References in context: literal cases, and forms that stay as they are when resolved again."""

import pytest

from vellumq.operators import contexts as C

CHAPTERS = [("Genesis", 1, 31), ("Genesis", 2, 25), ("Psalms", 23, 6), ("Psalms", 32, 11), ("Psalms", 109, 31), ("Jude", 1, 25), ("1 Samuel", 14, 52), ("Isaiah", 10, 34), ("Isaiah", 27, 13), ("Song of Solomon", 2, 17), ("2 Timothy", 1, 18)]


@pytest.fixture(scope="module")
def run(spark):
    chapters = spark.createDataFrame(CHAPTERS, "book string, chapter int, n int")

    def over(texts):
        docs = spark.createDataFrame([(i, t, "kept", 7) for i, t in enumerate(texts)], "doc_id bigint, text string, book string, run int").repartition(3)
        rows = C.resolved(C.signs(docs), chapters).cache()
        new = {r.doc_id: (r.changed, r.text) for r in C.restyled(docs, C.written(rows)).collect()}
        found = {}
        for r in sorted(rows.collect(), key=lambda r: (r.doc_id, r.run, r.n)):
            found.setdefault(r.doc_id, []).append((r.book, r.chapter, r.verse, r.upto, r.valid))
        return found, new

    return over


def test_literal_cases(run):
    cases = {
        "Gen. ii. 7, so ver. 9.": ([("Genesis", 2, 7, None, True), ("Genesis", 2, 9, None, True)], "Genesis 2:7, so v. 9."),
        "in Isa. 10. 17. and 27. 4. now": ([("Isaiah", 10, 17, None, True), ("Isaiah", 27, 4, None, True)], "in Isaiah 10:17; 27:4. now"),
        "Ps. 32, 109 both": ([("Psalms", 32, None, None, True), ("Psalms", 109, None, None, True)], "Psalms 32, 109 both"),
        "Ps. 32, 9 alone": ([("Psalms", 32, 9, None, True)], "Psalms 32:9 alone"),
        "Jude 5, 7": ([("Jude", 1, 5, None, True), ("Jude", 1, 7, None, True)], "Jude 5, 7"),
        "of 1. Sam. 14 27; and": ([("1 Samuel", 14, 27, None, True)], "of 1 Samuel 14:27; and"),
        "Song of Songs ii. 3": ([("Song of Solomon", 2, 3, None, True)], "Song of Solomon 2:3"),
        "II Tim. i. 9-12 & 14": ([("2 Timothy", 1, 9, 12, True), ("2 Timothy", 1, 14, None, True)], "2 Timothy 1:9–12, 14"),
        "Ps. 23. 7 isn't there": ([("Psalms", 23, 7, None, False)], "Ps. 23. 7 isn't there"),
        "Ps. 23. 1-9": ([("Psalms", 23, 1, 9, False)], "Ps. 23. 1-9"),
        "Ps. 23. 6\nver. 2": ([("Psalms", 23, 6, None, True)], "Psalms 23:6\nver. 2"),
        "ver. 2 of nothing": (None, "ver. 2 of nothing"),
        "Genuine 2. 7": (None, "Genuine 2. 7"),
        "Gen. 1. 2; 2. 3, 1. 4": ([("Genesis", 1, 2, None, True), ("Genesis", 2, 3, None, True), ("Genesis", 1, 4, None, True)], "Genesis 1:2; 2:3; 1:4"),
    }
    found, new = run(list(cases))
    for i, (text, (rows, after)) in enumerate(cases.items()):
        assert found.get(i) == rows, text
        assert new[i][1] == after, text


def test_odd_texts(run):
    long = "word " * 200_000 + "Gen. 1. 2 and ver. 3"
    found, new = run([None, "", "no reference", long, "Gen. 1. 2", "Gen. 1. 2"])
    assert [new[i] for i in range(3)] == [(0, None), (0, ""), (0, "no reference")]
    assert new[3] == (2, long.replace("Gen. 1. 2 and ver. 3", "Genesis 1:2 and v. 3"))
    assert new[4] == new[5] == (1, "Genesis 1:2") and found[4] == found[5]
    assert run([]) == ({}, {})


def test_new_forms_say_the_same(run):
    texts = ["Gen. ii. 7, so ver. 9 and chap. 1. 3; verses 4-6", "Isa. 10. 17. and 27. 4.", "Ps. 32, 109; Jude 5, 7", "1 Sam 14 27. II. Tim. i. 9-12, 14"]
    found, new = run(texts)
    again, same = run([new[i][1] for i in range(len(texts))])
    assert again == found and [same[i][1] for i in range(len(texts))] == [new[i][1] for i in range(len(texts))]


def test_roman_values(spark):
    from vellumq.operators.align import roman

    numerals = ["i", "iv", "ix", "xiv", "xl", "xlix", "xcix", "cxix", "cxliv", "cl"]
    got = spark.createDataFrame([(x,) for x in numerals], "w string").select("w", C.roman(C.F.col("w"))).collect()
    assert {r[0]: r[1] for r in got} == {x: roman(x) for x in numerals}


def test_only_texts_with_a_name_and_its_number_are_cut(spark):
    """Texts that only begin like a name ("Then 5") are left out; those with one stay, wherever blanks and capitals stand."""
    inside = ["Then 5 and Gen . ii. 7", "Then 5, GEN.2.7", "They 5; 1 Sam 14. 27", "So 5, Song of Songs ii. 3", "Chap 2. Isa x", "The 3\nJude 5"]
    outside = ["Then 5", "Then 12 came to John, in 5 days", "Genuine 2. 7", "Job could do 5", "Gen. 1234", "Gen 3rd", "gen 2"]
    docs = spark.createDataFrame(list(enumerate(inside + outside)), "doc_id bigint, text string")
    assert {r.doc_id for r in C.signs(docs).select("doc_id").distinct().collect()} == set(range(len(inside)))
    assert docs.filter(docs.text.rlike(C.beginnings()) != docs.text.rlike(C.quick_beginnings())).isEmpty()
