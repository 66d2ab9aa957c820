"""Many names at once: literal cases, and random texts against a regular expression of all forms."""

import random

import pytest
import regex

from vellumq.operators import names as N


def found(spark, texts, forms, **kw):
    rows = N.found(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2), spark.createDataFrame(forms, "form string, name string"), **kw)
    return sorted((r.doc_id, r.start, r.end, r.name) for r in rows.collect())


def test_literal_cases(spark):
    forms = [("John", "John"), ("1 John", "1 John"), ("Song", "Song"), ("Song of Solomon", "Song of Solomon"), ("John", "a second one"), ("", "nothing"), ("a\0b", "never")]
    texts = ["1 John and John, Johnny", "Song of Solomons", "Song of Solomon", None, "", "aJohn John2 éJohn", "John John", "a\0b John"]
    assert found(spark, texts, forms) == [(0, 0, 6, "1 John"), (0, 11, 15, "John"), (1, 0, 4, "Song"), (2, 0, 15, "Song of Solomon"), (6, 0, 4, "John"), (6, 5, 9, "John"), (7, 4, 8, "John")]
    assert found(spark, ["John"], []) == [] and found(spark, [], forms) == []
    with pytest.raises(ValueError):
        found(spark, texts, forms, most=2)


def test_random_texts(spark, monkeypatch):
    r = random.Random(5)
    forms = sorted({"".join(r.choice("ab é") for _ in range(r.randrange(1, 6))).strip() for _ in range(40)} - {""})
    texts = ["".join(r.choice("abé  -1\n") for _ in range(r.randrange(80))) for _ in range(150)]
    pattern = regex.compile(r"(?<![\p{L}\p{N}])(?:" + "|".join(map(regex.escape, sorted(forms, key=len, reverse=True))) + r")(?![\p{L}\p{N}])")
    want = sorted((i, m.start(), m.end(), m.group()) for i, t in enumerate(texts) for m in pattern.finditer(t))
    assert found(spark, texts, [(f, f) for f in forms]) == want and len(want) > 100


def test_stretches():
    N_STRETCH = N.STRETCH
    try:
        N.STRETCH = 10
        assert list(N.stretches(["abc", "x" * 50, "", "d"])) == [(0, 2), (2, 4)]
    finally:
        N.STRETCH = N_STRETCH


def test_variants(spark):
    got = N.variants(spark.createDataFrame([("1 John",), ("Ruth",), ("Ru th",)], "name string")).collect()
    assert {(r.form, r.name) for r in got} == {("1 John", "1 John"), ("1 JOHN", "1 John"), ("1John", "1 John"), ("1JOHN", "1 John"), ("Ru th", "Ru th"), ("RU TH", "Ru th"), ("Ruth", "Ru th"), ("RUTH", "Ru th")}
