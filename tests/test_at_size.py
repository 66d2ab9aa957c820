"""Queries whose steps must not make a row for each word of all texts: the same rows as the plain way, by plans without that step."""

import hashlib

import pytest

from vellumq.operators import select as C
from vellumq.operators.tokens import sentences
from vellumq.plans import registry

TEXTS = [
    (1, "He came to the house. They said it was the best of all the houses; zork blim frob of quux! And the house was his.", "en"),
    (2, "The house and the garden. Zork vlam tolk brin the gnarf.", "en"),
    (3, "Das Haus ist alt. Zork the blim.", "de"),
    (4, "", "en"),
    (5, None, "en"),
    (6, "VNTO the vnderstanding ioy, goodnesse Ioy vp", "en"),
]


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows):
        spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)

    return write


def test_marked_lines_without_all_words(spark, folder, monkeypatch):
    where = folder([(d + 10 * k, t, lang) for k in range(4) for d, t, lang in TEXTS])
    docs = spark.read.parquet(f"{where}/documents.parquet")
    top = {(r.doc_id, r.sent_no) for r in C.budget_top(C.sentence_scores(C.bigram_scores(docs)), 0.02).filter("strongest is not null").collect()}
    monkeypatch.setattr(C, "bigram_scores", None)
    lines = registry.QUERIES["marked_lines"](spark, where).collect()
    assert top and {(r.doc_id, r.sent_no) for r in lines} == top and all("[[" in r.line for r in lines)


def test_foreign_runs_by_rare_words(spark, folder):
    where = folder(TEXTS)
    rows = registry.QUERIES["foreign_runs"](spark, where)
    words = {}
    for r in sentences(spark.read.parquet(f"{where}/documents.parquet").filter("lang = 'en'")).collect():
        words[r.doc_id, r.sent_no] = [w.strip(".,;!").lower() for w in r.s.split()]
    every = [w for ws in words.values() for w in ws]
    want = [(*k, len(ws), known) for k, ws in words.items() if len(ws) >= 4 and 2 * (known := sum(every.count(w) >= 3 for w in ws)) < len(ws)]
    assert len(want) > 1 and sorted(map(tuple, rows.select("doc_id", "sent_no", "words", "known").collect())) == sorted(want)
    assert "LeftOuter, (w#" not in rows._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("twice", [False, True])
def test_layers_within_the_row(spark, folder, twice):
    rows = registry.QUERIES["layer_projection"](spark, folder([*TEXTS, *([(6, "twoo words", "en")] if twice else [])]))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = {r.doc_id: (r.reg_sha256, r.orig_sha256) for r in rows.collect()}
    assert set(got) == {1, 2, 3, 6}
    if twice:  # words of both texts by their places
        assert got[6][1] == sha("VNTO twoo the words vnderstanding ioy goodnesse Ioy vp")
    else:
        assert got[6] == (sha("VNTO the understanding joy goodness Joy up"), sha("VNTO the vnderstanding ioy goodnesse Ioy vp"))
        assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


ODD = [*TEXTS, (7, "\t \n", "en"), (8, "\t. \u000b And the end of it, t-he end of THE (end)!  ", "en"), (9, "ΣΑΣ the ΟΔΟΣ. İt was the ßide and of\x85it. & and & the", "en"), (10, "the the of the the. So that is so", "en"), (11, "the", None)]


@pytest.mark.parametrize("share", [0.0, 0.15, 0.5])
def test_budget_orders_one_bucket_alone(spark, folder, monkeypatch, share):
    docs = spark.read.parquet(f"{folder([(d + 20 * k, t, lang) for k in range(3) for d, t, lang in ODD])}/documents.parquet")
    scored = C.sentence_scores(C.bigram_scores(docs))
    plain = lambda rows: sorted((r.doc_id, r.sent_no, r.words, r.score) for r in rows.collect())
    want = plain(C.taken(scored, C.strength_order(), "words", share=share))
    given = []

    def counted(rows, *of, taken=C.taken, **more):
        given.append(rows.count())
        return taken(rows, *of, **more)

    monkeypatch.setattr(C, "taken", counted)
    assert plain(C.strongest_sentences(docs, share)) == want
    assert plain(C.budget_top(scored, share)) == want and bool(want) == (share > 0)
    assert max(given) <= scored.count() * 2 / 3
    if share:
        return
    same = ["doc_id", "sent_no", "words", "score", "strongest"]
    assert sorted(map(str, C.scored_sentences(docs).select(same).collect())) == sorted(map(str, scored.select(same).collect()))


def test_sentences_without_words_come_first(spark):
    rows = spark.createDataFrame([(1, 0, 0, 0.0, []), (2, 0, 3, 2.5, [2.5]), (3, 0, 4, 0.0, []), (4, 0, 3, 2.5004, [2.5004])], "doc_id long, sent_no int, words long, score double, strength array<double>")
    top = lambda share: sorted(r.doc_id for r in C.budget_top(rows, share).collect())
    assert [top(s) for s in (0.0, 0.05, 0.4, 0.7, 1.0)] == [[], [1, 4], [1, 2, 4], [1, 2, 3, 4], [1, 2, 3, 4]]
