from pyspark.sql import functions as F

from vellumq.operators import gates as Q
from vellumq.operators import html as H
from vellumq.operators import normalise as N
from vellumq.operators import ordered as O
from vellumq.operators import rules as Y
from vellumq.operators import scans as P


def test_states(spark):
    rows = [("a", [], [], True), ("b", ["x"], [], True), ("c", [], ["p"], True), ("d", [], [], False), ("e", ["x"], [], False)]
    got = {r.unit: (r.holds, r.state) for r in Q.state(spark.createDataFrame(rows, "unit string, changed array<string>, problems array<string>, signed boolean")).collect()}
    assert got == {"a": (True, "done"), "b": (False, "carried"), "c": (False, "held"), "d": (True, "ready"), "e": (False, "changed")}


def test_versions(spark):
    tags = spark.createDataFrame([("u", "v9.2"), ("u", "v13"), ("u", "v13.1"), ("w", "14")], "unit string, tag string")
    got = {r.unit: (r.version, r.n) for r in Q.latest_version(tags).withColumn("n", Q.next_point(F.col("version"))).collect()}
    assert got == {"u": ([13, 1], [13, 2]), "w": ([14], [14, 1])}


def test_snapshots(spark):
    old = Q.fingerprints(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, t string"), "k", "t", "old")
    new = Q.fingerprints(spark.createDataFrame([(1, "a"), (2, "c"), (4, "")], "k int, t string"), "k", "t", "new")
    assert {r.key: r.change for r in Q.compared(old, new).collect()} == {"1": "same", "2": "changed", "3": "gone", "4": "added"}
    assert {(r.change, r.key) for r in Q.added_and_gone(old, new, "key").collect()} == {("added", "4"), ("gone", "3")}
    one = Q.manifest(old.withColumn("g", F.lit(1)), "g").first()
    assert one.n == 3 and one.sha256 == Q.manifest(old.withColumn("g", F.lit(1)).repartition(3), "g").first().sha256


def test_exactly_one_and_inheritance(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert {(r.k, r.n) for r in Q.exactly_one(rows, spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), "k").collect()} == {("a", 2), ("c", 0)}
    own = spark.createDataFrame([("e1", "b1", None, "x"), ("e2", "b2", "t2", None)], "id string, book string, title string, note string")
    got = {r.id: (r.title, r.note) for r in Q.inherited(own, spark.createDataFrame([("b1", "T1", "n1")], "book string, title string, note string"), "book", ["title", "note"]).collect()}
    assert got == {"e1": ("T1", "x"), "e2": ("t2", None)}
    assert [r.k for r in Q.covered(rows.distinct(), spark.createDataFrame([("a",)], "k string"), "k").collect()] == ["b"]


def test_catalogue_and_editions(spark):
    units = spark.createDataFrame([("u", "v1"), ("w", "v2")], "unit string, version string")
    files = spark.createDataFrame([("u", "b.pdf", 2, "h2"), ("u", "a.epub", 1, "h1")], "unit string, name string, bytes long, sha256 string")
    got = {r.unit: r.entry for r in Q.catalogue(units, files).collect()}
    assert got["u"] == '{"unit":"u","version":"v1","files":[{"name":"a.epub","bytes":1,"sha256":"h1"},{"name":"b.pdf","bytes":2,"sha256":"h2"}]}' and got["w"].endswith('"files":[]}')
    paths = spark.createDataFrame([("x/vol2/chapters/modern/a.typ",), ("cover.pdf",)], "path string")
    assert [(r.kind, r.volume, r.edition) for r in Q.editions(paths).orderBy("path").collect()] == [("pdf", None, "classic"), ("chapter", 2, "modern")]
    w = Q.latest(spark.createDataFrame([("a", 1, 5), ("a", 2, 3)], "u string, t int, v int"), ["u"], [F.col("t")])
    assert w.first().v == 3
    gates = Q.gates(spark.createDataFrame([("a", 5), ("b", None)], "u string, n int"), "u", {"big": F.col("n") > 3})
    assert {(r.u, r.ok) for r in gates.collect()} == {("a", True), ("b", False)}


def test_scans(spark):
    pages = spark.createDataFrame([("s", 2, "Temptation, in general"), ("s", 1, "THE PREFACE\nTo the Reader.")], "scan string, page int, text string")
    out = P.exported(pages)
    assert out.first().text.startswith("--- Source PDF page 1 (OCR sequence 1) ---\nTHE PREFACE")
    assert {(r.page, r.text) for r in P.read_back(out).collect()} == {(r.page, r.text) for r in pages.collect()}
    boxes = spark.createDataFrame([(1, 5, 1, 1, 1, 1, 10, 20, 5, 6, "Of"), (1, 5, 1, 1, 1, 2, 20, 18, 9, 6, "Temptation"), (1, 5, 1, 1, 2, 1, 10, 30, 5, 6, "ſin"), (1, 4, 1, 1, 2, 0, 0, 0, 99, 99, "x")], "page int, level int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, height int, text string")
    lines = P.lines(boxes)
    assert {(tuple(r.words), r.left, r.top, r.right, r.bottom) for r in lines.collect()} == {(("Of", "Temptation"), 10, 18, 29, 26), (("ſin",), 10, 30, 15, 36)}
    best = P.best_window(lines, ["temptation", "fin"], 2).first()
    assert (best.hits, best["at"], best.bottom) == (2, 1, 36)
    assert P.best_window(lines, ["temptatjon", "x"], 1).first().hits == 1 and P.best_window(lines, ["sun"], 1).count() == 0
    assert [r.n for r in P.stray_numbers(spark.createDataFrame([(1, 0, 1), (1, 1, 2), (1, 2, 5)], "page int, at int, n int")).collect()] == [5]
    assert P.body_size(spark.createDataFrame([("b", 10, "aaa"), ("b", 12, "aa"), ("b", 12, "a")], "book string, size int, text string")).first()["size"] == 12
    assert P.margins(spark.createDataFrame([("b", 1, 5.0, 4.0), ("b", 2, 3.0, 4.0), ("b", 3, 9.0, 8.0)], "book string, page int, inner double, outer double")).first().narrowest == 2
    assert P.done_pages(pages, pages.filter("page = 1"), ["scan", "page"]).first().page == 2
    assert spark.createDataFrame([("won-\nderful A-\nB",)], "text string").select(P.dehyphenated()).first()[0] == "wonderful A-\nB"


def stream(spark, text):
    return spark.createDataFrame([(1, i, k, t) for i, (k, t) in enumerate(text)], "doc_id long, pos int, kind string, text string")


def test_sentence_starts(spark):
    t = [("m", "¶"), ("w", "One"), ("x", "."), ("w", "Two"), ("w", "i"), ("x", "."), ("w", "e"), ("x", "."), ("w", "that"), ("w", "Oh"), ("x", "!"), ("w", "my"), ("x", "?"), ("x", "—"), ("w", "Yes"), ("m", "¶"), ("w", "2"), ("x", "."), ("w", "next")]
    got = [r.text for r in O.sentence_starts(stream(spark, t)).filter("start").orderBy("pos").collect()]
    assert got == ["One", "Two", "Yes", "2"]


def test_folds(spark):
    points = spark.createDataFrame([(1, i, lvl) for i, lvl in enumerate([0, 1, 1, 2, 0, 1])], "doc_id long, pos int, level int")
    assert [r.number for r in O.level_counters(points).orderBy("pos").collect()] == [1, 1, 2, 1, 2, 1]
    items = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 2, 1), (1, 3, 2), (1, 4, 0)], "doc_id long, pos int, depth int")
    assert [r.parent for r in O.nested_items(items).orderBy("pos").collect()] == [None, 0, 0, 2, None]
    deep = spark.createDataFrame([(1, i, i) for i in range(30)] + [(1, 30, 12)], "doc_id long, pos int, level int")
    assert [r.parent for r in O.level_counters(deep).orderBy("pos").collect()] == [*range(-1, 29), 11]
    assert [r.number for r in O.level_counters(deep).orderBy("pos").collect()] == [1] * 30 + [2]
    assert [r.parent for r in O.nested_items(deep.withColumnRenamed("level", "depth")).orderBy("pos").collect()] == [None, *range(29), 11]
    heads = H.nested(spark.createDataFrame([(1, 0, 1), (1, 1, 2), (1, 2, 3), (1, 3, 2), (1, 4, 1)], "page_id long, block int, level int"), "page_id")
    assert [r.parent for r in heads.orderBy("block").collect()] == [None, 0, 1, 0, None]
    split = O.split_blocks(spark.createDataFrame([(1, 0, False), (1, 1, True), (1, 2, False)], "doc_id long, pos int, split boolean")).orderBy("pos").collect()
    assert [(r.block, r.previous, r.next) for r in split] == [(0, None, 1), (1, 0, None), (1, None, None)]
    moved = O.page_break_spaces(stream(spark, [("w", "a"), ("s", " "), ("p", "|"), ("w", "b")])).orderBy("pos").collect()
    assert [r.text for r in moved] == ["a", "|", " ", "b"]
    assert O.block_numbers(stream(spark, [("m", "¶"), ("w", "a"), ("m", "¶"), ("w", "b")])).orderBy("pos").collect()[-1].block == 2
    words = spark.createDataFrame([(["(", "a", ",", "b", ")", "."],)], "w array<string>")
    assert words.select(O.joined_tokens(F.col("w"))).first()[0] == "(a, b)."
    gaps = spark.createDataFrame([("gr…e", "grace"), ("gr…e", "glory"), ("x", "x")], "o string, n string")
    assert [r[0] for r in gaps.select(O.gap_fill(F.col("o"), F.col("n"))).collect()] == ["ac", None, None]
    caught = O.near_page_marks(stream(spark, [("w", "of"), ("w", "grace"), ("p", "|"), ("w", "grace"), ("w", "and")])).filter("catch").collect()
    assert {r.text for r in caught} == {"grace"}
    joins = O.spacing_changes(stream(spark, [("w", "any"), ("w", "thing")]), stream(spark, [("w", "Anything")]))
    assert [r.joined for r in joins.collect()] == ["anything"]


def test_rules(spark):
    docs = spark.createDataFrame([(1, "Cicero : Qui deos. #emph[Lo]; then"), (2, "his holy Spirit, that holy Spirit, the holy Spirit and his holy Ghost"), (3, "‘I will go‘"), (4, "‘I’ll go,’"), (5, "#set x\nthe the end very very good"), (6, None)], "doc_id long, text string")
    got = {(r.doc_id, r.rule) for r in Y.house(docs).collect()}
    assert {(1, "spacing"), (1, "semicolon"), (2, "holy"), (3, "quotes curled"), (5, "doubled")} <= got and not any(d == 4 for d, _ in got)
    assert Y.holy_names(docs).count() == 2
    assert [r.match for r in Y.lint(docs.filter("doc_id = 5")).collect()] == ["the the"]
    spelling = spark.createDataFrame([("hath", "has"), ("approueth", "approves"), ("moneth", "month"), ("loue", "love")], "word string, modern string")
    assert {r.word for r in Y.archaic_changes(spelling, ("hath",)).collect()} == {"hath", "approueth"}


def test_modern_spellings(spark):
    words = spark.createDataFrame([(w,) for w in ["iustice", "hath", "looke", "prou", "zzz", "obserue", "speaketh", "yeeldeth"]], "word string")
    known = spark.createDataFrame([("justice", 9), ("look", 5), ("observe", 4), ("yeeld", 1), ("speak", 3)], "word string, freq long")
    got = {r.word: (r.modern, r.rule) for r in N.modernised(words, known, N.Tables(manual={"prou": "prov"})).collect()}
    assert got["iustice"] == ("justice", "rules") and got["hath"] == ("hath", "exception") and got["looke"] == ("look", "rules") and got["prou"] == ("prov", "manual") and got["zzz"] == ("zzz", "none")
    chain = {r.word: (r.modern, r.rule) for r in N.spelling_chain(words.unionByName(spark.createDataFrame([("lookeeth",), ("jjvuv",)], "word string")), known.unionByName(spark.createDataFrame([("iivvu", 3)], "word string, freq long"))).collect()}
    assert chain["iustice"] == ("justice", "rules") and chain["jjvuv"] == ("iivvu", "letterforms") and chain["lookeeth"] == ("looketh", "verb root") and chain["zzz"] == ("zzz", "none") and chain["hath"] == ("hath", "exception")
    assert {r.word: r.modern for r in N.letterform_search(words, known).collect()} == {"iustice": "justice", "obserue": "observe"}
    assert list(N.swapped("ui")) == [["vi", "uj"], ["vj"]] and list(N.swapped("u" * 8)) == []
    assert {r.word: r.modern for r in N.verb_roots(spark.createDataFrame([("lookeeth",), ("speaketh",)], "word string"), known).collect()} == {"lookeeth": "looketh"}


def test_pages(spark):
    pages = spark.createDataFrame([(1, "<body><h1>A &lt;b</h1><p>one<p>two <a class=x href='u#n1'>link</a><script>'</p>'</script><!-- <p>no --></body>"), (2, None)], "page_id long, html string")
    assert [(r.tag, r.text) for r in H.ordered_blocks(pages).collect()] == [("h1", "A <b"), ("p", "one"), ("p", "two link")]
    assert H.links(pages).first().href == "u#n1"
    notes = spark.createDataFrame([(1, "n1", "the note")], "page_id long, id string, text string")
    assert H.anchored(H.links(pages).select("page_id", "href"), notes).first().text == "the note"
