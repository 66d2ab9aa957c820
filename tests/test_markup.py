import xml.etree.ElementTree as E

from vellumq.operators import layers as L
from vellumq.operators import markup as M
from vellumq.operators import references as R

XML = '<div type="chapter"><head>A <hi>b</hi></head><p>Printed <choice><orig>loue</orig><reg resp="#auto" type="spelling">love</reg><reg resp="#editor">Love</reg></choice> &amp; more,<note n="1">a note</note> end.</p></div>'


def test_lossless():
    tokens = list(M.tokenised(E.fromstring(XML)))
    assert M.rebuilt(tokens) == XML
    assert [t.orig for t in tokens if t.regs] == ["loue"]
    assert [t.text for t in tokens if t.in_note and t.kind == "word"] == ["a", "note"]


def test_layers_of_xml(spark):
    assert M.layer_text(XML, "orig") == "A b\nPrinted loue & more, end."
    assert M.layer_text(XML, "reg") == "A b\nPrinted Love & more, end."
    assert M.layer_text(XML, "reg", machine_only=True).startswith("A b\nPrinted love")
    rows = M.xml_tokens(spark.createDataFrame([(1, XML), (2, "<p>"), (3, None)], "doc_id long, xml string")).collect()
    assert "".join(r.text for r in sorted((r for r in rows if r.doc_id == 1), key=lambda r: r.tok_id)) == XML
    assert [r.kind for r in rows if r.doc_id == 2] == ["error"]
    assert M.choice_xml("loue", [{"text": "love", "resp": "#auto", "type": None}]) == '<choice><orig>loue</orig><reg resp="#auto">love</reg></choice>'


def test_thml():
    xml = '<ThML><ThML.head><x/></ThML.head><ThML.body><div1 title="One" type="Chapter"><p class="speaker">Fac.</p><p>a <i>b</i><note n="2">c</note></p></div1></ThML.body></ThML>'
    assert M.thml_to_tei(xml) == '<text><body><div type="chapter"><head>One</head><speaker>Fac.</speaker><p>a <emph>b</emph><note n="2">c</note></p></div></body></text>'


def test_review(spark):
    got = M.parse_review("= Title\n\nPlain #emph[it #emph[not] it] end#footnote[a #emph[b] note \\] x].\n\n#pad(left: 4.0em)[deep words]\n\n+ one\n  - two\n")
    assert got.headings == [(0, 1, "Title")] and got.levels == [0, 2] and got.notes[0][1] == "a #emph[b] note \\] x"
    assert [(w, i) for w, k, i in got.body if k == "w"][:6] == [("Plain", False), ("it", True), ("not", False), ("it", True), ("end", False), (".", False)]
    assert [(d, n) for _, d, n in got.items] == [(0, True), (1, False)]
    assert M.review_tokens(spark.createDataFrame([(1, "a b")], "doc_id long, text string")).count() == 3
    assert M.closing("[a\\]b[c]d]", 0) == 9 and M.closing("[a", 0) is None


def test_grid_and_blocks():
    assert M.table_grid([[(2, 1), (1, 2)], [(1, 1), (1, 1)]]) == [(0, 0, 0, 2, 1), (1, 0, 1, 1, 2), (2, 1, 1, 1, 1), (3, 1, 2, 1, 1)]
    assert M.block_changes([], ["¶"]) == "split" and M.block_changes(["¶"], []) == "merge" and M.block_changes(["¶"], ["¶"]) is None and M.block_changes(["H"], [">"]) == "unresolved"


def choices(spark):
    reg = "array<struct<text:string,resp:string,type:string>>"
    return spark.createDataFrame([
        (1, 0, "God", [("god", "#editor", "case")]), (1, 1, "loue", [("love", "#auto", "spelling"), ("Love", "#editor", None)]), (1, 2, "hath", [("has", "#editor", "grammar")]),
        (1, 3, "old words", [("three new words", "#editor", "emendation")]), (1, 4, "gone", [("", "#editor", "omission")]), (1, 5, "same", []),
    ], f"doc_id long, pos int, orig string, regs {reg}")


def test_choices(spark):
    c = choices(spark)
    got = L.coverage(c, "doc_id").first()
    assert (got.words, got.form, got.grammar, got.wording, got.added, got.removed, got.unchanged_pct) == (7, 2, 1, 3, 1, 1, 14.3)
    assert [r.text for r in L.layer(c, "reg").orderBy("pos").collect()] == ["god", "Love", "has", "three new words", "", "same"]
    assert L.printed(L.layer(c, "reg")).first().text == "god Love has three new words same"
    assert L.layer(c, "reg", only_machine=True).filter("pos = 1").first().text == "love"
    assert {r.type: r.n for r in L.decisions_by_kind(c).collect()} == {"case": 1, "spelling": 1, "grammar": 1, "emendation": 1, "omission": 1}
    assert L.case_breaks(c).count() == 0
    auto = spark.createDataFrame([(1, "God", [("god", "#auto", "case")])], "doc_id long, orig string, regs array<struct<text:string,resp:string,type:string>>")
    assert L.case_breaks(auto).count() == 1


def test_references(spark):
    counts = {("1 Samuel", 14): 52, ("Psalms", 37): 40, ("1 Corinthians", 7): 40, ("Hebrews", 12): 29, ("Psalms", 23): 6, ("Psalms", 119): 176, ("Genesis", 1): 31}
    for old, new in (("so 1 Cor. vii. 11 says", "so 1 Cor 7:11 says"), ("(Gen. i. 2)", "(Gen 1:2)")):
        assert R.restyled(old, counts) == new
    for same in ("Gen 1:77 is none", "Ruth 40:1", "no place at all"):
        assert R.restyled(same, counts) == same
    docs = spark.createDataFrame([(1, "see Ps. 23:1, 2 and 1 Cor. vii. 3-5; Gen 99:1."), (2, None)], "doc_id long, text string")
    refs = R.references(docs)
    assert {(r.book, r.chapter, tuple(r.verses)) for r in refs.collect()} == {("Psalms", 23, (1, 2)), ("1 Corinthians", 7, (3, 4, 5)), ("Genesis", 99, (1,))}
    verse_count = spark.createDataFrame([(b, c, n) for (b, c), n in counts.items()], "book string, chapter int, n int")
    assert [r.book for r in R.missing(refs, verse_count).collect()] == ["Genesis"]
    assert R.restyle(docs, verse_count).filter("doc_id = 1").first().text.startswith("see Ps 23:1, 2 and 1 Cor 7:3-5")
    assert R.quoted_before("he said, “Lo, I come,” (", 24) == "Lo, I come," and R.quoted_before("plain", 5) is None
    weak = spark.createDataFrame([(["a", "b", "c", "d"], ["a"]), (["a", "b", "c", "d"], ["a", "b"]), (["a"], [])], "words array<string>, verse array<string>")
    assert [r.share for r in R.weak_quotes(weak).collect()] == [0.25]
