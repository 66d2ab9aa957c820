from pyspark.sql import functions as F

from vellumq.operators import predicates as P


def test_blocks(spark):
    reg = "array<struct<text:string,resp:string,type:string>>"
    c = spark.createDataFrame([("a", "x", [("", "#editor", "omission")]), ("a", "y", [(" ", "#editor", None)]), ("b", "z", [])], f"el string, orig string, regs {reg}")
    assert [r.el for r in P.empty_in_edition(c, "el").collect()] == ["a"]
    b = spark.createDataFrame([("v", "l", "one two three four"), ("v", "p", "five"), ("p", "l", "a"), ("p", "p", "b"), ("e", "l", "")], "division string, kind string, text string")
    assert [r.division for r in P.verse_divisions(b).collect()] == ["v"]
    d = spark.createDataFrame([("x", None, 0), ("x1", "x", 1), ("x2", "x", 2), ("x3", "x", 3)], "id string, parent string, pos int")
    assert [r.id for r in P.sections(d, 2, 3).orderBy("pos").collect()] == ["x2", "x3"] and [r.id for r in P.top_divisions(d).collect()] == ["x"]
    t = spark.createDataFrame([("a (b [c", 2, False), (" Next one", 0, True), ("", 0, True), (" ; x) y", 0, False), ("u) (v", 1, False), ("1 \\( w", 0, True)], "t string, n int, e boolean")
    assert t.filter((P.bracket_depth(F.col("t")) != F.col("n")) | (P.ends_sentence(F.col("t")) != F.col("e"))).isEmpty()


def test_ordered(spark):
    rows = spark.createDataFrame([(1, 5, "n"), (1, 2, "m")], "doc_id long, pos int, t string")
    assert [(r.t, r.number) for r in P.footnote_numbers(rows).orderBy("pos").collect()] == [("m", 1), ("n", 2)]
    lists = spark.createDataFrame([(1, 0, 0, "u"), (1, 1, 1, "u"), (1, 2, 0, "o")], "doc_id long, pos int, level int, list string")
    assert [(r.after_level, r.same_list) for r in P.after_level(lists).orderBy("pos").collect()] == [(False, False), (False, True), (True, False)]
    words = spark.createDataFrame([(1, 0, True), (1, 1, False), (1, 2, True), (1, 3, False)], "doc_id long, pos int, opens boolean")
    assert [r.offset for r in P.paragraph_offset(words).orderBy("pos").collect()] == [0, 1, 0, 1]
    cells = spark.createDataFrame([("c", 0, " "), ("c", 1, "a"), ("c", 2, "b"), ("c", 3, "")], "cell string, pos int, text string")
    assert tuple(P.cell_ends(cells).first())[1:] == (1, 2)


def test_records(spark):
    old = spark.createDataFrame([("u", {"title": "T", "modern.note": "x", "classic.note": "y"})], "unit string, fields map<string,string>")
    new = spark.createDataFrame([("u", {"title": "T", "modern.note": "z", "classic.note": "y"})], "unit string, fields map<string,string>")
    assert P.record_part(old, "classic").first().fields == {"title": "T", "note": "y"}
    assert P.own_changes(P.record_part(old, "classic"), P.record_part(new, "classic")).count() == 0
    assert P.own_changes(P.record_part(old, "modern"), P.record_part(new, "modern")).count() == 1
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    reached = spark.createDataFrame([("modern", "a"), ("classic", "a"), ("modern", "b")], "start string, node string")
    assert {r.path: r.edition for r in P.belongs(files, reached).collect()} == {"a": "both", "b": "modern", "c": "none"}


def test_keys_and_ranks(spark):
    rows = P.stripped_accents(spark.createDataFrame([("Ἐν ἀρχῇ",), (None,)], "t string"), "t").collect()
    assert [r.key for r in rows] == ["εν αρχη", None]
    marks = spark.createDataFrame([("I. a", 0), ("2. b", 1), ("(3.) c", 2), ("[4.] d", 3), ("1st. e", 4), ("plain", None)], "t string, want int")
    assert marks.filter(~P.mark_rank(F.col("t")).eqNullSafe(F.col("want"))).isEmpty()
    paragraphs = spark.createDataFrame([("x", 0, "salt wool and tin"), ("x", 3, "nine ships came in may"), ("y", 0, "no such thing here")], "doc string, n int, key string")
    witness = spark.createDataFrame([("x", 1, "nine ships came in may", 4), ("x", 0, "salt wool and tin", None), ("y", 0, "quite another page", 2)], "doc string, n int, key string, rank int")
    assert {(r.doc, r.n, r.rank) for r in P.witness_ranks(paragraphs, witness).collect() if r.rank} == {("x", 3, 4)}
