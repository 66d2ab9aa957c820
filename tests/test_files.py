import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from vellumq.sources import files as S
from vellumq.sources import sinks as K
from vellumq.streaming import batches as B


def test_editions_and_reports(spark, tmp_path):
    (tmp_path / "a.thml").write_text('<ThML><ThML.body><p>x</p></ThML.body></ThML>')
    (tmp_path / "b.xml").write_text('<div type="chapter"><div type="verse"/></div>')
    got = {r.path.rsplit("/", 1)[1]: r.xml for r in S.editions(spark, str(tmp_path)).collect()}
    assert got["a.thml"] == "<text><body><p>x</p></body></text>"
    assert {r.type: r.n for r in S.division_types(spark.createDataFrame([(got["b.xml"],)], "xml string")).collect()} == {"chapter": 1, "verse": 1}
    (tmp_path / "r").mkdir()
    (tmp_path / "r/report.md").write_text("# R\n## spelling (2)\n- loue → love ×3\n- a → b\n## case\n- God → god\n")
    assert [(r.section, r.entry, r.times) for r in S.report_entries(spark, str(tmp_path / "r")).collect()] == [("spelling (2)", "loue → love", 3), ("spelling (2)", "a → b", 1), ("case", "God → god", 1)]


def test_ebook(spark, tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="OEBPS/c.opf"/></rootfiles></container>')
        z.writestr("OEBPS/c.opf", '<package xmlns="http://www.idpf.org/2007/opf"><manifest><item id="b" href="t/2.xhtml"/><item id="a" href="t/1.xhtml"/></manifest><spine><itemref idref="a"/><itemref idref="b"/></spine></package>')
        z.writestr("OEBPS/t/1.xhtml", "<html><head><title>no</title></head><body><h1>One</h1><p>a &amp; <i>b</i></p></body></html>")
        z.writestr("OEBPS/t/2.xhtml", "<html><body><p>c</p></body></html>")
    (tmp_path / "x.epub").write_bytes(data.getvalue())
    assert [(r.chapter, r.tag, r.text) for r in S.epub_blocks(spark, str(tmp_path / "x.epub")).orderBy("chapter", "block").collect()] == [(0, "h1", "One"), (0, "p", "a & b"), (1, "p", "c")]


def test_tables_of_readers(spark, tmp_path):
    (tmp_path / "p12.tsv").write_text("level\tpage_num\tblock_num\tpar_num\tline_num\tword_num\tleft\ttop\twidth\theight\tconf\ttext\n5\t1\t1\t1\t1\t1\t1\t2\t3\t4\t90.5\t\"Of\n")
    assert S.word_boxes(spark, str(tmp_path / "p12.tsv")).first()[-1] == 12
    (tmp_path / "flags.jsonl").write_text(json.dumps({"file": "f", "chunk": 1, "seconds": 0.5, "flags": [{"quote": "q", "issue": "i", "suggestion": "s", "confidence": "high", "found": True}]}) + "\n")
    assert S.flags(spark, str(tmp_path / "flags.jsonl")).first().quote == "q"
    (tmp_path / "scores.json").write_text(json.dumps({"c.typ": [["He", 0.0, None, -15.0], ["or", -16.0, "the", -0.5]]}))
    assert [(r["at"], r.word, r.lp, r.best) for r in S.word_scores(spark, str(tmp_path / "scores.json")).collect()] == [(0, "He", 0.0, None), (1, "or", -16.0, "the")]
    (tmp_path / "bible.txt").write_text("Psalm 23:1\tThe Lord\nnoise\n1 John 1:2\tand\n")
    assert [(r.book, r.chapter, r.verse) for r in S.verses(spark, str(tmp_path / "bible.txt")).collect()] == [("Psalms", 23, 1), ("1 John", 1, 2)]


def test_small_helpers():
    assert S.settings('[book]\ntitle = "x"\n')["book"]["title"] == "x"
    assert S.matching(["Book", "Book 2", "Tract"], "book") == "Book" and S.matching(["Book", "Tract"], "tra") == "Tract"
    with pytest.raises(LookupError):
        S.matching(["ab", "ac"], "a")
    assert S.text_of_pages("--- Source PDF page 3 (OCR sequence 1) ---\na\nb\n--- Source PDF page 4 (OCR sequence 2) ---\nc") == [(3, "a\nb"), (4, "c")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x<date>1</date>"), ("b", "y")], "k string, t string")
    out = str(tmp_path / "out")
    assert K.write_if_changed(rows, out, "k", "t") == 2
    assert K.write_if_changed(rows.withColumn("t", F.replace("t", F.lit(">1<"), F.lit(">2<"))), out, "k", "t") == 0
    assert K.write_if_changed(rows.withColumn("t", F.replace("t", F.lit("y"), F.lit("z"))), out, "k", "t") == 1
    assert {r.k: r.t for r in K.latest(spark.read.parquet(out), "k").collect()} == {"a": "x<date>1</date>", "b": "z"}
    lines = [r.line for r in K.report(spark.createDataFrame([("spelling", "a", "b", 3), ("spelling", "c", "d", 1), ("case", "E", "e", 1)], "type string, orig string, auto string, n long")).collect()]
    assert lines == ["## case (1)", "- E → e", "## spelling (4)", "- a → b ×3", "- c → d"]
    K.layer_files(spark.createDataFrame([("f1", "x"), ("f2", "y")], "file string, text string"), str(tmp_path / "layers"))
    assert spark.read.text(str(tmp_path / "layers")).count() == 2
    assert [r.line for r in K.checksums(spark.createDataFrame([("b", "h2"), ("a", "h1")], "name string, sha256 string")).collect()] == ["h1  a", "h2  b"]
    books = spark.createDataFrame([("x", "T")], "book string, title string")
    site = K.site_manifest(books, spark.createDataFrame([("x", "classic", "v1")], "book string, edition string, version string"), spark.createDataFrame([("x", "classic", "epub", "x.epub")], "book string, edition string, kind string, name string"))
    assert json.loads(site.first().entry)["editions"][0]["files"] == {"epub": "x.epub"}


def test_stream_goes_on(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    first = spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string")
    first.write.parquet(source)
    B.resumable(B.token_rows(B.arriving(spark, source, first.schema)), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 3
    spark.createDataFrame([(3, "c a")], "doc_id long, text string").write.mode("append").parquet(source)
    B.resumable(B.token_rows(B.arriving(spark, source, first.schema)), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 5
    B.counted_by_word(B.arriving(spark, source, first.schema, 1), out + "2", state + "2").awaitTermination()
    assert {r.word: r.n for r in B.totals(spark, out + "2").collect()} == {"a": 3, "b": 1, "c": 1}


def test_event_windows(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2024-01-01 10:05:00", "x", 1.0), (2, "2024-01-01 10:50:00", "x", 2.0), (2, "2024-01-01 10:50:00", "x", 2.0)], "event_id long, ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    rows.write.parquet(str(tmp_path / "e"))
    stream = B.arriving(spark, str(tmp_path / "e"), rows.schema)
    q = B.windowed(B.unique(stream, ["event_id"], "ts"), late=None).writeStream.format("memory").queryName("windows_test").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    q = B.windowed(stream).writeStream.format("memory").queryName("windows_all").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("windows_all").first().n == 3
