"""Files as tables. Every reader is a Spark source, so any file system that Spark can read will do."""

from __future__ import annotations

import io
import posixpath
import re
import xml.etree.ElementTree as E
import zipfile
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumq.operators.markup import thml_to_tei


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, text: a row for each file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def editions(spark: SparkSession, path: str) -> DataFrame:
    """path, xml of TEI files, and of ThML files converted; by the file's suffix."""
    rows = whole_texts(spark, path)

    def convert(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [thml_to_tei(t) if p.lower().endswith(".thml") else t for p, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["path", "xml"])

    return rows.mapInArrow(convert, "path string, xml string")


class _Blocks(HTMLParser):
    """Blocks of a chapter: (tag, text); notes that links name apart."""

    NAMES = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote td".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[list[str]] = []
        self.open = 0
        self.skip = 0

    def handle_starttag(self, tag, attrs) -> None:
        if tag in ("script", "style", "head"):
            self.skip += 1
        elif tag in self.NAMES:
            self.out.append([tag, ""])
            self.open += 1

    def handle_endtag(self, tag) -> None:
        if tag in ("script", "style", "head"):
            self.skip = max(0, self.skip - 1)
        elif tag in self.NAMES:
            self.open = max(0, self.open - 1)

    def handle_data(self, data) -> None:
        if self.out and self.open and not self.skip:
            self.out[-1][1] += data


def html_blocks(html: str) -> list[tuple[str, str]]:
    parser = _Blocks()
    parser.feed(html)
    return [(tag, " ".join(text.split())) for tag, text in parser.out if text.strip()]


def spine(book: zipfile.ZipFile) -> list[str]:
    """Names of a book's chapters in reading order."""
    box = E.fromstring(book.read("META-INF/container.xml"))
    root = next(x.get("full-path") for x in box.iter() if x.tag.endswith("rootfile"))
    package = E.fromstring(book.read(root))
    items = {x.get("id"): x.get("href") for x in package.iter() if x.tag.endswith("}item") or x.tag == "item"}
    order = [x.get("idref") for x in package.iter() if x.tag.endswith("itemref")]
    return [posixpath.normpath(posixpath.join(posixpath.dirname(root), items[i])) for i in order if i in items]


def epub_blocks(spark: SparkSession, path: str) -> DataFrame:
    """path, chapter, block, tag, text of ebooks, a book at a time."""
    schema = pa.schema([("path", pa.string()), ("chapter", pa.int32()), ("block", pa.int32()), ("tag", pa.string()), ("text", pa.string())])

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as book:
                    rows = [{"path": name, "chapter": c, "block": i, "tag": tag, "text": text} for c, part in enumerate(spine(book)) for i, (tag, text) in enumerate(html_blocks(book.read(part).decode("utf-8", "replace")))]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, "path string, chapter int, block int, tag string, text string")


def word_boxes(spark: SparkSession, path: str) -> DataFrame:
    """OCR tables of word boxes, tab separated, with the page in the file's name."""
    schema = "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, height int, conf double, text string"
    rows = spark.read.csv(path, sep="\t", header=True, schema=schema, quote="")
    return rows.withColumn("page", F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(F.input_file_name(), r"(\d+)\.tsv$", 1), F.lit("")), F.lit("999999")).cast("int"), F.col("page_num")))


def flags(spark: SparkSession, path: str) -> DataFrame:
    """file, quote, issue, suggestion, confidence of flag files, a JSON object a line."""
    rows = spark.read.json(path, schema="file string, chunk int, seconds double, flags array<struct<quote:string,issue:string,suggestion:string,confidence:string,found:boolean>>")
    return rows.select("file", "chunk", F.explode("flags").alias("x")).select("file", "chunk", "x.*")


def word_scores(spark: SparkSession, path: str) -> DataFrame:
    """file, at, word, lp, best, best_lp of score files: {file: [[word, lp, best, best_lp], ...]}."""
    rows = whole_texts(spark, path).select(F.from_json("text", "map<string,array<array<string>>>").alias("m")).select(F.explode("m").alias("file", "w")).select("file", F.posexplode("w").alias("at", "x"))
    return rows.select("file", "at", F.col("x")[0].alias("word"), F.col("x")[1].cast("double").alias("lp"), F.col("x")[2].alias("best"), F.col("x")[3].cast("double").alias("best_lp"))


def verses(spark: SparkSession, path: str) -> DataFrame:
    """book, chapter, verse, text of a file of lines 'Book 1:2<tab>text'."""
    pattern = r"^(.+?) (\d+):(\d+)\t(.*)$"
    rows = spark.read.text(path).filter(F.col("value").rlike(pattern))
    one = lambda i: F.regexp_extract("value", pattern, i)
    book = F.when(one(1) == "Psalm", "Psalms").when(one(1) == "Song of Songs", "Song of Solomon").otherwise(one(1))
    return rows.select(book.alias("book"), one(2).cast("int").alias("chapter"), one(3).cast("int").alias("verse"), one(4).alias("text"))


def report_entries(spark: SparkSession, path: str) -> DataFrame:
    """path, section, entry, times of a review report in Markdown."""
    from pyspark.sql import Window

    rows = whole_texts(spark, path).select("path", F.posexplode(F.split("text", "\n")).alias("line", "s"))
    head = F.when(F.col("s").startswith("## "), F.substring("s", 4, 1000))
    rows = rows.withColumn("section", F.last(head, ignorenulls=True).over(Window.partitionBy("path").orderBy("line").rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("s").startswith("- "))
    times = F.regexp_extract("s", r"×(\d+)\s*$", 1)
    return rows.select("path", "section", F.trim(F.regexp_replace(F.substring("s", 3, 100000), r"\s*×\d+\s*$", "")).alias("entry"), F.coalesce(F.try_to_number(F.nullif(times, F.lit("")), F.lit("999999")).cast("int"), F.lit(1)).alias("times"))


def settings(text: str) -> dict:
    """A book's settings, as data: a TOML text. Nothing in it is run."""
    import tomllib

    return tomllib.loads(text)


def matching(names: list[str], wanted: str) -> str:
    """The one name that holds the wanted part, ignoring case."""
    found = [n for n in names if wanted.lower() in n.lower()]
    exact = [n for n in found if n.lower() == wanted.lower()]
    if len(exact or found) != 1:
        raise LookupError(f"{wanted!r} names {len(found)} of {len(names)}")
    return (exact or found)[0]


def division_types(documents: DataFrame) -> DataFrame:
    """type, n of the divisions of XML texts."""
    found = F.regexp_extract_all("xml", F.lit(r'<div[1-6]?\b[^>]*\btype="([^"]*)"'), F.lit(1))
    return documents.select(F.explode(found).alias("type")).groupBy("type").agg(F.count("*").alias("n"))


def text_of_pages(text: str) -> list[tuple[int, str]]:
    """(page, text) of an export, for one text."""
    parts = re.split(r"(?m)^--- Source PDF page (\d+) \(OCR sequence \d+\) ---$\n?", text)
    return [(int(n), t.rstrip("\n")) for n, t in zip(parts[1::2], parts[2::2], strict=True)]
