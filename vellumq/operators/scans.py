"""Scanned pages: bundles of page texts, word boxes, lines, crops, and page geometry."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from vellumq.functions import text as T
from vellumq.operators.align import ratio

#: Fixed value: the line before each page of an export.
PAGE_MARK = r"(?m)^--- Source PDF page (\d+) \(OCR sequence \d+\) ---$"


def exported(pages: DataFrame, group: str = "scan") -> DataFrame:
    """group, text: the pages (group, page, text) in order, each after its mark."""
    rows = pages.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("p"))
    one = lambda p, i: F.concat(F.lit("--- Source PDF page "), p["page"], F.lit(" (OCR sequence "), i + 1, F.lit(") ---\n"), p["text"])
    return rows.select(group, F.array_join(F.transform("p", one), "\n").alias("text"))


def read_back(texts: DataFrame, group: str = "scan") -> DataFrame:
    """group, page, text of an export."""
    numbers = F.regexp_extract_all("text", F.lit(PAGE_MARK), F.lit(1))
    bodies = F.split("text", PAGE_MARK + r"\n?")
    both = F.zip_with(numbers, F.slice(bodies, 2, F.size(bodies)), lambda n, t: F.struct(n.cast("int").alias("page"), F.regexp_replace(t, r"\n$", "").alias("text")))
    return texts.select(group, F.explode(both).alias("x")).select(group, "x.page", "x.text")


def lines(boxes: DataFrame) -> DataFrame:
    """page, block, par, line, box and words of the word rows (level 5) of an OCR table."""
    words = boxes.filter((F.col("level") == 5) & (F.trim("text") != ""))
    rows = words.groupBy("page", "block_num", "par_num", "line_num").agg(
        F.min("left").alias("left"), F.min("top").alias("top"), F.max(F.col("left") + F.col("width")).alias("right"), F.max(F.col("top") + F.col("height")).alias("bottom"),
        F.array_sort(F.collect_list(F.struct("word_num", "text"))).alias("w"),
    )
    return rows.withColumn("words", F.transform("w", lambda x: x["text"])).drop("w")


def best_window(lines: DataFrame, wanted: list[str], n: int = 2) -> DataFrame:
    """page, hits, at, box: of each page the n neighbouring lines that hold most of the wanted words, the first of equals. A word is held if the keys are equal or, beyond three letters, alike by 0.75."""
    own = lines.select("*", F.transform("words", T.crop_key).alias("keys"))
    keys = [r[0] for r in lines.sparkSession.createDataFrame([(w,) for w in wanted], "w string").select(T.crop_key(F.col("w"))).collect()]  # the words asked for
    keys = [k for k in keys if len(k) > 1]

    def hold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [[i for i, k in enumerate(keys) if any(k == h or len(k) > 3 and ratio(k, h) >= 0.75 for h in row)] for row in batch.column("keys").to_pylist()]
            yield batch.append_column("held", pa.array(held, pa.list_(pa.int32()))) if batch.num_rows else pa.RecordBatch.from_arrays([*batch.columns, pa.array([], pa.list_(pa.int32()))], names=[*batch.schema.names, "held"])

    order = Window.partitionBy("page").orderBy("block_num", "par_num", "line_num")
    span = order.rowsBetween(0, n - 1)
    rows = own.mapInArrow(hold, T_.StructType([*own.schema.fields, T_.StructField("held", T_.ArrayType(T_.IntegerType()))])).withColumn("at", F.row_number().over(order))
    box = [F.min("left").over(span).alias("left"), F.min("top").over(span).alias("top"), F.max("right").over(span).alias("right"), F.max("bottom").over(span).alias("bottom")]
    rows = rows.select("page", "at", F.size(F.array_distinct(F.flatten(F.collect_list("held").over(span)))).alias("hits"), *box)
    return rows.filter("hits > 0").groupBy("page").agg(F.max_by(F.struct("at", "left", "top", "right", "bottom"), F.struct("hits", -F.col("at"))).alias("b"), F.max("hits").alias("hits")).select("page", "hits", "b.*")


def dehyphenated(text: str = "text"):
    return F.regexp_replace(text, r"-\n(?=[a-z])", "")


def margins(edges: DataFrame) -> DataFrame:
    """Median and least inner and outer edge of a book's pages; edges: book, page, inner, outer."""
    return edges.groupBy("book").agg(F.median("inner").alias("median_inner"), F.median("outer").alias("median_outer"), F.min("inner").alias("least_inner"), F.min("outer").alias("least_outer"), F.min_by("page", F.struct("inner", "page")).alias("narrowest"))


MOST_STEPS = 10_000


def inside_margin(books: DataFrame, steps: DataFrame) -> DataFrame:
    """The margin that a printer asks for by number of pages; steps: least pages, margin, a table of MOST_STEPS rows at most (more are an error)."""
    n = steps.limit(MOST_STEPS + 1).count()
    if n > MOST_STEPS:
        raise ValueError(f"{MOST_STEPS} steps at most")
    return books.join(F.broadcast(steps), F.col("pages") >= F.col("least")).groupBy("book", "pages").agg(F.max_by("margin", "least").alias("margin"))


def body_size(runs: DataFrame) -> DataFrame:
    """book, size: the size that most text is set in, the larger of equals; runs: book, size, text."""
    return runs.groupBy("book", "size").agg(F.sum(F.length("text")).alias("n")).groupBy("book").agg(F.max_by("size", F.struct("n", "size")).alias("size"))


def stray_numbers(notes: DataFrame) -> DataFrame:
    """Notes (page, at, n) that don't follow the note before by one, or begin at 1."""
    w = Window.partitionBy("page").orderBy("at")
    return notes.withColumn("before", F.lag("n").over(w)).filter((F.col("n") != 1) & (F.col("before").isNull() | (F.col("n") != F.col("before") + 1)))


def done_pages(pages: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is still to be read: resuming is an anti-join."""
    return pages.join(done.select(*keys).distinct(), keys, "left_anti")
