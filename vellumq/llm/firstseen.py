"""First-seen line stripping: batches of documents lose the lines that enough documents of earlier batches held.

1. ``cut`` writes the rows once, by batch, with the keys of their lines that are long enough; each file of a batch is moved into the folder that the stream reads when its turn comes.
2. A native streaming aggregation counts the documents and lines of every (key, batch). It is started anew for each batch on one checkpoint; its state is all that is remembered.
3. Before each start the committed state is read by Spark's state store source. Keys that enough documents held are a table; the new batch's lines are joined with it, and
   the batch's documents are written without the lines that it names.
4. After the last batch the state gives the ledger: each key that lost lines, since when, and how many.

Nothing of a batch or of the state goes through one task, the driver or a broadcast: lines are joined with a written table by a merge join, whose hot keys adaptive execution can split; the state
is dealt over the session's shuffle partitions, and its provider is the session's (for a state beyond the executors' memory that of RocksDB). State maps aren't kept in memory between starts.

Defined results: a null or empty text has one empty line; trailing empty lines count; repeated rows are documents of their own and hold their keys each; a null doc_id counts as the empty
string where batches are numbered, and its row_id is null; very long texts and lines are taken whole; a batch without rows is an empty one and still started; an empty table gives no rows; extra columns,
whatever their names, stay with the documents.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellumq.llm import shared

#: What is stripped from a line's ends (0x20, 0x09 to 0x0D); the letters that are lower-cased.
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text; a null text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """The line stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


class Stripper:
    """Feeds batches of documents to a stream that counts keys, and strips each batch by the state before it.

    ``batch`` numbers the rows from 0 to ``batches`` - 1. A line goes if its key has at least ``least`` code points and at least ``held`` documents of earlier batches had it.
    """

    def __init__(self, docs: DataFrame, batch: Column, batches: int, least: int = 20, held: int = 2, text: str = "text"):
        self.spark, self.batches, self.least, self.held, self.columns = docs.sparkSession, batches, least, held, docs.columns
        self.folder = f"{shared.shared_dir(self.spark)}/vellumq-first-seen-{uuid.uuid4().hex}"
        atexit.register(shared._remove, self.spark, self.folder)
        self.row, self.lines, self.number = (shared.unused(n, docs) for n in ("row", "lines", "batch"))
        self.text = text
        self.schema = self.cut(docs, batch)

    def cut(self, docs: DataFrame, batch: Column):
        """Writes the rows by batch: their columns, a number of the row, and (key, line's number) of the lines that are long enough, by key."""
        line = lambda x, i: F.struct(key_of(x).alias("key"), i.alias("line"))
        long = F.filter(F.transform(lines_of(F.col(self.text)), line), lambda x: F.length(x["key"]) >= self.least)
        keyed = F.array_sort(F.transform(long, lambda x: F.struct(F.unhex(F.sha2(x["key"], 256)).alias("key"), x["line"].alias("line"))))
        rows = docs.select("*", F.monotonically_increasing_id().alias(self.row), keyed.alias(self.lines), batch.cast("int").alias(self.number))
        rows.write.partitionBy(self.number).parquet(f"{self.folder}/cut")
        for n in range(self.batches):
            if not self._is_there(f"cut/{self.number}={n}"):
                rows.drop(self.number).limit(0).write.parquet(f"{self.folder}/cut/{self.number}={n}")
        return rows.schema

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self):
        return self._path("cut").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _is_there(self, name: str) -> bool:
        return self._files().exists(self._path(name))

    def rows(self, n: int) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", f"{self.folder}/feed").parquet(f"{self.folder}/feed/{self.number}={n}")

    def feed(self, n: int) -> None:
        """Moves a batch's files into the folder that the stream reads."""
        fs = self._files()
        fs.mkdirs(self._path("feed"))
        if not fs.rename(self._path(f"cut/{self.number}={n}"), self._path(f"feed/{self.number}={n}")):
            raise OSError(f"batch {n} can't be moved in {self.folder}")

    def counts(self, stream: DataFrame) -> DataFrame:
        """The streaming aggregation: documents and lines by key and batch. A row's keys are in order, so its first of each stands for the document."""
        own = F.col(self.lines)
        one = lambda x, i: F.struct(x["key"].alias("key"), F.when((i > 0) & (F.get(own, i - 1)["key"] == x["key"]), 0).otherwise(1).cast("long").alias("first"))
        told = stream.select(F.col(self.number).alias("batch"), F.inline(F.transform(own, one)))
        return told.groupBy("key", "batch").agg(F.sum("first").alias("docs"), F.count("*").alias("n"))

    def start(self) -> None:
        """One start of the stream on its checkpoint: takes the files that are new, and ends."""
        spark = self.spark
        retained = "spark.sql.streaming.maxBatchesToRetainInMemory"
        was = spark.conf.get(retained, None)
        spark.conf.set(retained, "0")
        try:
            stream = spark.readStream.schema(self.schema).parquet(f"{self.folder}/feed")
            self.counts(stream).writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start().awaitTermination()
        finally:
            spark.conf.unset(retained) if was is None else spark.conf.set(retained, was)

    def state(self) -> DataFrame:
        """key, batch, docs, n as the state that was committed last has them."""
        rows = self.spark.read.format("statestore").load(f"{self.folder}/state")
        docs, n = (f.name for f in rows.schema["value"].dataType.fields)
        return rows.select("key.key", "key.batch", F.col("value")[docs].alias("docs"), F.col("value")[n].alias("n"))

    def known(self) -> DataFrame:
        """key: those that enough documents have held."""
        return self.state().groupBy("key").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= self.held).select("key")

    def stripped(self, n: int) -> DataFrame:
        """The batch's rows with ``n_all`` and ``n_removed`` lines and ``kept``, the text without the removed ones, as columns of a struct ``outcome`` beside the struct ``doc``."""
        rows, row = self.rows(n), F.col(self.row)
        doc = F.struct(*(F.col(c) for c in self.columns)).alias("doc")
        kept = rows.select(row.alias("row"), doc)
        if n:
            known = shared.written(self.known(), "known")
            own = rows.select(row.alias("row"), F.inline(self.lines))
            lost = own.join(known.hint("merge"), "key", "left_semi").groupBy("row").agg(F.collect_list("line").alias("gone"))  # at most a row's own lines
            kept = kept.join(lost.hint("merge"), "row", "left")
        else:
            kept = kept.withColumn("gone", F.lit(None).cast("array<int>"))
        lines = lines_of(F.col("doc")[self.text])
        gone = F.coalesce("gone", F.array().cast("array<int>"))
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        told = kept.select("doc", "gone", F.size(lines).cast("long").alias("n_all"), F.size(gone).cast("long").alias("n_removed"), lines.alias("own"), stay.alias("stay"))
        text = F.when(F.col("n_removed") == 0, F.coalesce(F.col("doc")[self.text], F.lit(""))).otherwise(F.array_join(F.transform("stay", lambda i: F.get(F.col("own"), i)), "\n"))
        return told.select("doc", F.struct(F.lit(n).alias("batch"), "n_all", "n_removed", text.alias("kept")).alias("outcome"))

    def run(self, outcome: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
        """All batches in order; what ``outcome`` makes of each one's stripped rows is written and returned."""
        out = None
        for n in range(self.batches):
            self.feed(n)
            told = outcome(self.stripped(n))
            told.write.parquet(f"{self.folder}/out/part={n}")
            out = out or told.schema
            self.start()
        return self.spark.read.schema(out).parquet(*(f"{self.folder}/out/part={n}" for n in range(self.batches)))

    def ledger(self) -> DataFrame:
        """key, batch, n_all, n_removed of every key that lost lines: the first batch that lost some, all documents that held it, and the lines lost."""
        order = Window.partitionBy("key").orderBy("batch")  # as many rows as batches
        before = F.coalesce(F.sum("docs").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        told = self.state().withColumn("lost", before >= self.held).groupBy("key")
        return told.agg(F.min(F.when(F.col("lost"), F.col("batch"))).alias("batch"), F.sum("docs").alias("n_all"), F.sum(F.when(F.col("lost"), F.col("n"))).alias("n_removed")).filter("batch IS NOT NULL")


def op12_first_seen_lines(spark: SparkSession, sf_dir: str, batches: int = 10) -> DataFrame:
    """Ten batches of all documents, each without the lines of 20 characters or more that two documents of earlier batches held, and the ledger of the lines."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    number = F.floor(F.lit(batches) * shared.fold(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 64) / 64)
    stripper = Stripper(docs, number, batches)
    columns = ("row_kind", "row_id", "batch", "n_all", "n_removed", "kept_sha256")

    def digest(rows: DataFrame) -> DataFrame:
        return rows.select(F.lit("doc").alias("row_kind"), F.col("doc.doc_id").cast("string").alias("row_id"), "outcome.batch", "outcome.n_all", "outcome.n_removed", F.sha2("outcome.kept", 256).alias("kept_sha256"))

    documents = stripper.run(digest)
    lines = stripper.ledger().select(F.lit("line").alias("row_kind"), F.lower(F.hex("key")).alias("row_id"), "batch", "n_all", "n_removed", F.lit(None).cast("string").alias("kept_sha256"))
    return documents.select(*columns).unionByName(lines.select(*columns))


ORACLE_SQL = r"""
WITH RECURSIVE bits(i, step, v) AS (SELECT i, 0, i::UBIGINT FROM range(256) t(i) UNION ALL SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM bits WHERE step < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE step = 8),
docs AS (
  SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS text,
    10 * (xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(list_filter(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: x <> ''), lambda x: ascii(x)::UBIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::INTEGER + 1])), 4294967295::UBIGINT) & 63)::INTEGER // 64 AS batch
  FROM documents, crc),
cut AS (SELECT d, batch, string_split(text, chr(10)) AS own FROM docs),
lines AS (SELECT d, batch, unnest(own) AS line, generate_subscripts(own, 1) AS place FROM cut),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
held AS (SELECT key, batch, count(DISTINCT d) AS docs, count(*) AS n FROM keyed WHERE length(key) >= 20 GROUP BY key, batch),
known AS (SELECT *, coalesce(sum(docs) OVER (PARTITION BY key ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 2 AS lost FROM held),
marked AS (SELECT k.d, k.batch, k.place, k.line, coalesce(o.lost, false) AS lost FROM keyed k LEFT JOIN known o ON o.key = k.key AND o.batch = k.batch),
told AS (SELECT d, count(*) AS n_all, count(*) FILTER (WHERE lost) AS n_removed, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256 FROM marked GROUP BY d)
SELECT 'doc' AS row_kind, doc_id::VARCHAR AS row_id, batch::INTEGER AS batch, n_all::BIGINT AS n_all, n_removed::BIGINT AS n_removed, kept_sha256 FROM docs JOIN told USING (d)
UNION ALL
SELECT 'line', sha256(key), min(batch) FILTER (WHERE lost)::INTEGER, sum(docs)::BIGINT, sum(n) FILTER (WHERE lost)::BIGINT, NULL FROM known GROUP BY key HAVING bool_or(lost)
"""
