"""Texts that arrive in batches of files: each is handled once, and a stopped query goes on where it was."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vellumq.functions import text as T


def arriving(spark: SparkSession, path: str, schema, files: int | None = None) -> DataFrame:
    """Rows of Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def word_counts(documents: DataFrame) -> DataFrame:
    return documents.select(F.explode(T.words(F.col("text"))).alias("w")).groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n"))


def resumable(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends what is new to a table and stops; called again, it goes on with files it has not seen."""
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def token_rows(documents: DataFrame) -> DataFrame:
    """doc_id, pos, word: a stateless step, so nothing is kept between batches."""
    return documents.select("doc_id", F.posexplode(T.words(F.col("text"))).alias("pos", "word"))


def counted_by_word(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Partial counts of each batch, appended; reading sums them, so the state stays in the table and not in the query."""
    def add(batch: DataFrame, number: int) -> None:
        # a batch that is run again after a failure overwrites its own folder only
        word_counts(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).groupBy("word").agg(F.sum("n").alias("n"))


def unique(rows: DataFrame, keys: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """Rows once for each key, within what may arrive late."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def windowed(events: DataFrame, size: str = "1 hour", late: str | None = "1 hour") -> DataFrame:
    """An extension: counts of events by type in windows of their own time. late: None if the rows have a watermark already."""
    events = events.withWatermark("ts", late) if late else events
    return events.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "event_type", "n", "value")
