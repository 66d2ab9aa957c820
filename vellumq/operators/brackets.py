"""Body and notes of a text, parted by the depth of its brackets: a running sum over its pieces that never falls below zero."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: An escaped character, a bracket, a stretch of neither, or a lone backslash at the end.
PIECE = r"(?s)\\.|[()\[\]]|[^()\[\]\\]+|\\"


def pieces(documents: DataFrame) -> DataFrame:
    """doc_id, pos, piece, depth, was: the pieces of each text with the depth after and before each; a closer too many closes nothing, an escaped bracket is none."""
    rows = documents.select("doc_id", F.posexplode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({PIECE})"), 1)).alias("pos", "piece"))
    order = Window.partitionBy("doc_id").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sign = F.when(F.col("piece").isin("(", "["), 1).when(F.col("piece").isin(")", "]"), -1).otherwise(0)
    summed = rows.withColumn("sum", F.sum(sign).over(so_far)).withColumn("low", F.least(F.min("sum").over(so_far), F.lit(0)))
    return summed.withColumn("depth", F.col("sum") - F.col("low")).withColumn("was", F.coalesce(F.lag("depth").over(order), F.lit(0))).drop("sum", "low")


def parted(documents: DataFrame) -> DataFrame:
    """doc_id, part, depth, text: the body of each text (part 0), and each stretch within brackets, with its brackets (1, 2, ...), and how deep it goes. doc_id is unique; texts without brackets aren't moved."""
    some = F.coalesce(F.col("text").rlike(r"[(\[]"), F.lit(False))
    plain = documents.filter(~some).select("doc_id", F.lit(0).alias("part"), F.lit(0).alias("depth"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    noted = (F.col("depth") > 0) | (F.col("was") > 0)
    begins = (F.col("depth") > 0) & (F.col("was") == 0)
    rows = pieces(documents.filter(some)).withColumn("part", F.when(noted, F.sum(begins.cast("int")).over(order)).otherwise(0).cast("int"))
    texts = rows.groupBy("doc_id", "part").agg(F.max("depth").cast("int").alias("depth"), F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("own"))  # of one text
    told = texts.select("doc_id", "part", "depth", F.array_join(F.transform("own", lambda x: x["piece"]), "").alias("text"))
    bare = rows.groupBy("doc_id").agg(F.min("part").alias("least")).filter("least > 0").select("doc_id", F.lit(0).alias("part"), F.lit(0).alias("depth"), F.lit("").alias("text"))
    return plain.unionByName(told).unionByName(bare)
