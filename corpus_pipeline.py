"""The corpus pipeline: each stage calls one training-data operator on all that the stage before kept.

toxicity drops the documents it rejects; near_duplicates keeps one document of each group; decontamination drops documents with
benchmark passages; private_data redacts; packing returns the token pieces.

All stages: rows are kept or dropped whole, with all their columns, also extra ones, whatever their names; null and empty texts and null ids are rows like
others and stay; very long texts are read whole; an empty table gives an empty one. What ties and repeated rows do stands at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumq.llm import decontaminate, jaccard, packing, private, shared
from vellumq.llm import toxicity as toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.5; those at 0.5 go.

    The model learns from all labelled documents of the stage's input, within the operator's bounds. Without labels of both kinds every score is the
    share of label 1, 0 without any toxic ones: all stay, or, with toxic labels alone, all go; without labels the score is not known and all stay. Null and empty texts have
    the score of a text without features. Repeated rows have one score.
    """
    labels = shared.table(spark, sf_dir, "labels")
    if labels.join(docs, "doc_id", "left_semi").filter(F.col("toxic").isNotNull()).isEmpty():
        return docs
    return toxic.kept(docs, labels, F.lit(True), threshold=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles agree by 80 % or more: the one with the least doc_id, null last, of equal ids that with the least hash of its text.

    Of repeated rows one stays. Texts without words are in no group and all stay; a text of fewer words than five is one shingle.
    """
    return jaccard.deduplicated(docs, 5, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages: none of an item's windows of ten words, nor a whole item of fewer.

    Items without words, and an empty benchmark, reject nothing. Repeated rows share one fate.
    """
    return decontaminate.cleaned(docs, shared.table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents, personal data replaced by its kind in brackets; n_chars is the new length, and stays for a null text.

    The model learns from contexts of the stage's own input; without any it learns from seeded ones. Spans that overlap are one replacement, named by the first.
    Repeated rows are redacted alike.
    """
    return private.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces whose lengths are powers of two. A null or empty text is its end token alone; repeated rows are packed each for itself."""
    return packing.digests(packing.pack_documents(docs))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("private_data", private_data), ("packing", pack)]

#: The toxicity model and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
