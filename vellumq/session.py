"""Sessions and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Settings that hold at every size: adaptive plans, no fixed number of shuffle partitions beyond the cluster's own.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("vellumq").config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def views(spark: SparkSession, sf_dir: str) -> None:
    """All tables as temporary views, for SQL."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
