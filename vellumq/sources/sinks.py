"""Tables as files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layer_files(rows: DataFrame, path: str, file: str = "file") -> None:
    """Texts in a folder for each file of the layout."""
    rows.repartition(file).write.mode("overwrite").partitionBy(file).text(path)


def write_if_changed(rows: DataFrame, path: str, key: str, content: str, volatile: str = r"<date>[^<]*</date>") -> int:
    """Appends the rows whose content, but for what always changes, isn't there yet; returns how many. Old rows stay, the newest row of a key counts."""
    spark = rows.sparkSession
    plain = F.sha2(F.regexp_replace(F.col(content), volatile, ""), 256)
    new = rows.select(key, content, plain.alias("sha256"), F.current_timestamp().alias("at"))
    try:
        old = latest(spark.read.parquet(path), key)
    except Exception as e:  # no such table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = new.limit(0)
    changed = new.join(old.select(key, "sha256"), [key, "sha256"], "left_anti")
    n = changed.count()
    if n:
        changed.write.mode("append").parquet(path)
    return n


def latest(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), "at").alias("x")).select(key, "x.*")


def report(decisions: DataFrame) -> DataFrame:
    """line: a decision report in order: each kind with its count, then its entries with theirs; decisions: type, orig, auto, n."""
    kinds = decisions.groupBy("type").agg(F.sum("n").alias("n")).select("type", F.lit(0).alias("at"), F.lit(0).alias("m"), F.lit("").alias("k"), F.format_string("## %s (%d)", "type", "n").alias("line"))
    entries = decisions.select("type", F.lit(1).alias("at"), (-F.col("n")).alias("m"), F.col("orig").alias("k"), F.concat(F.lit("- "), "orig", F.lit(" → "), "auto", F.when(F.col("n") > 1, F.concat(F.lit(" ×"), "n")).otherwise("")).alias("line"))
    return kinds.unionByName(entries).orderBy("type", "at", "m", "k").select("line")


def checksums(files: DataFrame) -> DataFrame:
    """line: 'sha256  name', in order of names."""
    return files.select("name", F.concat("sha256", F.lit("  "), "name").alias("line")).orderBy("name").select("line")


def json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def site_manifest(books: DataFrame, editions: DataFrame, files: DataFrame) -> DataFrame:
    """entry: a JSON object for each book: its editions in order, each with a map from kind to file."""
    held = files.groupBy("book", "edition").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "name")))).alias("files"))
    rows = editions.join(held, ["book", "edition"], "left").groupBy("book").agg(F.array_sort(F.collect_list(F.struct("edition", "version", "files")), lambda a, b: F.when(a["edition"] < b["edition"], -1).otherwise(F.when(a["edition"] > b["edition"], 1).otherwise(0))).alias("editions"))
    return books.join(rows, "book", "left").select("book", F.to_json(F.struct("book", "title", "editions")).alias("entry"))
