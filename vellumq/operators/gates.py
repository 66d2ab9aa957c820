"""Versions, sign-offs, gates, fingerprints and catalogues, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellumq.functions import text as T


def latest(rows: DataFrame, unit: list[str], order: list[Column]) -> DataFrame:
    """The last row of each unit. The limit is also taken before the shuffle."""
    w = Window.partitionBy(*unit).orderBy(*[c.desc() for c in order])
    return rows.withColumn("__at", F.row_number().over(w)).filter("__at = 1").drop("__at")


def latest_version(tags: DataFrame) -> DataFrame:
    """unit, version (numbers): versions compare number by number."""
    return tags.groupBy("unit").agg(F.max(T.version_numbers(F.col("tag"))).alias("version"))


def next_point(version: Column) -> Column:
    """After 14 comes 14.1, after 14.1 14.2."""
    last = F.element_at(version, -1)
    return F.when(F.size(version) == 1, F.concat(version, F.array(F.lit(1)))).otherwise(F.concat(F.slice(version, 1, F.size(version) - 1), F.array(last + 1)))


def state(facts: DataFrame) -> DataFrame:
    """holds: no changes and no problems; done: holds and signed; carried: signed and changed without problems.  facts: unit, changed, problems (arrays), signed."""
    clean, unchanged = F.size("problems") == 0, F.size("changed") == 0
    holds = clean & unchanged
    named = F.when(holds & F.col("signed"), "done").when(~clean, "held").when(F.col("signed") & ~unchanged, "carried").when(holds, "ready").otherwise("changed")
    return facts.withColumn("holds", holds).withColumn("state", named)


def gates(rows: DataFrame, unit: str, rules: dict[str, Column]) -> DataFrame:
    """unit, gate, ok: a row for each gate of each unit."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("gate"), F.coalesce(c, F.lit(False)).alias("ok")) for k, c in rules.items()]))
    return rows.select(unit, each.alias("x")).select(unit, "x.gate", "x.ok")


def fingerprints(rows: DataFrame, key: str, content: str, snapshot: str) -> DataFrame:
    return rows.select(F.lit(snapshot).alias("snapshot"), F.col(key).cast("string").alias("key"), F.sha2(F.coalesce(content, F.lit("")), 256).alias("sha256"))


def manifest(prints: DataFrame, group: str) -> DataFrame:
    """group, n, sha256: a tree of digests. A group's files fall into 4,096 branches by the digest of their keys; a branch is the digest of its lines 'digest  key' in the order of keys, and the group that of its branches 'branch:digest' in order.

    However many files a group has, no row holds more than a branch.
    """
    branch = F.substring(F.sha2(F.coalesce(F.col("key"), F.lit("")), 256), 1, 3)
    rows = prints.groupBy(group, branch.alias("branch")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("key", "sha256"))).alias("x"))
    one = rows.select(group, "branch", "n", F.sha2(F.array_join(F.transform("x", lambda r: F.concat(r["sha256"], F.lit("  "), r["key"])), "\n"), 256).alias("sha256"))
    whole = one.groupBy(group).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("branch", "sha256"))).alias("x"))
    return whole.select(group, "n", F.sha2(F.array_join(F.transform("x", lambda r: F.concat_ws(":", r["branch"], r["sha256"])), "\n"), 256).alias("sha256"))


def compared(old: DataFrame, new: DataFrame) -> DataFrame:
    """key, change (added, gone, changed, same) of two snapshots."""
    both = old.select("key", F.col("sha256").alias("was")).join(new.select("key", F.col("sha256").alias("now")), "key", "full_outer")
    return both.select("key", F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "gone").when(F.col("was").eqNullSafe(F.col("now")), "same").otherwise("changed").alias("change"))


def changed_since(tagged: DataFrame, uncommitted: DataFrame) -> DataFrame:
    """path: the union of both."""
    return tagged.select("path").unionByName(uncommitted.select("path")).distinct()


def added_and_gone(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """change, key: entries of one side only; repeats stay."""
    return after.join(before.select(key).distinct(), key, "left_anti").select(F.lit("added").alias("change"), key).unionByName(before.join(after.select(key).distinct(), key, "left_anti").select(F.lit("gone").alias("change"), key))


def catalogue(units: DataFrame, files: DataFrame) -> DataFrame:
    """unit, entry: a JSON entry with the unit's files in order."""
    held = files.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("name", "bytes", "sha256"))).alias("files"))
    return units.join(held, "unit", "left").select("unit", F.to_json(F.struct("unit", "version", F.coalesce("files", F.array().cast("array<struct<name:string,bytes:bigint,sha256:string>>")).alias("files"))).alias("entry"))


def inherited(rows: DataFrame, parents: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Own values, else those of the parent row with the key."""
    up = parents.select(F.col(key).alias("__k"), *[F.col(f).alias(f"__{f}") for f in fields])
    joined = rows.join(up, F.col(key) == F.col("__k"), "left")
    return joined.select(*[c for c in rows.columns if c not in fields], *[F.coalesce(f, f"__{f}").alias(f) for f in fields])


def covered(blocks: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Blocks that no part holds."""
    return blocks.join(parts.select(key).distinct(), key, "left_anti")


def exactly_one(rows: DataFrame, corrections: DataFrame, key: str) -> DataFrame:
    """key, n of the corrections whose key doesn't match exactly one row."""
    n = rows.groupBy(key).agg(F.count("*").alias("n"))
    return corrections.select(key).distinct().join(n, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n")).filter("n <> 1")


def editions(files: DataFrame) -> DataFrame:
    """path, kind, volume, edition from the path alone."""
    path = F.col("path")
    kind = F.when(path.endswith(".epub"), "epub").when(path.endswith(".pdf"), "pdf").when(path.endswith(".typ"), "chapter").when(path.endswith(".xml"), "tei").otherwise("other")
    volume = F.try_to_number(F.nullif(F.regexp_extract(path, r"vol(?:ume)?[-_]?(\d+)", 1), F.lit("")), F.lit("999")).cast("int")
    return files.select("path", kind.alias("kind"), volume.alias("volume"), F.when(path.rlike(r"(^|[/_-])modern([/_.-]|$)"), "modern").otherwise("classic").alias("edition"))
