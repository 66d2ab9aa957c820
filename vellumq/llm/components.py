"""Connected components of an edge table, by alternating large and small stars.

Links stay in DataFrames: each round is two aggregations and two joins, written to the shared
folder. The minimum over a node's neighbours is a partial aggregate, so a node with very many
links costs a row a task; the joins' skewed side can be split by Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumq.llm import shared


def contracted(edges: DataFrame, chunk: int = 500_000) -> DataFrame:
    """Edges (a, b) with the links of each chunk of a task replaced by stars around the least node; the components stay."""

    def stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        def out() -> pa.RecordBatch:
            rows = [(x, r) for x in list(parent) if (r := root(x)) != x]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([r for _, r in rows], pa.int64()), pa.array([x for x, _ in rows], pa.int64())], names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > chunk:
                yield out()
        yield out()

    return edges.select("a", "b").mapInArrow(stars, "a bigint, b bigint")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of the edges (a, b); component: the least node."""
    now = shared.written(contracted(edges).distinct(), name)
    told = _sum(now)
    while True:
        ends = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = ends.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        # now a < b in each edge: small stars hang the lesser neighbours of b, and b, under the least of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b")
        small = small.select(F.col("m").alias("a"), F.col("a").alias("b")).filter("a < b").unionByName(low.select(F.col("m").alias("a"), "b")).distinct()
        after = shared.written(small, name)
        was, told = told, _sum(after)
        shared.remove(now)
        now = after
        if told == was:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())
