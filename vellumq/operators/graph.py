"""Connected components and closures of edge tables, without bringing edges to the driver."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints; where it names none, on one machine only, one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="vellumq-"))
    return _own[0]


def settled(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage. The table goes when the session ends, or by dropped()."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    dropped_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows over as many tasks as the session's shuffles have. Adaptive execution joins small partitions by their bytes, which leaves few tasks to work that is heavy for its bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def dropped_at_exit(spark: SparkSession, path: str) -> None:
    """The folder goes when the session's program ends."""
    atexit.register(_delete, spark, path)


def dropped(table: DataFrame) -> None:
    """Deletes the files of a table made by settled(), once nothing reads it any more."""
    for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
        _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session has ended: the cluster's own cleaning of that folder remains
        pass


def contracted(edges: DataFrame, together: int = 500_000) -> DataFrame:
    """Edges (a, b) that connect the same nodes: within each task the edges are joined into stars around their least node, about ``together`` nodes at once."""

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict = {}

        def top(x):
            path = []
            while x in above:
                path.append(x)
                x = above[x]
            for y in path:
                above[y] = x
            return x

        def stars() -> pa.RecordBatch:
            nodes = sorted(above)
            out = pa.RecordBatch.from_arrays([pa.array([top(x) for x in nodes], pa.int64()), pa.array(nodes, pa.int64())], names=["a", "b"])
            above.clear()
            return out

        for batch in batches:
            for x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if x is not None and y is not None and (low := top(x)) != (other := top(y)):
                    above[max(low, other)] = min(low, other)
            if len(above) >= together:
                yield stars()
        yield stars()

    return edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(join, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node) of the edges (a, b): edges are contracted within each task, twice; then each node takes the least label around it, then its label's label, until nothing changes."""
    stars = settled(contracted(contracted(edges).repartition("a")))
    both = settled(stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(around, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("was"))
        up = step.select(F.col("node").alias("component"), F.col("component").alias("top"))
        after = settled(step.join(up, "component").select("node", F.least("component", "top").alias("component"), "was"))
        done = after.filter("component <> was").isEmpty()
        dropped(labels)
        labels = after.select("node", "component")
        if done:
            dropped(both)
            return labels


def closure(edges: DataFrame, start: DataFrame) -> DataFrame:
    """start, node: everything reachable along the edges (from, to), the start itself included; each round goes on from new nodes only, and writes these alone."""
    new = reached = settled(start.select("start", F.col("start").alias("node")).distinct())
    while not new.isEmpty():
        step = new.join(edges.select(F.col("from").alias("node"), "to"), "node").select("start", F.col("to").alias("node")).distinct()
        new = settled(step.join(reached, ["start", "node"], "left_anti"))
        reached = reached.unionByName(new)
    return reached
