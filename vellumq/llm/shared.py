"""Tables in the folder that driver and executors share, and other small helpers."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where that is unset, on one machine only, as in tests, a folder of our own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="vellumq-")
    return _own["dir"]


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read again: cuts the lineage and survives lost executors. options: the writer's."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/vellumq-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Removes the files of a table made by written(), once nothing reads it any more."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session has ended: the cluster's own cleaning of that folder remains
        pass


def unused(name: str, *tables: DataFrame) -> str:
    """A column name like this that none of the tables has, however letters are cased."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo: the folds of the labelled rows."""
    return F.pmod(F.crc32(F.encode(key.cast("string"), "UTF-8")), F.lit(modulus))


def within(key: Column, share: float) -> Column:
    """Whether a 64-bit hash lies in this share of all hashes, in parts of 2^62: a sample of some rows is none at no number of rows."""
    parts = 1 << 62
    return F.shiftrightunsigned(key, 2) < min(parts, max(1, int(share * parts)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
