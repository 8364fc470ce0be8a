"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Paths made within each open scope, the innermost last.
_scopes: list[list[str]] = []


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object of ``path``; for renaming and removing on the driver."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, if it is there."""
    files, where = file_system(spark, path)
    files.delete(where, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove what was staged within it at its end. Results must be written by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


@contextmanager
def spent(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each query as soon as it ends, of those begun within it.

    Else they stay until the driver happens to collect its garbage, beside all that comes after.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset a local session gets a temporary folder; a cluster session is an error,
    since a folder of one machine would not be seen by the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeloom-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses; removed at the end of a scope."""
    path = f"{shared_folder(spark).rstrip('/')}/lakeloom/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh parquet folder and read it back.

    The result has a short lineage and survives lost executors, and reads of it are pruned to
    the columns and rows they need.
    """
    path = fresh_path(df.sparkSession, label)
    with spent(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """:func:`stage` of what ``make`` returns; what it staged itself is removed when that is written."""
    path = fresh_path(spark, label)
    with scope(spark), spent(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_slices(
    df: DataFrame, keys: list[str], count: int, label: str, make: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``make(df)``, for one that treats the rows of each value of ``keys`` alone, in ``count`` slices.

    The slices are by the hash of ``keys``, NULLs too. Each is written before the next one begins, so what
    one shuffles is all that lies on disk at a time; each reads the columns of ``df`` that it needs.
    """
    if count < 2:
        return make(df)
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    for nth in range(count):
        part = make(df.where(F.pmod(F.xxhash64(*keys), F.lit(count)) == nth))
        with spent(spark):
            part.write.mode("append").parquet(path)
    return spark.read.schema(part.schema).parquet(path)
