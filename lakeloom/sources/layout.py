"""How many partitions and files a table gets, and which joins are broadcast."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MB = 1024 * 1024

# At least this is no size but Spark's placeholder for an unknown one.
_UNKNOWN = 1 << 60

# Plan nodes whose output says nothing about the size of the result.
_UNSIZED = {"Join", "Generate", "Aggregate", "Expand", "Window", "Intersect", "Except"}


def _nodes(plan) -> list:
    children = plan.children()
    return [plan, *[n for i in range(children.size()) for n in _nodes(children.apply(i))]]


def estimated_bytes(df: DataFrame) -> int:
    """Bytes of what ``df`` scans, by the file listing or the catalog; no job runs.

    For plans of scans, filters, projections and unions. Over a join, explode or aggregate the
    input says little about the result and Spark's own estimate multiplies the sides, so that is an
    error, as is a scan of unknown size, such as a partitioned catalog table without statistics.
    """
    nodes = _nodes(df._jdf.queryExecution().optimizedPlan())
    unsized = sorted({n.nodeName() for n in nodes} & _UNSIZED)
    if unsized:
        raise ValueError(f"no size can be told over {unsized}: pass size_bytes")
    sizes = [int(n.stats().sizeInBytes()) for n in nodes if not n.children().size()]
    if any(size >= _UNKNOWN for size in sizes):
        raise ValueError("a scanned table has no known size: pass size_bytes")
    return sum(sizes)


def estimated_mb(df: DataFrame) -> float:
    """:func:`estimated_bytes` in MiB."""
    return estimated_bytes(df) / _MB


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the data files under a folder, by its listing; no job runs."""
    return estimated_bytes(spark.read.schema("unread int").parquet(path))


def partitions_for(size_bytes: int, target_mb: int = 200, floor: int = 3) -> int:
    """Whole partitions of about ``target_mb`` that hold ``size_bytes``, at least ``floor``."""
    return max(floor, math.ceil(math.ceil(size_bytes / _MB) / target_mb))


def sized_repartition(
    df: DataFrame,
    target_mb: int = 200,
    floor: int = 3,
    size_bytes: int | None = None,
    shuffle: bool = True,
) -> DataFrame:
    """Partitions of about ``target_mb``.

    ``size_bytes`` is needed where ``df`` has joins, see :func:`estimated_bytes`. A scan
    of splittable files already has many more, smaller partitions; ``shuffle=False`` joins those
    in place instead of moving every row.
    """
    size = estimated_bytes(df) if size_bytes is None else size_bytes
    count = partitions_for(size, target_mb, floor)
    return df.repartition(count) if shuffle else df.coalesce(count)


def compact(
    df: DataFrame, files: int, max_file_mb: int = 256, size_bytes: int | None = None
) -> DataFrame:
    """About ``files`` output files without a shuffle.

    Coalescing also narrows the stage that computes ``df``, so more files are kept when the size
    says that ``files`` of them would exceed ``max_file_mb`` each.
    """
    size = estimated_bytes(df) if size_bytes is None else size_bytes
    return df.coalesce(partitions_for(size, max_file_mb, files))


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` for writing: files of the size that adaptive execution is advised, whatever computes them.

    Small partitions are joined and large ones cut once their sizes are known, so the stages before the
    write stay as wide as they are. With ``columns``, those of a partitioned table, rows of one value come
    together, and a value with most of the rows is cut as well.
    """
    return df.hint("rebalance", *columns)


def broadcast_within(df: DataFrame, limit_mb: int = 32) -> DataFrame:
    """Mark ``df`` for broadcast if its estimated size is within the limit.

    Beyond it the join is left to Spark: adaptive execution still broadcasts a side that turns
    out small and splits skewed partitions of one that does not.
    """
    try:
        size = estimated_bytes(df)
    except ValueError:
        return df
    return F.broadcast(df) if size <= limit_mb * _MB else df


def keep(df: DataFrame) -> DataFrame:
    """Cache a small, reused table in memory, spilling to disk. Unpersist it after use."""
    return df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
