"""Data-quality checks and file-level statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def null_violations(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Rows with a NULL in any column but the excluded ones.

    By default the end of an open version may be NULL.
    """
    skipped = ["valid_to", "dbt_valid_to"] if exclude is None else exclude
    checks = [F.col(f"`{c}`").isNull() for c in df.columns if c not in skipped]
    return df.where(reduce(lambda a, b: a | b, checks, F.lit(False)))


def assert_not_null(df: DataFrame, exclude: list[str] | None = None) -> None:
    """Fail if :func:`null_violations` finds a row; stops reading at the first."""
    found = null_violations(df, exclude).first()
    if found is not None:
        empty = [c for c, value in found.asDict().items() if value is None]
        raise AssertionError(f"row with NULL in one of {empty}")


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """Non-null and distinct values of a column; they are equal if it is a key."""
    return df.agg(F.count(key).alias("cnt"), F.count_distinct(key).alias("cnt_dist"))


def file_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of each data file, and per column its least and greatest value and its NULLs.

    ``df`` must read files directly. Each task sums up its part of a file by hash before the
    shuffle. Extremes of text have no place in a hash aggregation, so a text column is first reduced
    to its distinct values of each file, by a scan of that column alone.
    """
    path = F.col("_metadata.file_path").alias("file_path")
    text = [c for c, kind in df.select(*cols).dtypes if kind in ("string", "binary")]
    stats = [F.count("*").alias("num_records")]
    for c in cols:
        if c not in text:
            stats += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
        stats.append(F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))
    found = df.groupBy(path).agg(*stats)
    for c in text:
        values = df.where(F.col(c).isNotNull()).select(path, c).distinct()
        ends = values.groupBy("file_path").agg(F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))
        found = found.join(ends, "file_path", "left")
    return found.select(
        "file_path", "num_records", *[f"{stat}_{c}" for c in cols for stat in ("min", "max", "nulls")]
    )


def files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """The files under ``path`` at any depth: path, bytes, modification time.

    Only the listing is read, never the content. Hidden files are left out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def file_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files and bytes per directory that directly holds files, with the newest change."""
    directory = F.regexp_replace("path", "/[^/]*$", "")
    return (
        files(spark, path, glob)
        .groupBy(directory.alias("directory"))
        .agg(
            F.count("*").alias("file_count"),
            F.sum("length").alias("total_bytes"),
            F.max("modificationTime").alias("last_modified"),
        )
    )


def tree_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Directories, files and bytes at or below ``path`` and each directory under it.

    A file counts for every directory above it, a directory also for itself. Directories without
    any file below them do not show.
    """

    def depth(column):
        # Levels of a path, leaving out a scheme and an authority.
        bare = F.regexp_replace(column, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
        return F.size(F.split(bare, "/"))

    def upward(directory):
        levels = depth(directory) - depth(F.lit(path.rstrip("/")))
        parts = F.size(F.split(directory, "/"))
        return F.transform(
            F.sequence(F.lit(0), levels),
            lambda up: F.array_join(F.slice(F.split(directory, "/"), 1, parts - up), "/"),
        )

    directory = F.col("directory")
    totals = (
        file_inventory(spark, path, glob)
        .select(
            F.explode(upward(directory)).alias("directory"),
            "file_count",
            "total_bytes",
            "last_modified",
        )
        .groupBy("directory")
        .agg(
            F.sum("file_count").alias("file_count"),
            F.sum("total_bytes").alias("total_bytes"),
            F.max("last_modified").alias("last_modified"),
        )
    )
    below = (
        totals.select(F.explode(upward(directory)).alias("directory"))
        .groupBy("directory")
        .agg(F.count("*").alias("dir_count"))
    )
    return below.join(totals, "directory")
