"""An index of a folder's data files by what their columns hold, and reads that open only files that may
hold what is asked for.

The index lies in the folder itself, under a name that readers of the folder pass over: a row for each
file with its rows and each column's least and greatest value, and for chosen columns a Bloom filter of
each file as bitmaps. A file counts as known if its path, length and time of change are those seen; files
that were added or replaced since are always read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.quality import file_stats
from lakeloom.sources.staging import file_system, fresh_path
from lakeloom.sources.tables import FORMAT, _replacing

#: Under a table's folder; readers skip names with an underscore.
INDEX = "_file_index"

#: Bits set for a value, and bits of a file's filter for each of its rows.
HASHES, BITS_PER_ROW = 4, 12

#: Bits of a bitmap as Spark's bitmap functions make them.
_BITMAP = 32768

#: A column to the values asked for, or to the ends of a range, None being open.
Wanted = dict[str, list | tuple]


def _identity() -> list[Column]:
    meta = F.col("_metadata")
    return [
        meta["file_path"].alias("file_path"),
        meta["file_size"].alias("file_size"),
        meta["file_modification_time"].alias("file_time"),
    ]


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """``path, file_path, file_size, file_time`` of the data files under a folder; only the listing is
    read. ``path`` is for opening the file, ``file_path`` as rows read from it tell it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", *_identity())


def read_files(spark: SparkSession, folder: str, paths: list[str], schema: T.StructType, fmt: str = FORMAT) -> DataFrame:
    """The rows of some files of a folder, with the columns of its partitions. No paths give no rows."""
    reader = spark.read.format(fmt).schema(schema).option("basePath", folder)
    return reader.load(paths) if paths else spark.createDataFrame([], schema)


def _positions(column: str, bits: Column) -> Column:
    """Where in a filter of ``bits`` bits a value is marked, from 1 on."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(seed), F.col(column)), bits) + 1 for seed in range(HASHES)])


def _stored(spark: SparkSession, folder: str, part: str) -> DataFrame | None:
    files, where = file_system(spark, f"{folder.rstrip('/')}/{INDEX}/{part}/_SUCCESS")
    return spark.read.parquet(f"{folder.rstrip('/')}/{INDEX}/{part}") if files.exists(where) else None


def index_files(
    spark: SparkSession, folder: str, cols: list[str], bloom: list[str] | None = None, fmt: str = FORMAT,
    schema: T.StructType | None = None,
) -> None:
    """Index the files of a folder by the extremes of ``cols`` and by Bloom filters over ``bloom``.

    Files that the present index knows by the same columns are not read again; those that are gone
    drop out. The new index takes the place of the old one by a rename.
    """
    bloom = bloom or []
    schema = schema or spark.read.format(fmt).load(folder).schema
    present = listing(spark, folder)
    stats, filters = _stored(spark, folder, "stats"), _stored(spark, folder, "filters")
    named = [f"min_{c}" for c in cols] + [f"bits_{c}" for c in bloom]
    if stats is not None and set(named) == {c for c in stats.columns if c.startswith(("min_", "bits_"))}:
        known = stats.join(present.drop("path"), ["file_path", "file_size", "file_time"], "left_semi")
    else:
        known = None
    fresh = present if known is None else present.join(known, ["file_path", "file_size", "file_time"], "left_anti")
    # As many paths as Spark itself lists on the driver to read the folder.
    paths = [row.path for row in fresh.select("path").collect()]

    target = fresh_path(spark, "file-index")
    rows = read_files(spark, folder, paths, schema, fmt)
    if paths:
        found = file_stats(rows, list(dict.fromkeys([*cols, *bloom])))
        wanted_bits = F.greatest(F.ceil(F.col("num_records") * BITS_PER_ROW / _BITMAP), F.lit(1)) * _BITMAP
        found = found.join(fresh.drop("path"), "file_path").withColumns({f"bits_{c}": wanted_bits for c in bloom})
        found = found.drop(*[f"{s}_{c}" for c in bloom if c not in cols for s in ("min", "max", "nulls")])
        found.write.parquet(f"{target}/stats")
        for c in bloom:
            # A file's number of bits is one row for each file.
            sizes = spark.read.parquet(f"{target}/stats").select("file_path", F.col(f"bits_{c}").alias("bits"))
            values = rows.select(_identity()[0], F.col(c).alias("value")).where("value is not null")
            marked = values.join(F.broadcast(sizes), "file_path")
            marked = marked.select("file_path", F.explode(_positions("value", F.col("bits"))).alias("position"))
            bitmaps = marked.groupBy("file_path", F.bitmap_bucket_number("position").alias("bucket")).agg(
                F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bitmap")
            )
            bitmaps.withColumn("column", F.lit(c)).write.mode("append").parquet(f"{target}/filters")
    if known is not None:
        known.write.mode("append").parquet(f"{target}/stats")
        if filters is not None:
            kept = filters.join(known.select("file_path"), "file_path", "left_semi")
            kept.write.mode("append").parquet(f"{target}/filters")
    elif not paths:
        file_system(spark, target)[0].mkdirs(file_system(spark, target)[1])
    with _replacing(spark, target, f"{folder.rstrip('/')}/{INDEX}"):
        pass


def _may_hold(stats: DataFrame, filters: DataFrame | None, wanted: Wanted, schema: T.StructType) -> DataFrame:
    """The known files that may hold a row with all that is wanted."""
    for column, what in wanted.items():
        low, high = (min(what), max(what)) if isinstance(what, list) and what else what or (None, None)
        if f"min_{column}" in stats.columns:
            # Without a value there are no extremes, so such a file drops out.
            stats = stats.where(F.col(f"min_{column}").isNotNull())
            if low is not None:
                stats = stats.where(F.col(f"max_{column}") >= F.lit(low))
            if high is not None:
                stats = stats.where(F.col(f"min_{column}") <= F.lit(high))
        if isinstance(what, list) and filters is not None and f"bits_{column}" in stats.columns:
            stats = stats.join(_marked(stats, filters, column, what, schema[column].dataType), "file_path", "left_semi")
    return stats


def _marked(stats: DataFrame, filters: DataFrame, column: str, values: list, kind: T.DataType) -> DataFrame:
    """Files whose filter has all bits of one of ``values``."""
    # Values of different types have different hashes.
    literals = [F.lit(v).cast(kind) for v in values] or [F.lit(None).cast(kind)]
    asked = stats.select("file_path", F.col(f"bits_{column}").alias("bits"), F.explode(F.array(*literals)).alias("value"))
    asked = asked.select("file_path", "value", F.explode(_positions("value", F.col("bits"))).alias("position"))
    asked = asked.select(
        "file_path", "value", F.bitmap_bucket_number("position").alias("bucket"),
        F.bitmap_bit_position("position").alias("bit"),
    )
    own = filters.where(F.col("column") == column).select("file_path", "bucket", "bitmap")
    byte = F.conv(F.hex(F.substring("bitmap", (F.col("bit") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    is_set = F.coalesce(F.call_function("getbit", byte, (F.col("bit") % 8).cast("int")) == 1, F.lit(False))
    tested = asked.join(own, ["file_path", "bucket"], "left").groupBy("file_path", "value").agg(F.min(is_set).alias("held"))
    return tested.where("held").select("file_path")


def files_with(spark: SparkSession, folder: str, wanted: Wanted, schema: T.StructType) -> list[str]:
    """Paths of the files of a folder that may hold rows as wanted, and of all that its index does not know."""
    present = listing(spark, folder)
    stats = _stored(spark, folder, "stats")
    if stats is None:
        return sorted(row.path for row in present.select("path").collect())
    identity = ["file_path", "file_size", "file_time"]
    known = stats.join(present, identity)
    hits = _may_hold(known, _stored(spark, folder, "filters"), wanted, schema).select("path")
    others = present.join(stats, identity, "left_anti").select("path")
    return sorted(row.path for row in hits.unionByName(others).collect())


def condition(wanted: Wanted) -> Column:
    """What is wanted of each row."""
    tests = []
    for column, what in wanted.items():
        if isinstance(what, list):
            tests.append(F.col(column).isin(what) if what else F.lit(False))
            continue
        low, high = what
        tests += [F.col(column) >= F.lit(low)] if low is not None else []
        tests += [F.col(column) <= F.lit(high)] if high is not None else []
        tests += [F.col(column).isNotNull()] if low is None and high is None else []
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def read_where(
    spark: SparkSession, folder: str, wanted: Wanted, fmt: str = FORMAT, schema: T.StructType | None = None
) -> DataFrame:
    """The rows of a folder's table that hold what is wanted, from the files that may hold some.

    ``wanted`` maps columns to a list of values or to the closed ends of a range, of which None is open.
    NULL is never wanted. Without an index all files are read.
    """
    schema = schema or spark.read.format(fmt).load(folder).schema
    paths = files_with(spark, folder, wanted, schema)
    return read_files(spark, folder, paths, schema, fmt).where(condition(wanted))
