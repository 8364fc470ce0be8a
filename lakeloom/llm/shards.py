"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass one scatters the records uniformly over buckets of a bounded number of bytes and writes them;
pass two permutes each bucket with Spark's ``shuffle`` function, which is a Fisher-Yates shuffle,
and deals the permuted records out to the shards in turn.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.sources.staging import stage

#: Bytes that a record counts for besides its text.
RECORD_BYTES = 16

#: Bytes of records that a task of pass two reads.
TASK_BYTES = 64 << 20

# Buckets are numbered in blocks, so that no window holds more than a block or the list of blocks.
_BLOCK = 4096


def record_size(text: str = "text"):
    """UTF-8 bytes of the text plus :data:`RECORD_BYTES`; a NULL text has none of its own."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(RECORD_BYTES)).cast("long")


def bucket_offsets(counts: DataFrame) -> DataFrame:
    """``bucket, offset`` from ``bucket, n``: rows in all earlier buckets, by blocks of buckets."""
    blocked = counts.withColumn("block", F.floor(F.col("bucket") / _BLOCK))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        blocked.groupBy("block")
        .agg(F.sum("n").alias("rows"))
        .select("block", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(bases, "block")
        .select("bucket", (F.col("base") + F.col("within")).alias("offset"))
    )


def shuffle_into_shards(
    docs: DataFrame, shards: int = 40, seed: int = 20, bucket_bytes: int = 4 << 20
) -> DataFrame:
    """Every row of ``docs`` at a random place: ``record, size, shard, slot``.

    ``record`` is a struct of all columns of ``docs``, so that no name can clash (map columns are
    not supported, since they have no order). Shards are 0 to ``shards - 1`` and their row counts
    differ by one at most; slots count from 0 without gaps in each shard.

    A bucket holds about ``bucket_bytes`` of records (one record may be longer), so pass two needs
    memory for a bucket and not for a shard. The scatter hash takes in the row's place in the input
    as well as ``doc_id``, so neither a NULL or repeated ``doc_id`` nor repeated whole rows meet in
    one bucket. The permutation is fixed by the seed, the rows and the input's splits; pass one is
    written once, so a task that is run again deals the same rows. An empty input gives no rows.
    """
    spark = docs.sparkSession
    sized = docs.select(
        F.struct(*docs.columns).alias("record"),
        F.col("doc_id").alias("doc_id"),
        record_size().alias("size"),
    )
    total = sized.agg(F.sum("size").alias("bytes")).first()["bytes"] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, math.ceil(total / bucket_bytes))
    tasks = max(least, math.ceil(total / TASK_BYTES))

    place = F.monotonically_increasing_id()
    scattered = sized.withColumn("place", place).select(
        F.pmod(F.xxhash64(F.lit(seed), "doc_id", "place"), F.lit(buckets)).alias("bucket"),
        "place",
        "size",
        "record",
    )
    stored = stage(scattered, "scatter")
    offsets = bucket_offsets(stored.groupBy("bucket").agg(F.count("*").alias("n")))

    entries = F.sort_array(F.collect_list(F.struct("place", "size", "record")))
    permuted = (
        stored.repartition(tasks, "bucket")
        .groupBy("bucket")
        .agg(entries.alias("entries"))
        .join(offsets, "bucket")
        .sortWithinPartitions("bucket")
        .select("offset", F.shuffle("entries", F.lit(seed)).alias("entries"))
    )
    dealt = permuted.select("offset", F.posexplode("entries").alias("nth", "entry"))
    position = F.col("offset") + F.col("nth")
    return dealt.select(
        F.col("entry.record").alias("record"),
        F.col("entry.size").alias("size"),
        F.pmod(position, F.lit(shards)).cast("int").alias("shard"),
        F.floor(position / F.lit(shards)).cast("long").alias("slot"),
    )
