"""Loads that compare a batch with a table by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_list(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def has_key(keys: list[str]) -> Column:
    """True if no column of the key is NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def require_unique(df: DataFrame, key: str | list[str]) -> DataFrame:
    """``df``, failing when it runs if two rows share a key.

    The check is part of the plan: it runs no job of its own, and a join on the same key that
    follows uses its shuffle and sort. Each task passes on two rows of a key at most, which is
    enough to fail, so a key with very many copies is no burden.
    """
    keys = key_list(key)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit(f"duplicate key ({', '.join(keys)}): "), shown)
    unique = F.when(F.col("_nth") == 1, F.lit(True)).otherwise(
        F.raise_error(message).cast("boolean")
    )
    return df.withColumn("_nth", nth).where("_nth <= 2").where(unique).drop("_nth")


def first_per_key(df: DataFrame, key: str | list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key along ``order``, chosen in each task before the shuffle."""
    nth = F.row_number().over(Window.partitionBy(*key_list(key)).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def new_rows(target: DataFrame, source: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``source`` whose key is not in ``target``: what an insert-only load appends.

    New rows that share a key are all returned. A NULL key matches nothing, so it is new.

    One key may hold much of either side. In the target its copies collapse before the shuffle.
    In the source it is split by adaptive execution, which does so only in a join whose two
    inputs come straight from a shuffle; joining on a hash beside the key brings that about.
    """
    keys = key_list(key)
    known = target.select(*keys).distinct().withColumn("_hash", F.xxhash64(*keys))
    hashed = source.withColumn("_hash", F.xxhash64(*keys))
    return hashed.join(known, ["_hash", *keys], "left_anti").select(*source.columns)


def insert_new(target: DataFrame, source: DataFrame, key: str | list[str]) -> DataFrame:
    """``target`` with the unknown rows of ``source`` added; known keys stay as they are."""
    return target.unionByName(new_rows(target, source, key))


def upsert(target: DataFrame, source: DataFrame, key: str | list[str]) -> DataFrame:
    """``target`` with rows of ``source`` replacing those of the same key, and new ones added.

    Two rows of ``source`` with one key are an error when the result runs. The source is read
    more than once; stage it first if it is costly.
    """
    keys = key_list(key)
    known = has_key(keys)
    # NULL keys match nothing, so several of them are no conflict.
    batch = require_unique(source.where(known), keys).unionByName(source.where(~known))
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(batch)
