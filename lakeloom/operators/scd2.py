"""Versioned dimensions: every change of a tracked column closes a version and opens the next."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.incremental import first_per_key, has_key, key_list, require_unique


def version_columns(prefix: str = "") -> list[str]:
    """Names of the columns a snapshot adds; ``valid_to`` is NULL in the open version."""
    return [f"{prefix}{c}" for c in ("scd_id", "updated_at", "valid_from", "valid_to")]


def quarantine(source: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``source`` that :func:`apply_snapshot` leaves out because a key is NULL."""
    return source.where(~has_key(key_list(key)))


def moment_of(as_of: datetime | str) -> Column:
    """``as_of`` as a timestamp: a datetime with a zone by its instant, one without and text in the
    session's zone, all to the microsecond."""
    if isinstance(as_of, datetime) and as_of.tzinfo is not None:
        since = as_of - datetime(1970, 1, 1, tzinfo=timezone.utc)
        return F.timestamp_micros(F.lit(since // timedelta(microseconds=1)).cast("long"))
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of
    return F.lit(text).cast("timestamp")


def _opened(source: DataFrame, keys: list[str], moment: Column, prefix: str) -> list[Column]:
    scd_id, updated_at, valid_from, valid_to = version_columns(prefix)
    return [
        *[F.col(c) for c in source.columns],
        F.md5(
            F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.unix_micros(moment).cast("string"))
        ).alias(scd_id),
        moment.alias(updated_at),
        moment.alias(valid_from),
        F.lit(None).cast("timestamp").alias(valid_to),
    ]


def advance(
    current_open: DataFrame | None,
    source: DataFrame,
    key: str | list[str],
    check_cols: list[str],
    as_of: datetime | str,
    hard_deletes: bool = True,
    on_duplicate: Literal["raise", "first"] = "raise",
    order: list[Column | str] | None = None,
    prefix: str = "",
    buckets: int | None = None,
) -> DataFrame:
    """The open versions after taking in ``source``, and the versions that this closes.

    Takes the open versions alone, so the cost does not grow with the history. See
    :func:`apply_snapshot` for the rules. An open version that does not begin before ``as_of`` is an
    error when the result runs.

    Where ``current_open`` is a table stored in so many ``buckets`` by ``key``, as by :func:`store_open`,
    it is joined as it lies and only the source is moved.
    """
    keys = key_list(key)
    if on_duplicate == "first" and not order:
        raise ValueError("on_duplicate='first' needs an order")
    moment = moment_of(as_of)

    known = source.where(has_key(keys))
    if buckets and current_open is not None:
        known = known.repartition(buckets, *keys)
    if on_duplicate == "first":
        batch = first_per_key(known, keys, order)
    else:
        batch = require_unique(known, keys)
    fresh = batch.select(*_opened(batch, keys, moment, prefix))
    if current_open is None:
        return fresh

    columns = current_open.columns
    differing = set(columns) ^ set(fresh.columns)
    if differing:
        raise ValueError(f"snapshot and source differ in columns: {sorted(differing)}")
    types = dict(current_open.dtypes)
    fresh = fresh.select(*[F.col(c).cast(types[c]).alias(c) for c in columns])

    old = current_open.select(*keys, F.struct(*columns).alias("_old"))
    new = fresh.select(*keys, F.struct(*columns).alias("_new"))
    pairs = old.join(new, keys, "full_outer")

    is_old, is_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    same = reduce(
        lambda a, c: a & F.col("_old")[c].eqNullSafe(F.col("_new")[c]), check_cols, F.lit(True)
    )
    closes = is_old & ((is_new & ~same) | (~is_new & F.lit(hard_deletes)))
    valid_from, valid_to = version_columns(prefix)[2:]
    early = F.raise_error(F.lit("the snapshot must be later than every open version")).cast("timestamp")
    closed_at = F.when(F.col("_old")[valid_from] >= moment, early).when(closes, moment)
    kept = F.when(is_old, F.col("_old").withField(valid_to, closed_at))
    added = F.when(is_new & (~is_old | ~same), F.col("_new"))
    return pairs.select(F.inline(F.array_compact(F.array(kept, added)))).select(*columns)


def store_open(versions: DataFrame, table: str, path: str, key: str | list[str], buckets: int) -> None:
    """Write open versions as the external table ``table``, in files of ``buckets`` by ``key``."""
    keys = key_list(key)
    dealt = versions.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(table)


def apply_snapshot(
    current: DataFrame | None,
    source: DataFrame,
    key: str | list[str],
    check_cols: list[str],
    as_of: datetime | str,
    hard_deletes: bool = True,
    on_duplicate: Literal["raise", "first"] = "raise",
    order: list[Column | str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """The versioned table after taking in ``source`` as the state at ``as_of``.

    A key without open version gets one. A key whose ``check_cols`` differ (NULL equals NULL) has
    its open version closed and a new one opened. A key missing from the source has its open
    version closed if ``hard_deletes``. Closed versions are carried over and take no part in the
    join.

    ``as_of`` is a datetime or text, see :func:`moment_of`, and later than every open version. Two source rows with one key are an
    error when the result runs, or the first along ``order`` counts. Rows with a NULL key are left
    to :func:`quarantine`. The result must not overwrite the table ``current`` is read from.
    """
    rules = (key, check_cols, as_of, hard_deletes, on_duplicate, order, prefix)
    if current is None:
        return advance(None, source, *rules)
    valid_to = F.col(version_columns(prefix)[-1])
    history = current.where(valid_to.isNotNull())
    return history.unionByName(advance(current.where(valid_to.isNull()), source, *rules))
