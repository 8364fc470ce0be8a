"""Bronze to silver: deduplicate and type the raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.casts import (
    TIME_FORMAT,
    arrival_timestamp,
    clock_time,
    seconds_of_day,
    typed,
)
from lakeloom.functions.keys import random_id, row_id
from lakeloom.schemas import FLIGHT_RAW_COLUMNS, FLIGHT_SILVER_TYPES
from lakeloom.sources import layout
from lakeloom.sources.staging import stage


# Between the columns of a packed row, and for a NULL in it.
_SPLIT, _NULL = "\x01", "\x02"


def dedupe(df: DataFrame) -> DataFrame:
    """Keep one of each set of identical rows; NULL equals NULL.

    Copies collapse in each task before the shuffle, so any number of them stays cheap. Rows of text
    alone are compared and shuffled as one text each, a third of the memory of their columns. Rows that
    hold one of the two marks themselves, or bytes that are no UTF-8, take their columns along.
    """
    if not df.columns or any(dtype != "string" for _, dtype in df.dtypes):
        return df.dropDuplicates()
    columns = [F.col(f"`{c}`") for c in df.columns]
    packed = F.concat_ws(_SPLIT, *[F.coalesce(c, F.lit(_NULL)) for c in columns])
    held = F.concat_ws("", *columns)
    plain = ~held.contains(_SPLIT) & ~held.contains(_NULL) & F.is_valid_utf8(packed)
    rows = df.select(packed.alias("packed"), F.when(~plain, F.array(*columns)).alias("whole")).dropDuplicates()
    unpacked = F.transform(F.split("packed", _SPLIT), lambda cell: F.nullif(cell, F.lit(_NULL)))
    cells = rows.select(F.coalesce("whole", unpacked).alias("cells"))
    return cells.select(*[F.col("cells")[i].alias(c) for i, c in enumerate(df.columns)])


def dedupe_stored(df: DataFrame, limit_mb: int = 16) -> DataFrame:
    """:func:`dedupe` of a stored table, which shuffles only what may have copies.

    A first scan shuffles 64-bit hashes of the rows, and those seen more than once are staged. Rows of
    other hashes have no copy and stay where they lie; the rest, copies and rows of the same hash by
    chance, is deduped by its values and rebalanced. If the hashes staged exceed ``limit_mb``, all of
    ``df`` goes that way.
    """
    mark = "_row_hash"
    hashed = df.withColumn(mark, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    again = stage(hashed.groupBy(mark).count().where("count > 1").select(mark), "repeated")
    if layout.estimated_bytes(again) > limit_mb << 20:
        return layout.balanced(dedupe(df))
    again = F.broadcast(again)
    copies = dedupe(hashed.join(again, mark, "left_semi").drop(mark))
    return hashed.join(again, mark, "left_anti").drop(mark).unionByName(layout.balanced(copies))


def _silver_column(name: str) -> Column:
    if name == "departure_time":
        return F.date_format(clock_time(name), TIME_FORMAT)
    if name == "arrival_time":
        return arrival_timestamp(name, "travel_date")
    dtype = FLIGHT_SILVER_TYPES.get(name)
    return typed(name, dtype) if dtype else F.col(name)


def conform(raw: DataFrame, random_ids: bool = False) -> DataFrame:
    """Type the 25 raw columns and add ``departure_seconds`` and ``uuid``, in one projection.

    ``uuid`` identifies the row's content, so it is the same on every run and unique after
    :func:`dedupe`; ``random_ids`` gives random ones instead.
    """
    columns = [_silver_column(name).alias(name) for name in FLIGHT_RAW_COLUMNS]
    seconds = seconds_of_day(clock_time("departure_time")).alias("departure_seconds")
    identity = random_id() if random_ids else row_id(*FLIGHT_RAW_COLUMNS)
    return raw.select(*columns, seconds, identity.alias("uuid"))
