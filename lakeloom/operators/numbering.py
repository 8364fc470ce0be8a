"""Positions along an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.sources.staging import stage

# monotonically_increasing_id() holds the partition above this bit and the row position below.
_POSITION_BITS = 33

# Up to this n of the whole table the first n rows are found by a top-n of each task.
_TOP_ROWS = 1000

# Rows of a sample that shows where a greater n lies.
_SAMPLED_ROWS = 20_000

# Spark's setting: up to this n a window drops the rows past the n-th in each task.
_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"

# Types without an order.
_UNORDERED = ("map<", "variant", "interval")


def _cols(names: tuple[Column | str, ...] | list[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def dense_id(df: DataFrame, *order: Column | str, id_col: str = "id") -> DataFrame:
    """Number the rows 1..n along ``order``, which must identify a row.

    Equal to ``row_number() over (order by ...)`` without moving all rows to one task: rows are
    range-partitioned and sorted, each keeps its partition and position, and the partitions' row
    counts give the offsets. The positioned rows are written once, because the ranges are
    sampled and would differ if the counts and the rows were computed separately.
    """
    keys = _cols(order)
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    stored = stage(placed, "dense-id").select(
        *df.columns,
        F.shiftright("_place", _POSITION_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    # One row per partition, so the broadcast is bounded by the number of shuffle partitions.
    return stored.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_position") + 1).alias(id_col)
    )


def _carried(column: Column, kind: T.DataType) -> Column:
    """``column`` as it comes to the driver: moments as whole numbers or text, whatever zones are set."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return column.cast("string")
    if isinstance(kind, T.StructType):
        fields = F.struct(*[_carried(column[f.name], f.dataType).alias(f.name) for f in kind])
        return F.when(column.isNotNull(), fields)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda v: _carried(v, kind.elementType))
    return column


def _literal(value, kind: T.DataType) -> Column:
    """A value that :func:`_carried` brought, as a column of its type."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(int(value)).cast("long"))
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind])
    if isinstance(kind, T.ArrayType):
        return F.array(*[_literal(v, kind.elementType) for v in value]).cast(kind)
    return F.lit(value).cast(kind)


def _around(df: DataFrame, keys: list[Column], n: int) -> tuple[DataFrame, int, int]:
    """Rows among which the ``n``-th along ascending ``keys`` is, its place among them, and their number.

    Each round takes a sample, finds two rows of it that most likely lie to either side of place ``n``,
    and counts in one scan of the keys what comes before the first and what lies between. Only what
    lies between goes on, until few rows are left or no fewer, as where most keys are equal. A round
    that missed is repeated with rows further apart.
    """
    names = [f"_{nth}" for nth in range(len(keys))]
    kinds = [f.dataType for f in df.select(*[k.alias(c) for k, c in zip(keys, names)]).schema]
    row = F.struct(*[k.alias(c) for k, c in zip(keys, names)])
    total, spread = df.count(), 4.0
    while n <= total and total > _TOP_ROWS:
        share = min(1.0, _SAMPLED_ROWS / total)
        drawn = df.sample(share, seed=n % 1000).select(*[_carried(k, t).alias(c) for k, t, c in zip(keys, kinds, names)])
        drawn = stage(drawn, "nth-row-sample")
        count = drawn.count()
        at = n / total
        margin = spread * (count * at * (1 - at) + 1) ** 0.5
        places = [int(at * count - margin), int(at * count + margin) + 1]
        place = F.row_number().over(Window.orderBy(*[_literal_order(c, t) for c, t in zip(names, kinds)]))
        ends = {r["_place"]: r for r in drawn.withColumn("_place", place).where(F.col("_place").isin(places)).collect()}
        low, high = (
            F.struct(*[_literal(ends[p][c], t).alias(c) for c, t in zip(names, kinds)]) if p in ends else None for p in places
        )
        before = F.lit(False) if low is None else row < low
        between = ~before if high is None else ~before & (row <= high)
        found = df.agg(F.count_if(before).alias("before"), F.count_if(between).alias("between")).first()
        if not found["before"] < n <= found["before"] + found["between"]:
            spread *= 2
            continue
        if found["between"] == total:
            break
        df, n, total, spread = df.where(between), n - found["before"], found["between"], 4.0
    return df, n, total


def _literal_order(name: str, kind: T.DataType) -> Column:
    return F.col(name).cast("timestamp_ntz") if isinstance(kind, T.TimestampNTZType) else F.col(name)


def _ascending(keys: list[Column]) -> bool:
    """True if no key states a direction."""
    return not any("SortOrder" in k._jc.node().getClass().getName() for k in keys)


def nth_row(
    df: DataFrame,
    order: Column | str | list[Column | str],
    n: int,
    partition: list[str] | None = None,
    rank_col: str = "rn",
) -> DataFrame:
    """Row ``n`` (from 1) along ``order``, of the table or of each group of ``partition``.

    A struct may be ordered by; it compares field by field, NULL first. For any ``n`` the remaining
    columns that have an order settle ties, so the result does not depend on how the rows lie.

    Neither a large table nor a large group meets in one task. Of the table, a small ``n`` is found by a
    top-n of each task. For a greater one along ascending keys the rows around it are narrowed down by
    scans of the keys (:func:`_around`), which read ``df`` several times: stage it if it is costly. What
    is left, other directions and groups go by the numbers of :func:`dense_id`. Where the line lies only
    changes the plan; for groups it is the session's own limit.
    """
    keys = _cols(order if isinstance(order, list) else [order])
    groups = partition or []
    rest = [c for c, kind in df.dtypes if c not in groups and not any(u in kind for u in _UNORDERED)]
    along = [*keys, *map(F.col, rest)]
    if not groups:
        part, place = df, n
        if n > _TOP_ROWS and _ascending(keys):
            part, place, total = _around(df, keys, n)
            if place > total:
                return df.where(F.lit(False)).withColumn(rank_col, F.lit(n))
        if place <= _TOP_ROWS:
            first = part.orderBy(*along).limit(place)
            numbered = first.withColumn(rank_col, F.row_number().over(Window.orderBy(*along)))
            return numbered.where(F.col(rank_col) == place).withColumn(rank_col, F.lit(n))
        numbered = dense_id(part, *along, id_col="_id").where(F.col("_id") == place)
        return numbered.drop("_id").withColumn(rank_col, F.lit(n))
    if n <= int(df.sparkSession.conf.get(_GROUP_LIMIT, "1000")):
        window = Window.partitionBy(*groups).orderBy(*along)
        return df.withColumn(rank_col, F.row_number().over(window)).where(F.col(rank_col) == n)

    numbered = dense_id(df, *groups, *along, id_col="_id")
    wanted = numbered.groupBy(*groups).agg((F.min("_id") + (n - 1)).alias("_id"))
    wanted = wanted.select("_id", *[F.col(g).alias(f"_group_{g}") for g in groups])
    found = numbered.join(wanted, "_id")
    for g in groups:
        found = found.where(F.col(g).eqNullSafe(F.col(f"_group_{g}")))
    return found.select(*df.columns, F.lit(n).alias(rank_col))
