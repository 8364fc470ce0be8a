"""Structs and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_json(c: Column | str, schema: T.StructType | str) -> Column:
    """JSON text to a struct of ``schema``; malformed text gives NULL fields."""
    return F.from_json(c, schema)


def most_frequent(count: Column | str, value: Column | str) -> Column:
    """Aggregate: the value with the greatest count, ties going to the greatest value."""
    count_col = F.col(count) if isinstance(count, str) else count
    value_col = F.col(value) if isinstance(value, str) else value
    return F.max(F.struct(count_col.alias("cnt"), value_col.alias("value")))["value"]


def exact_mean(c: Column | str, scale: int) -> Column:
    """Aggregate: mean as double over values kept to ``scale`` digits.

    Unlike ``avg`` over floating point, the sum does not depend on the order of the rows, so two
    runs over the same rows agree to the last bit. A group that holds a value too large for it, or
    one that is no number, gets ``avg`` instead, so no value is left out.
    """
    value = F.col(c) if isinstance(c, str) else c
    exact = value.try_cast(f"decimal(28,{scale})")
    mean = F.try_sum(exact).cast("double") / F.count(exact)
    return F.when(F.count(value) == F.count(exact), F.coalesce(mean, F.avg(value))).otherwise(F.avg(value))
