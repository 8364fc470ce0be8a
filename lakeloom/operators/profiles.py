"""Key profiles that grow by batches: counts and distinct sketches, merged at read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch as a power of 2, and the relative standard error that they give.
SKETCH_BITS = 14
ERROR = 1.04 / (1 << SKETCH_BITS) ** 0.5


def sketch_keys(batch: DataFrame, keys: list[str], batch_id: str) -> DataFrame:
    """``batch_id, column, num_records, cnt, sketch`` of each key column of a batch, in one pass.

    ``sketch`` tells distinct values up to :data:`ERROR` and is of a bounded size; it is to be stored, as by
    :func:`lakeloom.sources.tables.write_append`, and merged by :func:`merged_profile`. Values of any type are told
    apart by their text.
    """
    found = [
        F.struct(
            F.lit(k).alias("column"),
            F.count("*").alias("num_records"),
            F.count(F.col(f"`{k}`")).alias("cnt"),
            F.hll_sketch_agg(F.col(f"`{k}`").cast("string"), F.lit(SKETCH_BITS)).alias("sketch"),
        )
        for k in keys
    ]
    return batch.agg(F.array(*found).alias("found")).select(F.lit(batch_id).alias("batch_id"), F.inline("found"))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """``column, num_records, cnt, cnt_dist`` of all batches, from their sketches alone.

    ``cnt_dist`` is an estimate; count exactly with :func:`lakeloom.operators.quality.key_profile` where it
    is near ``cnt``. A batch counts as often as it is there, so store each once.
    """
    return sketches.groupBy("column").agg(
        F.sum("num_records").alias("num_records"),
        F.sum("cnt").alias("cnt"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("cnt_dist"),
    )
