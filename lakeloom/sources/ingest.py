"""Readers of raw files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.schemas import FLIGHT_RAW
from lakeloom.sources.staging import spent


def read_raw_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str = FLIGHT_RAW,
    header: bool = False,
    line: str | None = None,
    **options: str,
) -> DataFrame:
    """CSV with a stated schema. Short rows are filled with NULL, extra fields are dropped.

    Without ``header`` a header line is read as data, as a file without one would be. With ``line`` a
    column of that name holds the whole line where its fields are not as many as the schema's or of other
    types, and NULL elsewhere; see :func:`good_lines` and :func:`bad_lines`.
    """
    if line:
        schema = spark.createDataFrame([], schema).schema.add(line, T.StringType())
        # Whether a line fits is told by all its fields, whichever are asked for later.
        options |= {"columnNameOfCorruptRecord": line, "columnPruning": "false"}
    return spark.read.options(header=header, mode="PERMISSIVE", **options).csv(path, schema=schema)


def write_raw_csv(df: DataFrame, path: str, file_rows: int = 500_000, mode: str = "error") -> None:
    """Rows as CSV files without a header, each compressed; ``mode`` "append" adds files.

    Compressed files cannot be split, so none has more than ``file_rows`` rows, whatever a task holds.
    """
    with spent(df.sparkSession):
        df.write.options(compression="gzip", maxRecordsPerFile=file_rows).mode(mode).csv(path)


def _read(df: DataFrame, line: str) -> Column:
    """Always true. It has another column read besides the line, which Spark gives out on no other terms."""
    other = next(c for c in df.columns if c != line)
    return F.length(F.coalesce(F.col(f"`{other}`").cast("string"), F.lit(""))) >= 0


def good_lines(df: DataFrame, line: str) -> DataFrame:
    """The rows whose line is as the schema says."""
    return df.where(F.col(line).isNull() & _read(df, line)).drop(line)


def bad_lines(df: DataFrame, line: str, delimiter: str = ",") -> DataFrame:
    """``line, n_fields, reason, file_path`` of lines that are not as the schema says.

    ``reason`` is ``short`` or ``long`` by the number of fields, ``quote`` if a quotation mark is not
    closed, and ``type`` for a value of another type.
    """
    text, mark = F.col("line"), F.lit('"')
    outside = F.regexp_replace(text, '"[^"]*"', "")
    count = lambda c, sign: F.length(c) - F.length(F.replace(c, sign))
    fields, wanted = F.col("n_fields"), len(df.columns) - 1
    reason = (
        F.when(count(text, mark) % 2 == 1, "quote").when(fields < wanted, "short").when(fields > wanted, "long").otherwise("type")
    )
    bad = df.where(F.col(line).isNotNull() & _read(df, line))
    bad = bad.select(F.col(line).alias("line"), F.col("_metadata.file_path").alias("file_path"))
    return bad.withColumn("n_fields", (count(outside, F.lit(delimiter)) + 1).cast("int")).select(
        "line", "n_fields", reason.alias("reason"), "file_path"
    )


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON lines. Give a schema for large inputs: inferring one reads the whole input first."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_variant(spark: SparkSession, path: str | list[str], column: str = "value") -> DataFrame:
    """JSON lines as one VARIANT column: each value keeps its own type, and one scan reads all, as nothing
    is inferred beforehand. See :func:`variant_fields`."""
    return spark.read.option("singleVariantColumn", column).json(path)


def variant_fields(column: str | Column, fields: dict[str, str]) -> Column:
    """Fields of a VARIANT as a struct: path to type; what is absent or of no such type is NULL."""
    value = F.col(column) if isinstance(column, str) else column
    return F.struct(
        *[F.try_variant_get(value, path, kind).alias(path.removeprefix("$.").replace(".", "_")) for path, kind in fields.items()]
    )
