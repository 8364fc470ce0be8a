"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import stages
from lakeloom.sources.staging import stage

STAGES = [
    ("language", stages.identify_languages),
    ("quality", stages.keep_quality),
    ("near-copies", stages.drop_near_copies),
    ("packing", stages.pack),
]

#: SQL cannot express the trained stages and the packing. The tests compare near copies and pieces with
#: brute force, and what the trained stages keep with the labels of their documents.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for nth, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if nth < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
