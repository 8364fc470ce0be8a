"""The stages of the corpus pipeline. All but the last return the columns of their input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import jaccard, language, neighbours, packing
from lakeloom.llm.workers import importable

#: Documents that score less are rejected by the quality stage.
LEAST_QUALITY = 0.3


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the language centroids accept.

    NULL and empty texts and texts without a letter go, as all do where no language can be learned, so
    an empty table stays empty. Rows are judged one by one: repeated rows, rows without a ``doc_id`` and
    columns of any name are kept or go as they are.
    """
    importable(spark)
    named = language.identify(docs, language.fit_languages(docs))
    return named.where("not rejected").select("record.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the labelled neighbours score at least :data:`LEAST_QUALITY`.

    A NULL or empty text scores the share of good labels. Without labels all score 0.5 and stay. Rows are
    judged one by one, as by :func:`identify_languages`; rows without a ``doc_id`` have no label.
    """
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = neighbours.score_quality(docs, neighbours.fit_quality(docs, labels))
    return scored.where(F.col("score") >= LEAST_QUALITY).select("record.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies.

    Documents of five-word shingles link from a similarity of 0.8 on. Rows without a ``doc_id`` or
    without words are in no group and stay; rows with one ``doc_id`` stay or go together.
    """
    importable(spark)
    similar = jaccard.Similar(words=5, percent=80)
    groups = jaccard.similar_documents(docs, similar)
    copies = groups.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 1024 tokens; a row for each piece, with its ids' crc32.

    A NULL or empty text is a piece of the end id alone; repeated rows and rows without a ``doc_id`` are
    packed each. Other columns do not matter, and an empty table gives no rows.
    """
    importable(spark)
    packed = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )
