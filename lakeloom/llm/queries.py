"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm import (
    bpe,
    counting,
    importance,
    jaccard,
    language,
    licenses,
    multi_index,
    neighbours,
    packing,
    prefix_trie,
    repetition,
    shards,
    token_index,
)
from lakeloom.llm.workers import importable
from lakeloom.sources.staging import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op3_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-blocks")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    token_index.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer, end_id=2)
    return token_index.read_tokens(spark, path).select(
        "doc_id",
        "start",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op4_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shards.shuffle_into_shards(table(spark, sf_dir, "documents"), shards=40)
    return dealt.select(
        "record.doc_id",
        "size",
        F.crc32(F.coalesce("record.text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    named = language.identify(documents.select("doc_id", "text"), language.fit_languages(documents))
    return named.select("record.doc_id", language.held_out("record.doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def op6_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.measure_repetition(table(spark, sf_dir, "documents"))


def packed_digests(packed: DataFrame) -> DataFrame:
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packed_digests(packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    fitted = neighbours.fit_quality(documents, table(spark, sf_dir, "labels"))
    scored = neighbours.score_quality(documents.select("doc_id", "text"), fitted)
    return scored.select(
        "record.doc_id",
        language.held_out("record.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    rebuilt = prefix_trie.grafted(turns, conv - conv % 5, F.crc32(conv.cast("string")) % 9, most_head=8)
    return prefix_trie.prefix_trie(rebuilt).drop("node", "parent")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = counting.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = importance.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_multi_index": op1_multi_index,
    "op2_bpe_transducer": op2_bpe_transducer,
    "op3_token_index": op3_token_index,
    "op4_external_shuffle": op4_external_shuffle,
    "op5_language_centroids": op5_language_centroids,
    "op6_suffix_repetition": op6_suffix_repetition,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_license_scan": op8_license_scan,
    "op9_neighbour_quality": op9_neighbour_quality,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_counts": op12_token_counts,
    "op13_importance_resampling": op13_importance_resampling,
}
