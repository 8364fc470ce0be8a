"""NULLs, empty and long texts, repeated rows, clashing names and empty tables, for every operator."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from llm_rows import ODD, documents, odd, workers  # noqa: F401

from lakeloom.llm import bpe, jaccard, language, licenses, multi_index, neighbours, packing, repetition, shards, stages, token_index
from lakeloom.sources.staging import fresh_path

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
IDS = Counter(i for i, _ in ODD)


def tokens(docs):
    path = fresh_path(docs.sparkSession, "test-blocks")
    token_index.write_tokens(docs, path, WORD, 2)
    return token_index.read_tokens(docs.sparkSession, path)


def scored(docs):
    labels = docs.sparkSession.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, None), (3, None, 1)], "doc_id long, quality int, toxic int")
    return neighbours.score_quality(docs, neighbours.fit_quality(docs, labels)).select("record.doc_id", "score")


OPERATORS = {
    "bpe": lambda d: bpe.round_trip(d, RANKS, public_tokenizers.PATTERN),
    "tokens": tokens,
    "shards": lambda d: shards.shuffle_into_shards(d).select("record.doc_id", "shard", "slot"),
    "language": lambda d: language.identify(d, language.fit_languages(d)).select("record.doc_id", "lang_pred", "score"),
    "repetition": repetition.measure_repetition,
    "packing": lambda d: packing.pack_documents(d, BYTE).where("start = 0"),
    "licenses": licenses.scan,
    "quality": scored,
    "jaccard": jaccard.similar_documents,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_every_row_is_answered(odd, name):
    found = OPERATORS[name](odd).collect()
    assert Counter(r.doc_id for r in found) == IDS


@pytest.mark.parametrize("name", list(OPERATORS))
def test_an_empty_table_gives_no_rows(odd, name):
    assert OPERATORS[name](odd.limit(0)).collect() == []


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x"), (2, [2.0, 0.0], 1, "x"), (3, None, 1, "x"), (4, [], 1, "x"),
        (5, [0.0, 0.0], 1, "x"), (6, [nan, 1.0], 1, "x"), (7, [inf, 1.0], 1, "x"), (8, [None, 1.0], 1, "x"),
        (9, [1.0, 0.0], None, "x"), (10, [1.0, 0.0], 2, "x"), (11, [1e30, 1e20], 1, "x"), (12, [1.0, 0.0, 0.0], 1, "x"),
        (None, [1.0, 0.0], 1, "x"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cell string")
    found = {r.vec_id: (r.component_id, r.kept) for r in multi_index.near_duplicates(frame).collect()}
    assert multi_index.near_duplicates(frame).count() == len(rows)
    assert {v: c for v, (c, _) in found.items() if v in (1, 2, 11)} == {1: 1, 2: 1, 11: 1}
    assert all(found[v] == (v, True) for v in (3, 4, 5, 6, 7, 8, 9, 10, 12))
    assert found[None] == (None, True)
    assert multi_index.near_duplicates(frame.limit(0)).collect() == []


def test_stages_keep_the_columns(spark, odd, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for stage_ in (stages.identify_languages, stages.keep_quality, stages.drop_near_copies):
        assert stage_(spark, odd, str(tmp_path)).columns == odd.columns
        assert stage_(spark, odd.limit(0), str(tmp_path)).collect() == []
    assert stages.drop_near_copies(spark, odd, str(tmp_path)).count() == len(ODD)
