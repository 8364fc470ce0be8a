"""License scan by diagonal voting, in DataFrame operations only.

Every rolling pair of words of a document is joined by hash to the places it has in the templates.
A hit at word ``p`` of the document and word ``t`` of a template votes for the diagonal ``p - t``.
A diagonal on which every pair of a template voted is a verbatim occurrence. Neighbouring diagonals are
merged to find occurrences with words inserted or left out: those within a bounded distance of one
another, so that an occurrence is never much longer than its template, and its hits must follow one
another in the document as they do in the template.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.sources.staging import stage

# Phrases whose every place counts, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Sentences of public licenses, found also where a few words differ.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without "
    "fee is hereby granted provided that the above copyright notice": "isc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this program is free software you can redistribute it and or modify it under the terms of the "
    "gnu general public license as published by the free software foundation": "gpl",
    "unless required by applicable law or agreed to in writing software distributed under the "
    "license is distributed on an as is basis": "apache",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

#: What stands between words once A-Z is lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Voting:
    """``drift``: words that an occurrence may have more or less than its template, between its first and
    its last hit; ``cover``: the share of a sentence's pairs that must be found in their order."""

    drift: int = 8
    cover: float = 0.7


def words_of(text: str = "text") -> Column:
    """Words of the lower-cased text; no words for a NULL text."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def template_pairs(spark: SparkSession) -> DataFrame:
    """``template, label, verbatim, pairs, at, first, second``: a row for each pair of each template.

    Its size is fixed by the templates, a few hundred rows, whatever the documents are.
    """
    rows = []
    for n, (phrase, label) in enumerate([*PHRASES.items(), *SENTENCES.items()]):
        words = phrase.split()
        rows += [
            (n, label, phrase in PHRASES, len(words) - 1, at, *pair)
            for at, pair in enumerate(zip(words, words[1:]))
        ]
    schema = "template int, label string, verbatim boolean, pairs int, at int, first string, second string"
    return spark.createDataFrame(rows, schema)


def votes(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, template, ..., at, diagonal``: one row for each hit, repeats once."""
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of().alias("words"))
    pairs = words.select(
        "doc_id",
        "text_hash",
        F.posexplode(
            F.arrays_zip(
                F.col("words").alias("first"),
                F.expr("slice(words, 2, greatest(size(words) - 1, 0))").alias("second"),
            )
        ).alias("place", "pair"),
    ).select(
        "doc_id", "text_hash", "place", F.xxhash64("pair.first", "pair.second").alias("gram"),
        F.col("pair.first").alias("first"), F.col("pair.second").alias("second"),
    )
    templates = template_pairs(docs.sparkSession).withColumn("gram", F.xxhash64("first", "second"))
    hits = pairs.join(F.broadcast(templates), ["gram", "first", "second"])
    return hits.select(
        "doc_id", "text_hash", "template", "label", "verbatim", "pairs", "at",
        (F.col("place") - F.col("at")).cast("long").alias("diagonal"),
    ).distinct()


def spans(docs: DataFrame, voting: Voting = Voting()) -> DataFrame:
    """``doc_id, text_hash, label, verbatim, start, stop, cover``: verified occurrences.

    ``start`` and ``stop`` are words of the document, from 0, ``stop`` excluded. A verbatim phrase must fill
    its diagonal. For a sentence every diagonal is merged with those up to ``drift`` further on. Enough
    hits make it a candidate. It is verified by going through the template's pairs in order and taking
    for each the first hit behind the one before; these must be the share ``cover`` of its pairs. Of
    candidates that lie within ``drift`` of each other the best one counts, then the first.
    """
    of_document = ["doc_id", "text_hash", "template", "label", "verbatim", "pairs"]
    diagonals = stage(votes(docs).groupBy(*of_document, "diagonal").agg(F.collect_set("at").alias("ats")), "license-diagonals")
    phrases = diagonals.where(F.col("verbatim") & (F.size("ats") == F.col("pairs"))).select(
        "doc_id", "text_hash", "label", "verbatim",
        F.col("diagonal").alias("start"),
        (F.col("diagonal") + F.col("pairs") + 1).alias("stop"),
        F.lit(1.0).alias("cover"),
    )
    along = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    ahead, behind = along.rangeBetween(0, voting.drift), along.rangeBetween(-voting.drift, 0)
    around = along.rangeBetween(-voting.drift, voting.drift)
    enough = F.ceil(F.col("pairs") * voting.cover)
    # Most documents have a few hits of common words; only diagonals near enough of them go on.
    hopeful = (
        diagonals.where(~F.col("verbatim"))
        .withColumn("opens", F.sum(F.size("ats")).over(ahead) >= enough)
        .withColumn("near", F.max("opens").over(behind))
        .where("near")
    )
    hits = F.transform("ats", lambda at: F.struct(at.alias("at"), (at + F.col("diagonal")).alias("place")))
    held = hopeful.withColumn("hits", F.flatten(F.collect_list(hits).over(ahead))).where("opens")
    none = F.struct(*[F.lit(-1).cast("long").alias(c) for c in ("at", "place", "first")], F.lit(0).alias("count"))

    def follow(done: Column, hit: Column) -> Column:
        """The hits taken so far with the next one, if it is of a later pair and lies behind them."""
        fits = (hit["at"] > done["at"]) & (hit["place"] > done["place"])
        first = F.when(done["count"] == 0, hit["place"]).otherwise(done["first"])
        taken = F.struct(hit["at"].cast("long").alias("at"), hit["place"].alias("place"), first.alias("first"), (done["count"] + 1).alias("count"))
        return F.when(fits, taken).otherwise(done)

    chained = held.withColumn("chain", F.aggregate(F.array_sort("hits"), none, follow)).where(F.col("chain.count") >= enough)
    best = chained.withColumn("best", F.max(F.struct(F.col("chain.count"), -F.col("diagonal"))).over(around))
    sentences = best.where(F.col("best.col2") == -F.col("diagonal")).select(
        "doc_id", "text_hash", "label", "verbatim",
        F.col("chain.first").alias("start"), (F.col("chain.place") + 2).alias("stop"),
        (F.col("chain.count") / F.col("pairs")).alias("cover"),
    )
    return phrases.unionByName(sentences)


def scan(docs: DataFrame, voting: Voting = Voting()) -> DataFrame:
    """Labels of every document: ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score``.

    ``n_base`` counts the places of the phrases; ``first_word`` and ``last_word`` are their smallest
    and largest start, NULL without any. Labels are distinct, sorted and joined by commas, empty if
    there are none. ``score`` is the largest share of a template that was found, 0 if no occurrence
    was verified. Rows are told apart by ``doc_id`` (NULL included) and text, and equal rows get
    equal results, each its own row. A NULL or empty text has no words. Other columns are ignored.
    """
    counted = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.size(words_of()).cast("long").alias("n_words")
    )
    base = F.when(F.col("verbatim"), F.col("label"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = (
        spans(docs, voting)
        .groupBy(F.col("doc_id").alias("found_id"), F.col("text_hash").alias("found_hash"))
        .agg(
            F.count(base).alias("n_base"),
            F.min(F.when(F.col("verbatim"), F.col("start"))).alias("first_word"),
            F.max(F.when(F.col("verbatim"), F.col("start"))).alias("last_word"),
            joined(base).alias("base_labels"),
            joined(F.col("label")).alias("labels"),
            F.max("cover").alias("score"),
        )
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
    return counted.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
