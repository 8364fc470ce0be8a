"""Importance resampling: documents drawn by how much more their n-grams belong to a target than to
the whole of the documents.

An n-gram counts in one of a fixed number of buckets, the CRC-32 of its UTF-8 bytes modulo that
number. A task reads its documents once as one stream of words with one space before each, and
keeps the running CRC at the end of every word; the CRC of any n-gram follows from two of them
(:mod:`lakeloom.llm.crcs`). Two passes are made, one that counts buckets and one that weighs, so no
n-gram is written or moved: each task sends one count for a bucket, and the table of gains, one
number for a bucket, is the only thing that all tasks get.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.crcs import between, pushed
from lakeloom.llm.pieces import answers
from lakeloom.operators.numbering import dense_id
from lakeloom.sources.staging import stage

# Letters and digits of ASCII, lower-cased, and all other characters make words; the rest parts them.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: Bytes of a text that are cut into words at a time, and words whose n-grams are made at a time.
SLICE_BYTES, FLUSH_WORDS = 1 << 22, 1 << 19


@dataclass(frozen=True)
class Resampling:
    """``least`` to ``most`` words make a feature; ``share`` percent are drawn, rounded down, of the
    documents with ``least_words`` words or more; ``seed`` names the draw."""

    least: int = 1
    most: int = 1
    buckets: int = 10_000
    share: int = 10
    least_words: int = 20
    seed: str = "2024"


def _slices(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    data = (text or "").encode().translate(_WORDS)
    start = 0
    while start < len(data):
        stop = len(data) if len(data) - start <= SLICE_BYTES else data.find(b" ", start + SLICE_BYTES)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


class Stream:
    """Features of texts that are read one after the other.

    ``take`` is called with the texts' numbers and the CRCs of their features, both as arrays, as often
    as enough words have come together.
    """

    def __init__(self, least: int, most: int, take):
        self.least, self.most, self.take = least, most, take
        # Of the words kept from the last time: text, length, and the CRC at the end of the one before.
        self.texts, self.sizes, self.crcs = np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(1, np.uint32)
        self.words: list[bytes] = []
        self.runs: list[tuple[int, int]] = []

    def read(self, nth: int, text: str | None) -> int:
        """Take in text number ``nth``; its number of words."""
        total = 0
        for words in _slices(text):
            self.words += words
            self.runs.append((nth, len(words)))
            total += len(words)
            if len(self.words) >= FLUSH_WORDS:
                self.flush()
        return total

    def flush(self) -> None:
        old = len(self.texts)
        running = accumulate(map(b" ".__add__, self.words), lambda crc, word: crc32(word, crc), initial=int(self.crcs[-1]))
        crcs = np.fromiter(running, np.uint32, len(self.words) + 1)
        self.crcs = np.concatenate([self.crcs[:-1], crcs])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, self.words), np.int64, len(self.words))])
        texts, counts = np.array(self.runs, np.int64).reshape(-1, 2).T
        self.texts = np.concatenate([self.texts, np.repeat(texts, counts)])
        self.words, self.runs = [], []

        begins = pushed(self.crcs[:-1], 0x20)
        stops = np.cumsum(self.sizes + 1)
        starts = stops - self.sizes
        for width in range(self.least, self.most + 1):
            # Runs that end in a new word and begin in the same text.
            last = np.arange(max(old, width - 1), len(self.texts))
            first = last - (width - 1)
            same = self.texts[first] == self.texts[last]
            first, last = first[same], last[same]
            self.take(self.texts[last], between(begins[first], self.crcs[last + 1], stops[last] - starts[first]))

        keep = max(0, len(self.texts) - (self.most - 1))
        self.texts, self.sizes, self.crcs = self.texts[keep:], self.sizes[keep:], self.crcs[keep:]


def _counts(batches: Iterator[pa.RecordBatch], how: Resampling) -> Iterator[pa.RecordBatch]:
    total = np.zeros(how.buckets, np.int64)

    def take(texts: np.ndarray, crcs: np.ndarray) -> None:
        total[:] += np.bincount(crcs % np.uint32(how.buckets), minlength=how.buckets)

    stream, nth = Stream(how.least, how.most, take), 0
    for part in answers(batches):
        for text in part.column(0).to_pylist():
            stream.read(nth, text)
            nth += 1
    stream.flush()
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, how: Resampling = Resampling()) -> np.ndarray:
    """How many features of all ``text`` are in each bucket. One row for a bucket and task is moved."""
    rows = texts.select("text").mapInArrow(lambda batches: _counts(batches, how), "bucket long, n long")
    total = np.zeros(how.buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row.bucket] = row.n
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths by which each bucket's log likelihood is larger in the target, rounded down."""
    size = float(len(source))
    up = (target + 1.0) * (float(source.sum()) + size)
    down = (source + 1.0) * (float(target.sum()) + size)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def _weights(batches: Iterator[pa.RecordBatch], gain: np.ndarray, how: Resampling) -> Iterator[pa.RecordBatch]:
    for part in answers(batches):
        rows = part.num_rows
        features, weight = np.zeros(rows, np.int64), np.zeros(rows, np.int64)

        def take(texts: np.ndarray, crcs: np.ndarray, features=features, weight=weight) -> None:
            features[:] += np.bincount(texts, minlength=len(features))
            # Whole numbers far below 2**53, so sums of doubles are exact.
            sums = np.bincount(texts, gain[crcs % np.uint32(how.buckets)], len(weight))
            weight[:] += sums.astype(np.int64)

        stream = Stream(how.least, how.most, take)
        words = [stream.read(nth, text) for nth, text in enumerate(part.column(1).to_pylist())]
        stream.flush()
        columns = [part.column(0), pa.array(words, pa.int64()), pa.array(features), pa.array(weight)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])


def importance(docs: DataFrame, target: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs(doc_id, text)``.

    ``weight`` sums the gains of the features of the text towards ``target(text)``; ``score`` adds
    Gumbel noise from a hash of the seed and the ``doc_id``, so that taking the highest scores is a draw
    without replacement. ``rank`` counts the drawn documents from 1 in falling order of score, then
    by ``doc_id``, ``n_features`` and ``weight``; it is NULL for the others.

    A NULL or empty text has no features and weight 0; a NULL ``doc_id`` gets the noise of an empty one
    and comes before others in ties. Rows that repeat are each a document. Texts that are long are read
    in slices. Other columns are not read; empty tables give no rows, an empty target is all zeros.
    """
    spark = docs.sparkSession
    gain = spark.sparkContext.broadcast(gains(bucket_counts(docs, how), bucket_counts(target, how)))
    kind = dict(docs.dtypes)["doc_id"]
    weighed = docs.select("doc_id", "text").mapInArrow(
        lambda batches: _weights(batches, gain.value, how), f"doc_id {kind}, n_words long, n_features long, weight long"
    )
    name = F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    chance = (F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(chance))).cast("long")
    scored = stage(weighed.withColumn("score", F.col("weight") + noise), "importance")

    enough = F.col("n_words") >= how.least_words
    drawn = scored.where(enough).count() * how.share // 100
    ranked = dense_id(scored.where(enough), F.desc("score"), "doc_id", "n_features", "weight", id_col="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """The rows of ``docs`` that are drawn, all columns kept. Rows that share a ``doc_id`` come together."""
    drawn = importance(docs, target, how).where("rank is not null").select("doc_id").distinct()
    return docs.join(drawn, docs["doc_id"].eqNullSafe(drawn["doc_id"]), "left_semi")
