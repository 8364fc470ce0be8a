"""Token ids as binary blocks with a minimal perfect hash index.

A table of blocks, ranges of documents in ascending key order. A block row holds the raw ids of its
documents one after another, where each document ends, and an index from key to place: a minimal
perfect hash over the block's keys gives each a slot of its own, which holds a fingerprint of the
key and the document's place in the block. A lookup is one hash, one comparison and one slice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.pieces import encoding, library_encoder

#: Ids after which a block ends (a longer document is a block of its own).
BLOCK_IDS = 256 * 1024

BLOCK_SCHEMA = (
    "part int, first_in_part long, first_key long, last_key long, n_docs long, n_nulls long, "
    "keys binary, ends binary, levels binary, bits binary, prints binary, places binary, ids binary"
)

_GOLDEN = 0x9E3779B97F4A7C15


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """64 well-mixed bits of each integer key; different salts are independent."""
    x = keys.astype(np.uint64) + np.uint64((salt + 1) * _GOLDEN & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 to n-1 for n distinct keys.

    Level by level, keys that fall alone on a position of a bit array keep it, and the others go on
    to a fresh, smaller level. A key's slot is the number of bits set before its own.
    """

    def __init__(self, levels: np.ndarray, bits: np.ndarray):
        self.levels, self.bits = levels, bits
        self.ranks = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
        self.starts = np.concatenate([[0], np.cumsum(levels, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray, room: float = 1.5) -> PerfectHash:
        left, levels, arrays = keys, [], []
        while len(left):
            size = int(room * len(left)) + 1
            at = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(size)
            arrays.append(alone)
            left = left[~alone[at]]
        return cls(np.array(levels, "<u4"), np.concatenate(arrays) if arrays else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level holds it; other keys may get any slot."""
        slots = np.full(len(keys), -1, np.int64)
        for level, size in enumerate(self.levels):
            open_ = np.flatnonzero(slots < 0)
            if not len(open_):
                break
            at = (mixed(keys[open_], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            hit = self.bits[at]
            slots[open_[hit]] = self.ranks[at[hit]]
        return slots


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


def block_row(part: int, first: int, keys: list, texts: list[bytes], width: int) -> tuple:
    """One block from documents in order; those without a key come first."""
    nulls = sum(k is None for k in keys)
    known = np.array(keys[nulls:], "<i8")
    distinct, places = np.unique(known, return_index=True)
    hashed = PerfectHash.build(distinct)
    prints, docs = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    slots = hashed.slots(distinct)
    prints[slots], docs[slots] = _fingerprints(distinct), places + nulls
    ends = np.cumsum([len(t) // width for t in texts], dtype="<i8")
    return (
        part, first, *((int(known[0]), int(known[-1])) if len(known) else (None, None)),
        len(keys), nulls, known.tobytes(), ends.tobytes(), hashed.levels.tobytes(),
        np.packbits(hashed.bits).tobytes(), prints.tobytes(), docs.tobytes(), b"".join(texts),
    )


class Block:
    """Keyed access to the documents of one block row."""

    def __init__(self, row: dict, width: int = 2):
        self.row, self.width = row, width
        levels = np.frombuffer(row["levels"], "<u4")
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: int(levels.sum())].astype(bool)
        self.hash = PerfectHash(levels, bits)
        self.prints = np.frombuffer(row["prints"], "<u4")
        self.places = np.frombuffer(row["places"], "<u4")
        self.ends = np.frombuffer(row["ends"], "<i8")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of the first document of each key, -1 for a key whose fingerprint is not there."""
        slots = self.hash.slots(keys)
        safe = np.maximum(slots, 0)
        if not len(self.prints):
            return np.full(len(keys), -1, np.int64)
        known = (slots >= 0) & (self.prints[safe] == _fingerprints(keys))
        return np.where(known, self.places[safe].astype(np.int64), -1)

    def document(self, place: int) -> tuple[int, bytes]:
        """First id in the block and the raw ids of the document at ``place``."""
        start = int(self.ends[place - 1]) if place else 0
        return start, self.row["ids"][start * self.width : int(self.ends[place]) * self.width]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode every whole text, append ``end_id``, and write the blocks to ``path``.

    Ids take two bytes, so the vocabulary must be below 65,536. NULL texts are empty. Documents
    are in ascending ``doc_id`` order over the files; those with a NULL ``doc_id`` come first and
    are not in the index, and rows with one ``doc_id`` stand together, the first being the one that
    a lookup finds. The one shuffle ranges over key and content, so that a repeated key is split over
    tasks; a task holds one block at a time. An empty table gives no blocks.
    """
    end = end_id.to_bytes(2, "little")
    # Ranges are sampled, which runs what is below them: texts are dealt first and encoded after.
    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
    )
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, held = TaskContext.get().partitionId(), 0, 0
        keys: list = []
        texts: list[bytes] = []

        def block() -> pa.RecordBatch:
            row = block_row(part, first, keys, texts, 2)
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row))], schema)

        schema = pa.schema(
            [("part", pa.int32()), *[(c, pa.int64()) for c in ("first_in_part", "first_key", "last_key", "n_docs", "n_nulls")]]
            + [(c, pa.binary()) for c in ("keys", "ends", "levels", "bits", "prints", "places", "ids")]
        )
        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if texts and (held + len(ids) // 2) > BLOCK_IDS:
                    yield block()
                    first, held, keys, texts = first + held, 0, [], []
                keys.append(key)
                texts.append(ids)
                held += len(ids) // 2
        if texts:
            yield block()

    first = encoding(lambda: library_encoder(tokenizer, "H", added=True), end)
    blocks = ranged.select("doc_id", "text").mapInArrow(lambda batches: run(first(batches)), BLOCK_SCHEMA)
    blocks.write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of all documents, each key looked up through the index.

    ``start`` counts the ids of all documents before, ``ids`` are packed 32-bit integers. The rows
    of a repeated key follow its first one, which is the one looked up.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                block, keys = Block(row), np.frombuffer(row["keys"], "<i8")
                distinct, counts = np.unique(keys, return_counts=True)
                places = [*range(row["n_nulls"])]
                names = [None] * row["n_nulls"]
                for key, place, count in zip(distinct.tolist(), block.find(distinct).tolist(), counts.tolist()):
                    places += range(place, place + count)
                    names += [key] * count
                found = [block.document(place) for place in places]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array([row["part"]] * len(found), pa.int32()),
                        pa.array([row["first_in_part"] + start for start, _ in found], pa.int64()),
                        pa.array([np.frombuffer(ids, "<u2").astype("<u4").tobytes() for _, ids in found], pa.binary()),
                    ],
                    ["doc_id", "part", "start_in_part", "ids"],
                )

    # A row for each range partition of the write, so it is bounded by that number.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = F.octet_length("ids") / 2
    bases = (
        blocks.groupBy("part")
        .agg(F.max(F.col("first_in_part") + held).cast("long").alias("held"))
        .select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    )
    documents = blocks.mapInArrow(run, "doc_id long, part int, start_in_part long, ids binary")
    return documents.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "ids"
    )


def lookup(spark: SparkSession, path: str, keys: Iterable[int]) -> dict[int, np.ndarray]:
    """Ids of a few documents by key; keys that are not there are left out.

    For lists that a caller holds in memory. Blocks are chosen by their key range, which is pushed
    down to the scan, and each is probed once for every key in its range.
    """
    wanted = sorted(set(keys))
    if not wanted:
        return {}
    in_range = F.exists(F.array(*map(F.lit, wanted)), lambda k: k.between(F.col("first_key"), F.col("last_key")))
    blocks = (
        spark.read.schema(BLOCK_SCHEMA)
        .parquet(path)
        .where((F.col("last_key") >= wanted[0]) & (F.col("first_key") <= wanted[-1]) & in_range)
    )
    result: dict[int, np.ndarray] = {}
    for row in blocks.toLocalIterator():
        block, inside = Block(row.asDict()), [k for k in wanted if row.first_key <= k <= row.last_key]
        for key, place in zip(inside, block.find(np.array(inside, "<i8")).tolist()):
            if place >= 0 and key not in result:
                result[key] = np.frombuffer(block.document(place)[1], "<u2")
    return result
