"""Token counts of whole texts by counting every distinct pre-token once.

A piece of the model never holds a space behind another character, and a line feed in no piece at
all. So a text may be cut ahead of its spaces and on both sides of a line feed, and the tokens of a text
are those of its parts. Parts repeat:

* Each task cuts its documents into blocks and keeps a block as its distinct parts and a sparse matrix:
  how many times each document holds each of them.
* The distinct parts of all blocks are dealt to buckets by hash and meet there, where each is encoded
  once. A block sends the parts of a bucket as one row, so a part, however common, comes once a block.
* Their token counts go back to the blocks, and each document's are summed. Ids of a document are
  never made.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.sources.staging import stage

#: Characters of text in a block, and of a text that are cut into parts at a time.
BLOCK_CHARS, SLICE_CHARS = 32_000_000, 1_000_000

#: Parts that are encoded by one call.
ENCODED = 20_000

# A space and the model's own sign for it are the same to it.
_SPACE_SIGN = "▁"
_PART = re.compile("\n| *[^ \n]+| +")

# Lists of numbers are packed; ``buckets`` holds the distinct parts of each bucket, sorted and joined.
BLOCK = (
    "block long, buckets array<binary>, steps binary, times binary, held binary, "
    "doc_ids array<{kind}>, sizes array<long>, lines array<long>"
)


def pack(numbers: np.ndarray) -> bytes:
    """Small numbers in few bytes: byte by byte of each, compressed."""
    return zlib.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def parts_of(text: str) -> Iterator[list[str]]:
    """What the model encodes on its own, some at a time: lists of parts that joined give the text
    with the space that the model puts ahead of it."""
    text = " " + text.replace(_SPACE_SIGN, " ")
    start = 0
    while start < len(text):
        stop = start + SLICE_CHARS
        # Not between a space and what follows it, and not inside a word.
        while 0 < stop < len(text) and not (text[stop] == " " and text[stop - 1] != " "):
            stop = text.find(" ", stop + 1)
        stop = len(text) if stop < 0 else stop
        yield _PART.findall(text, start, stop)
        start = stop


class _Block:
    """Documents as a sparse matrix over their distinct parts."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.places: dict[str, int] = {}
        self.ids, self.sizes, self.lines = [], [], []
        self.columns, self.times = [], []

    def add(self, key, text: str) -> None:
        counts = Counter()
        for parts in parts_of(text) if text else ():
            counts.update(parts)
        # A line feed is one token.
        self.lines.append(counts.pop("\n", 0))
        places = self.places
        self.columns.append(np.array([places.setdefault(part, len(places)) for part in counts], np.int32))
        self.times.append(np.fromiter(counts.values(), np.int32, len(counts)))
        self.ids.append(key)
        self.sizes.append(len(text.encode()))
        self.chars += len(text)

    def row(self, buckets: int, kind: pa.DataType) -> pa.RecordBatch:
        """The block with its parts in the order of buckets and texts, and the columns of each document as
        steps from one to the next."""
        parts = sorted(self.places)
        dealt = np.array([zlib.crc32(part.encode()) % buckets for part in parts], np.int64)
        order = np.argsort(dealt, kind="stable")
        rank = np.empty(len(parts), np.int64)
        rank[[self.places[parts[nth]] for nth in order]] = np.arange(len(parts))
        bounds = np.searchsorted(dealt[order], np.arange(buckets + 1))
        texts = [
            zlib.compress("\n".join([parts[nth] for nth in order[low:high]]).encode(), 1) if high > low else None
            for low, high in zip(bounds, bounds[1:])
        ]
        held = np.array([len(columns) for columns in self.columns], np.int64)
        columns, times = (np.concatenate([np.zeros(0, np.int32), *each]) for each in (self.columns, self.times))
        document = np.repeat(np.arange(len(held)), held)
        along = np.argsort(document * max(len(parts), 1) + rank[columns])
        columns = rank[columns][along]
        steps = np.diff(columns, prepend=0)
        starts = (np.cumsum(held) - held)[held > 0]
        steps[starts] = columns[starts]
        values = [
            pa.array([self.number], pa.int64()), pa.array([texts], pa.list_(pa.binary())),
            *(pa.array([pack(numbers)], pa.binary()) for numbers in (steps, times[along], held)),
            pa.array([self.ids], pa.list_(kind)),
            *(pa.array([numbers], pa.list_(pa.int64())) for numbers in (self.sizes, self.lines)),
        ]
        names = ["block", "buckets", "steps", "times", "held", "doc_ids", "sizes", "lines"]
        return pa.RecordBatch.from_arrays(values, names)


def _blocks(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    block, kind = _Block(TaskContext.get().partitionId() << 32), None
    for batch in batches:
        kind = batch.column(0).type
        for nth, key in enumerate(batch.column(0).to_pylist()):
            block.add(key, batch.column(1)[nth].as_py() or "")
            if block.chars >= BLOCK_CHARS:
                yield block.row(buckets, kind)
                block = _Block(block.number + 1)
    if block.ids:
        yield block.row(buckets, kind)


@lru_cache(maxsize=2)
def _library(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def tokens_of(parts: list[str], path: str) -> list[int]:
    """Tokens of each part as it stands inside a text.

    The library puts a space ahead of what it is given. A part with a space is given without its first
    one; any other after a line feed, which keeps the two apart and makes two tokens more.
    """
    begins = [part[0] == " " for part in parts]
    given = [part[1:] if begin else "\n" + part for part, begin in zip(parts, begins, strict=True)]
    # A lone space is all that is left of an empty text, which has no tokens.
    found = _library(path)(given)
    return [1 if part == " " else n if begin else n - 2 for part, begin, n in zip(parts, begins, found, strict=True)]


def _priced(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows of (bucket, block, parts), sorted by bucket, to (block, bucket, tokens of each part).

    Holds the distinct parts of one bucket.
    """
    last, known = None, {}
    for batch in batches:
        for bucket, block, packed in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if bucket != last:
                last, known = bucket, {}
            parts = zlib.decompress(packed).decode().split("\n")
            new = [part for part in parts if part not in known]
            for start in range(0, len(new), ENCODED):
                some = new[start : start + ENCODED]
                known.update(zip(some, tokens_of(some, path), strict=True))
            tokens = np.fromiter(map(known.__getitem__, parts), np.int32, len(parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([bucket], pa.int32()), pa.array([pack(tokens)], pa.binary())],
                ["block", "bucket", "tokens"],
            )


def _summed(block: pa.Table, priced: pa.Table) -> pa.Table:
    """The documents of one block with the sums of the tokens of their parts."""
    steps, times, held = (unpack(block.column(name)[0].as_py()).astype(np.int64) for name in ("steps", "times", "held"))
    by_bucket = sorted(zip(priced.column("bucket").to_pylist(), priced.column("tokens").to_pylist()))
    tokens = np.concatenate([np.zeros(0, np.int64), *[unpack(packed) for _, packed in by_bucket]])
    # Steps begin anew with every document.
    starts = np.cumsum(held) - held
    places = np.cumsum(steps)
    places -= np.repeat(np.concatenate([[0], places])[starts], held)
    sums = np.concatenate([[0], np.cumsum(tokens[places] * times)])
    ids, sizes, lines = (block.column(name)[0].values for name in ("doc_ids", "sizes", "lines"))
    counted = sums[starts + held] - sums[starts] + lines.to_numpy()
    return pa.table([ids, sizes, pa.array(counted)], names=["doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs(doc_id, text)``, without begin and end tokens.

    ``model`` is a file of the sentencepiece library that changes no character, puts a space ahead of a
    text and has no piece that goes on behind a space or holds a line feed; another is an error.

    A NULL text is empty and has no tokens. Rows that repeat are each counted and given, as are rows
    without a ``doc_id``. A long text is cut in slices and stands in one block with all its parts.
    Other columns are not read; an empty table gives no rows. There is a bucket for each shuffle
    partition of the session, whose distinct parts one task holds.
    """
    require_separable(model)
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = BLOCK.format(kind=kind)
    blocks = stage(docs.select("doc_id", "text").mapInArrow(lambda batches: _blocks(batches, buckets), schema), "pre-token-counts")

    parts = blocks.select("block", F.posexplode("buckets").alias("bucket", "parts")).where("parts is not null")
    priced = (
        parts.select("bucket", "block", "parts").repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(lambda batches: _priced(batches, model), "block long, bucket int, tokens binary")
    )
    return (
        blocks.drop("buckets").groupBy("block").cogroup(priced.groupBy("block"))
        .applyInArrow(_summed, f"doc_id {kind}, n_bytes long, n_tokens long")
    )


@lru_cache(maxsize=4)
def require_separable(path: str) -> None:
    """Fail unless a text may be cut as :func:`parts_of` does."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    loaded = proto.ModelProto()
    with open(path, "rb") as file:
        loaded.ParseFromString(file.read())
    rules = loaded.normalizer_spec
    same = rules.name == "identity" and rules.add_dummy_prefix and rules.escape_whitespaces
    if not same or rules.remove_extra_whitespaces or loaded.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError(f"{path}: the model changes texts before it cuts them")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(nth) for nth in range(model.get_piece_size())]
    if any(_SPACE_SIGN in piece.lstrip(_SPACE_SIGN) or "\n" in piece for piece in pieces) or len(model.encode("\n")) != 2:
        raise ValueError(f"{path}: a piece goes on behind a space or line feed")
