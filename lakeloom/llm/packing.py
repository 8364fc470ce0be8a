"""Best-fit packing of documents into sequences, improved by swap-based local search."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.pieces import encode, let_go, library_encoder

#: Characters of text for each group that is packed on its own. More in a group leave fewer
#: sequences that no document fits any more, at most one or so a group.
GROUP_CHARS = 32_000_000

# What a document weighs besides its text when groups are sized.
_DOCUMENT_CHARS = 200

# Sequences a group's numbers are apart.
_GROUP_STEP = 1 << 32


class Bins:
    """Items of whole sizes in bins of one capacity."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.items: list[set[int]] = []
        self.fill: list[int] = []
        # Underfull bins by the sizes of their items, and by the sums of two of them.
        self.singles: dict[int, set[int]] = defaultdict(set)
        self.pairs: dict[int, set[int]] = defaultdict(set)
        self.entered: dict[int, list] = {}

    def best_fit(self) -> None:
        """Each item, the longest first, into the fullest bin that it fits."""
        free: list[int] = []  # distinct gaps, ascending
        by_gap: dict[int, list[int]] = {}

        def put(gap: int, bin_: int) -> None:
            if gap not in by_gap:
                by_gap[gap] = []
                insort(free, gap)
            by_gap[gap].append(bin_)

        for item in sorted(range(len(self.sizes)), key=lambda i: -self.sizes[i]):
            size = self.sizes[item]
            nth = bisect_left(free, size)
            if nth == len(free):
                bin_, gap = len(self.items), self.capacity
                self.items.append(set())
                self.fill.append(0)
            else:
                gap = free[nth]
                bin_ = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap]
                    free.pop(nth)
            self.items[bin_].add(item)
            self.fill[bin_] += size
            if gap > size:
                put(gap - size, bin_)

    def least(self) -> int:
        """No packing has fewer bins than this."""
        return math.ceil(sum(self.sizes) / self.capacity)

    def used(self) -> int:
        return sum(1 for f in self.fill if f)

    def _list(self, bin_: int) -> None:
        """Enter an underfull bin under its sizes and the sums of two of them, or take it out."""
        entered = self.entered.pop(bin_, ())
        for sums, size in entered:
            sums[size].discard(bin_)
        if 0 < self.fill[bin_] < self.capacity:
            sizes = sorted(self.sizes[i] for i in self.items[bin_])
            entries = [(self.singles, size) for size in set(sizes)]
            entries += [(self.pairs, total) for total in {a + b for a, b in combinations(sizes, 2)}]
            for sums, size in entries:
                sums[size].add(bin_)
            self.entered[bin_] = entries

    def _exchange(self, a: int, out: list[int], b: int, back: list[int]) -> None:
        """``out`` goes from ``a`` to ``b`` and ``back`` the other way."""
        moved = sum(self.sizes[i] for i in out) - sum(self.sizes[i] for i in back)
        self.items[a].difference_update(out)
        self.items[a].update(back)
        self.items[b].difference_update(back)
        self.items[b].update(out)
        self.fill[a] -= moved
        self.fill[b] += moved
        self._list(a)
        self._list(b)

    def _one(self, bin_: int, size: int) -> list[int]:
        return [next(i for i in self.items[bin_] if self.sizes[i] == size)]

    def _two(self, bin_: int, total: int) -> list[int]:
        first: dict[int, int] = {}
        for item in self.items[bin_]:
            if total - self.sizes[item] in first:
                return [first[total - self.sizes[item]], item]
            first[self.sizes[item]] = item
        raise ValueError(f"no two items of {total} in bin {bin_}")

    def _giver(self, sums: dict[int, set[int]], size: int, taker: int, gain: int) -> int | None:
        """A bin with an item (or two) of ``size`` that may lose ``gain`` to ``taker``: the squared
        fill grows exactly if the taker ends fuller than the giver was."""
        most = self.fill[taker] + gain
        return next((b for b in sums.get(size, ()) if b != taker and self.fill[b] < most), None)

    def _improve(self, taker: int) -> bool:
        """The first exchange that gains ``taker`` most: a move, one for one, two for one."""
        sizes = sorted(self.sizes[i] for i in self.items[taker])
        own, doubles = sorted(set(sizes)), sorted({a + b for a, b in combinations(sizes, 2)})
        for gain in range(self.capacity - self.fill[taker], 0, -1):
            giver = self._giver(self.singles, gain, taker, gain)
            if giver is not None:
                self._exchange(giver, self._one(giver, gain), taker, [])
                return True
            for size in own:
                giver = self._giver(self.singles, size + gain, taker, gain)
                if giver is not None:
                    self._exchange(giver, self._one(giver, size + gain), taker, self._one(taker, size))
                    return True
                giver = self._giver(self.pairs, size + gain, taker, gain)
                if giver is not None:
                    self._exchange(giver, self._two(giver, size + gain), taker, self._one(taker, size))
                    return True
            for both in doubles:
                giver = self._giver(self.singles, both + gain, taker, gain)
                if giver is not None:
                    self._exchange(giver, self._one(giver, both + gain), taker, self._two(taker, both))
                    return True
        return False

    def search(self) -> None:
        """Exchange between underfull bins while the squared fill grows, fullest bins first.

        Ends when no bin can be filled further or when the bins are as few as can be. Every
        exchange makes the sum of squares larger, so the search ends.
        """
        least = self.least()
        for bin_ in range(len(self.fill)):
            self._list(bin_)
        moved = True
        while moved and self.used() > least:
            moved = False
            underfull = [b for b, f in enumerate(self.fill) if 0 < f < self.capacity]
            for taker in sorted(underfull, key=lambda b: -self.fill[b]):
                while 0 < self.fill[taker] < self.capacity and self._improve(taker):
                    moved = True


def pack(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin (from 0, without gaps) and offset of each item; sizes are 1 to ``capacity``."""
    bins = Bins(sizes, capacity)
    bins.best_fit()
    if bins.used() > bins.least():
        bins.search()
    numbers, offsets, nth = [0] * len(sizes), [0] * len(sizes), 0
    for items in bins.items:
        if not items:
            continue
        at = 0
        for item in sorted(items):
            numbers[item], offsets[item] = nth, at
            at += sizes[item]
        nth += 1
    return numbers, offsets


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """``doc_id, piece, start, length, ids``: every text's ids and ``end_id``, in pieces.

    Ids are packed 16-bit integers, so the vocabulary must be below 65,536. Documents up to
    ``capacity`` are one piece. Longer ones are cut into full pieces, and what is left over is the
    first piece, so that it ends where a full piece begins.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            places, pieces, starts, lengths, ids = [], [], [], [], []
            for row, packed in enumerate(part.column(1).to_pylist()):
                total = len(packed) // 2
                cuts = [0, *range(total % capacity or capacity, total, capacity), total]
                for nth, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                    places.append(row)
                    pieces.append(nth)
                    starts.append(start)
                    lengths.append(stop - start)
                    ids.append(packed[2 * start : 2 * stop])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(places, pa.int64())), pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    encoder = lambda: library_encoder(tokenizer, "H", added=True)
    schema = "piece int, start long, length long, ids binary"
    return encode(docs, encoder, end_id.to_bytes(2, "little"), cut, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024, group_chars: int = GROUP_CHARS
) -> DataFrame:
    """Every piece with its place: ``doc_id, piece, start, length, ids, sequence_id, offset``.

    NULL texts are empty, so they are the end id alone; rows with a NULL or repeated ``doc_id`` are
    documents of their own. Other columns are ignored; an empty table gives no rows.

    ``ids`` are packed 32-bit integers. Pieces are dealt evenly to groups of about ``group_chars``, by row and not by key, so that no
    value can make a group large. Each group is packed in one task: full pieces are sequences,
    the rest go by best fit and the local search of :class:`Bins`. Groups cost at most a few
    underfull sequences each, and their number follows the size of the table.
    """
    weight = F.coalesce(F.length("text"), F.lit(0)) + F.lit(_DOCUMENT_CHARS)
    chars = docs.agg(F.sum(weight.cast("long")).alias("chars")).first()["chars"] or 0
    groups = max(1, math.ceil(chars / group_chars))
    pieces = cut_pieces(docs, tokenizer, end_id, capacity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All is encoded by now.
        let_go()
        held = list(batches)
        if not held:
            return
        base = TaskContext.get().partitionId() * _GROUP_STEP
        sizes = [size for batch in held for size in batch.column(3).to_pylist()]
        short = [n for n, size in enumerate(sizes) if size < capacity]
        numbers, offsets = pack([sizes[n] for n in short], capacity)
        full_from = max(numbers, default=-1) + 1
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        sequence[short], offset[short] = numbers, offsets
        full = [n for n, size in enumerate(sizes) if size == capacity]
        sequence[full] = full_from + np.arange(len(full))
        at = 0
        for batch in held:
            stop = at + batch.num_rows
            wide = [np.frombuffer(ids, "<u2").astype("<u4").tobytes() for ids in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:4], pa.array(wide, pa.binary()),
                    pa.array(base + sequence[at:stop]), pa.array(offset[at:stop]),
                ],
                [*batch.schema.names, "sequence_id", "offset"],
            )
            at = stop

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long"
    return pieces.repartition(groups).mapInArrow(run, schema)
