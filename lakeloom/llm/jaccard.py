"""Jaccard join of word n-gram sets with prefix trees.

All sets are in one global order: n-grams of fewer documents come first, equally rare ones by hash.
Similar sets agree on one of their first n-grams at least, so a set hangs in the tree below each of these,
and sets meet where they hang together. What hangs together is gathered in bounded blocks. The sets of a
block are stored in a prefix tree and those of another walk it together, sharing the overlap counted along
common paths; a subtree ends for a set when even its longest set could not reach the overlap needed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.graphs import components, forest
from lakeloom.llm.hashing import STEP, WordHashes, finish, windows
from lakeloom.llm.pieces import answers
from lakeloom.sources.layout import broadcast_within
from lakeloom.sources.staging import settled, spent, stage


@dataclass(frozen=True)
class Similar:
    """Sets link when ``100 * intersection >= percent * union``."""

    words: int = 4
    percent: int = 85

    def first(self, size: int) -> int:
        """So many of a set's n-grams hold one that any similar set has among as many of its own."""
        return size + (-self.percent * size) // 100 + 1

    def linked(self, overlap, size_a, size_b):
        return (100 + self.percent) * overlap >= self.percent * (size_a + size_b)


#: A block of gathered sets has about so many n-grams and sets.
BLOCK_GRAMS, BLOCK_SETS = 150_000, 256

#: Most slots of the map of how common n-grams are, as a power of two, at four bits each (16 MB).
MAP_BITS = 25

#: Bits of the map of gathered documents, as a power of two (8 MB).
ID_BITS = 26

#: N-grams that a task counts at a time, and that a bucket of counts is meant to hold.
COUNTED, BUCKET_GRAMS = 1_000_000, 1_000_000

# -- sets ----------------------------------------------------------------------------------------

def gram_set(hashes: WordHashes, text: str | None, words: int) -> np.ndarray:
    """Distinct hashes of a text's word n-grams, ascending; of all words if it has fewer than n.

    A-Z count as a-z; two different n-grams agree with a chance of about one in 2**64.
    """
    found = hashes(text.encode().lower()) if text else np.zeros(0, np.uint64)
    return np.unique(windows(found, min(words, len(found)))) if len(found) else found


def _mapped(docs: DataFrame, schema: str, answer) -> DataFrame:
    """``answer(part, hashes)`` gives the columns of ``schema`` for each slice of ``docs``."""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part in answers(batches):
            yield pa.RecordBatch.from_arrays(answer(part, hashes), names)

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, similar: Similar) -> DataFrame:
    """``doc_id, size, high, low``: set size and a 128-bit digest of the set."""

    def answer(part: pa.RecordBatch, hashes: WordHashes) -> list[pa.Array]:
        sets = [gram_set(hashes, text, similar.words) for text in part.column(1).to_pylist()]
        high = [g.sum(dtype=np.uint64) for g in sets]
        low = [finish(g ^ np.uint64(STEP)).sum(dtype=np.uint64) for g in sets]
        return [
            part.column(0), pa.array([len(g) for g in sets], pa.int64()),
            pa.array(np.array(high, np.uint64).view(np.int64)), pa.array(np.array(low, np.uint64).view(np.int64)),
        ]

    return _mapped(docs.select("doc_id", "text"), "doc_id long, size long, high long, low long", answer)


# -- the global order ----------------------------------------------------------------------------


class Commonness:
    """How common n-grams are: for each slot of their hashes the highest level in it, the logarithm of
    the number of documents, from 0 for an n-gram of one document alone to 15.

    The map has a fixed size. Where more than half of its slots would be taken it holds the most
    common n-grams only, and ``complete`` is False: an n-gram at level 0 may then be shared too.
    """

    def __init__(self, pairs: np.ndarray, taken: np.ndarray):
        """``pairs`` holds two slots in a byte, ``taken`` the number of slots at each level."""
        least = next(n for n in range(1, 17) if taken[n:].sum() * 2 <= 2 * len(pairs))
        self.complete = least == 1
        self.bits = (2 * len(pairs)).bit_length() - 1
        self.pairs = pairs
        for part in [] if self.complete else np.array_split(pairs, 64):
            low, high = part & np.uint8(15), part >> np.uint8(4)
            part[:] = np.where(low >= least, low, 0) | (np.where(high >= least, high, 0) << 4)

    @staticmethod
    def packed(levels: np.ndarray) -> np.ndarray:
        return levels[0::2] | (levels[1::2] << np.uint8(4))

    def of(self, grams: np.ndarray) -> np.ndarray:
        slots = grams >> np.uint64(64 - self.bits)
        return (self.pairs[slots >> np.uint64(1)] >> ((slots & np.uint64(1)) << np.uint64(2)).astype(np.uint8)) & np.uint8(15)

    def ordered(self, grams: np.ndarray) -> np.ndarray:
        """N-grams as numbers in the global order, ascending: four bits of level and sixty of hash."""
        return np.sort((self.of(grams).astype(np.uint64) << np.uint64(60)) | (grams >> np.uint64(4)))

    def keys(self, grams: np.ndarray, similar: Similar) -> np.ndarray:
        """Of the first of :meth:`ordered` n-grams those that other documents may have."""
        first = grams[: similar.first(len(grams))]
        return first[first >> np.uint64(60) > 0] if self.complete else first


def _packed(values: np.ndarray) -> bytes:
    """Ascending numbers as their steps, byte by byte of each, after the count of bytes."""
    steps = np.diff(values, prepend=np.uint64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    width = packed[0]
    planes = np.frombuffer(packed, np.uint8, offset=1).reshape(width, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :width] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def commonness(docs: DataFrame, similar: Similar, grams: int) -> Commonness:
    """Count the n-grams, about ``grams`` in all, of the documents.

    Each task sorts the hashes of some of its n-grams and sends them by ranges, as steps from one to the
    next, a few bits for each. A range is counted by one task, as is the part of the map that it
    makes; ranges grow in number with the n-grams. The map alone reaches the driver.
    """
    # Bits by which n-grams are told apart here; a chance agreement only makes one seem more common.
    map_bits = min(MAP_BITS, max(16, grams.bit_length() + 3))
    bits = min(64, max(map_bits, grams.bit_length() + 6))
    buckets = 1 << min(map_bits - 6, max(5, (grams // BUCKET_GRAMS).bit_length()))

    def send(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held) >> np.uint64(64 - bits), return_counts=True)
        cuts = np.searchsorted(values, np.arange(1, buckets, dtype=np.uint64) << np.uint64(bits - (buckets.bit_length() - 1)))
        cuts = [0, *cuts.tolist(), len(values)]
        rows = [
            (n, _packed(values[a:b]), np.minimum(counts[a:b], 255).astype(np.uint8).tobytes())
            for n, (a, b) in enumerate(zip(cuts, cuts[1:]))
            if b > a
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in rows], of) for n, of in enumerate((pa.int32(), pa.binary(), pa.binary()))],
            ["bucket", "grams", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0
        for part in answers(batches):
            for text in part.column(0).to_pylist():
                held.append(gram_set(hashes, text, similar.words))
                size += len(held[-1])
                if size >= COUNTED:
                    yield send(held)
                    held, size = [], 0
        if size:
            yield send(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def segment() -> pa.RecordBatch:
            values = np.concatenate([_unpacked(grams) for grams, _ in held])
            counts = np.concatenate([np.frombuffer(n, np.uint8) for _, n in held])
            order = np.argsort(values, kind="stable")
            values, starts = np.unique(values[order], return_index=True)
            total = np.add.reduceat(counts[order].astype(np.int64), starts)
            shared = total > 1
            slots = 1 << (map_bits - (buckets.bit_length() - 1))
            at = (values[shared] >> np.uint64(bits - map_bits)) & np.uint64(slots - 1)
            levels = np.zeros(slots, np.uint8)
            np.maximum.at(levels, at, np.minimum(np.log2(total[shared]), 15).astype(np.uint8))
            taken = np.bincount(levels, minlength=16)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([bucket], pa.int32()), pa.array([zlib.compress(Commonness.packed(levels).tobytes(), 1)], pa.binary()),
                    pa.array([taken.tolist()], pa.list_(pa.int64())),
                ],
                ["bucket", "pairs", "taken"],
            )

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[0] != bucket:
                    if held:
                        yield segment()
                    bucket, held = row[0], []
                held.append(row[1:])
        if held:
            yield segment()

    sent = docs.select("text").mapInArrow(count, "bucket int, grams binary, counts binary")
    merged = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        merge, "bucket int, pairs binary, taken array<long>"
    )
    pairs = np.zeros((buckets, (1 << map_bits) // buckets // 2), np.uint8)
    taken = np.zeros(16, np.int64)
    with spent(docs.sparkSession):
        segments = merged.collect()
    for row in segments:
        pairs[row.bucket] = np.frombuffer(zlib.decompress(row.pairs), np.uint8)
        taken += row.taken
    return Commonness(pairs.ravel(), taken)


def keyed(docs: DataFrame, similar: Similar, common) -> DataFrame:
    """``doc_id, key``: a row for each n-gram below which a document hangs together with others."""

    def answer(part: pa.RecordBatch, hashes: WordHashes) -> list[pa.Array]:
        order = common.value
        keys = [
            order.keys(order.ordered(gram_set(hashes, text, similar.words)), similar).view(np.int64)
            for text in part.column(1).to_pylist()
        ]
        offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
        return [part.column(0), pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.int64), *keys]))]

    found = _mapped(docs.select("doc_id", "text"), "doc_id long, keys array<long>", answer)
    return found.select("doc_id", F.explode("keys").alias("key"))


def _picked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, text`` of the documents in ``ids``.

    A bit map of the ids' lowest bits, of a fixed size, keeps most other documents from being moved.
    """
    low = F.col("doc_id").bitwiseAND(F.lit((1 << ID_BITS) - 1))
    words = ids.select(F.shiftright(low, 6).alias("word"), F.expr("shiftleft(1L, int(doc_id & 63))").alias("bit"))
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (ID_BITS - 6), np.int64)
    bits[table["word"].to_numpy()] = table["bits"].to_numpy()
    sought = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint64))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            own = own & np.uint64((1 << ID_BITS) - 1)
            is_in = sought.value[own >> np.uint64(6)] >> (own & np.uint64(63)) & np.uint64(1)
            yield batch.filter(pa.array(is_in.astype(bool)))

    near = docs.select("doc_id", "text").mapInArrow(pick, "doc_id long, text string")
    return near.join(ids, "doc_id", "left_semi")


def _gathered(docs: DataFrame, ids: DataFrame, similar: Similar, common) -> DataFrame:
    """``doc_id, grams`` of the documents in ``ids``, by the global order."""

    def answer(part: pa.RecordBatch, hashes: WordHashes) -> list[pa.Array]:
        sets = [common.value.ordered(gram_set(hashes, text, similar.words)).tobytes() for text in part.column(1).to_pylist()]
        return [part.column(0), pa.array(sets, pa.binary())]

    return _mapped(_picked(docs, ids), "doc_id long, grams binary", answer)


# -- candidates that cannot be similar -----------------------------------------------------------


def signature(grams: np.ndarray) -> bytes:
    """One or two bits for each n-gram: whether a slot of their hashes holds an odd number of them.

    Two signatures differ in no more bits than there are n-grams in one set alone.
    """
    width = max(64, 1 << (len(grams) - 1).bit_length())
    odd = np.bincount(((grams >> np.uint64(4)) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def hopeful(sizes: list[int], signatures: list[bytes], similar: Similar) -> np.ndarray:
    """For each set whether, by size and signature, another one may be similar to it."""
    size = np.array(sizes, np.int64)
    order = np.argsort(size, kind="stable")
    words = [np.frombuffer(s, np.uint64) for s in signatures]
    width = np.array([len(w) for w in words])
    keep = np.zeros(len(size), bool)
    for at, nth in enumerate(order):
        larger = order[at + 1 :]
        larger = larger[similar.linked(size[nth], size[nth], size[larger])]
        for wide in np.unique(width[larger]):
            others = larger[width[larger] == wide]
            # A wider signature is folded: its slots fall together as the hashes do.
            folded = np.bitwise_xor.reduce(np.stack([words[n] for n in others]).reshape(len(others), -1, width[nth]), axis=1)
            apart = np.bitwise_count(folded ^ words[nth]).sum(1, dtype=np.int64)
            found = similar.linked((size[nth] + size[others] - apart) // 2, size[nth], size[others])
            keep[others[found]] = True
            keep[nth] |= found.any()
    return keep


def _narrowed(docs: DataFrame, units: DataFrame, similar: Similar) -> DataFrame:
    """``units`` without the documents of single blocks that nothing else in them can be similar to.

    N-grams that are shared by chance bring most documents together where the map of common ones is full.
    Their sets would be moved for nothing; signatures have a sixtieth of the size.
    """
    single = units.where("blocks = 1")

    def answer(part: pa.RecordBatch, hashes: WordHashes) -> list[pa.Array]:
        sets = [gram_set(hashes, text, similar.words) for text in part.column(1).to_pylist()]
        return [part.column(0), pa.array([len(g) for g in sets], pa.int64()), pa.array([signature(g) for g in sets], pa.binary())]

    picked = _picked(docs, single.select("doc_id").distinct())
    signs = stage(_mapped(picked, "doc_id long, size long, signature binary", answer), "jaccard-signatures")
    placed = signs.join(single, "doc_id").select("unit", "doc_id", "size", "signature")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, []

        def kept() -> pa.RecordBatch:
            ids, sizes, signatures = zip(*held)
            left = sorted({ids[n] for n in np.flatnonzero(hopeful(sizes, signatures, similar))})
            return pa.RecordBatch.from_arrays(
                [pa.array([unit] * len(left), pa.int64()), pa.array(left, pa.int64())], ["unit", "doc_id"]
            )

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[0] != unit:
                    if held:
                        yield kept()
                    unit, held = row[0], []
                held.append(row[1:])
        if held:
            yield kept()

    left = placed.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "unit long, doc_id long")
    one, none = F.lit(1).cast("long").alias("blocks"), F.lit(0).cast("long").alias("block")
    return left.select("doc_id", "unit", one, none).unionByName(units.where("blocks > 1"))


# -- the join of gathered sets -------------------------------------------------------------------


class Tree:
    """Prefix tree of sets of gram numbers in the global order; chains are single nodes."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.lengths = np.array([len(s) for s in sets])

    def walk(self, members: np.ndarray, sizes: np.ndarray, similar: Similar) -> Iterator[tuple[np.ndarray, int]]:
        """(columns, set) of all links: ``members[gram, column]`` tells which grams a column has.

        Sorted sets are walked as the tree they make: a node is a range of sets that agree up to a
        depth, and holds the overlap of every column with what they agree on.
        """
        order = sorted(range(len(self.sets)), key=lambda i: self.sets[i].tolist())
        todo = [(0, len(order), 0, np.zeros(len(sizes), np.int64), np.arange(len(sizes)))]
        while todo:
            low, high, depth, overlap, alive = todo.pop()
            first, last = self.sets[order[low]], self.sets[order[high - 1]]
            # Sets between two that agree up to here agree with them.
            most = min(len(first), len(last))
            differ = np.flatnonzero(first[depth:most] != last[depth:most])
            until = depth + (int(differ[0]) if len(differ) else most - depth)
            if until > depth:
                chain = members[first[depth:until]]
                overlap = overlap + (chain if len(alive) == len(sizes) else chain[:, alive]).sum(0, dtype=np.int64)
            longest = int(self.lengths[order[low:high]].max())
            best = overlap + (longest - until)
            hopeful = similar.linked(best, sizes[alive], longest)
            if not hopeful.any():
                continue
            overlap, alive = overlap[hopeful], alive[hopeful]
            while low < high and len(self.sets[order[low]]) == until:
                hit = similar.linked(overlap, sizes[alive], until)
                if hit.any():
                    yield alive[hit], order[low]
                low += 1
            if low == high:
                continue
            heads = np.array([self.sets[i][until] for i in order[low:high]])
            cuts = [0, *(np.flatnonzero(np.diff(heads)) + 1).tolist(), high - low]
            todo += [(low + a, low + b, until, overlap, alive) for a, b in zip(cuts, cuts[1:])]


def join_sets(ids: list, sets: list[np.ndarray], sides: list[int], similar: Similar) -> list[tuple]:
    """Links, one for each join of two groups of linked sets, as (smallest id of a group, id).

    With sides 0 and 1 only pairs across are looked for, with 0 alone all pairs.
    """
    place = np.array(sides)
    probes = np.flatnonzero(place == 0)
    stored = np.flatnonzero(place == 1) if (place == 1).any() else probes
    every, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.cumsum([0, *[len(s) for s in sets]])
    numbered = [inverse[a:b] for a, b in zip(bounds, bounds[1:])]
    members = np.zeros((len(every), len(probes)), bool)
    for column, nth in enumerate(probes):
        members[numbered[nth], column] = True
    sizes = np.array([len(sets[n]) for n in probes])
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for columns, found in Tree([numbered[n] for n in stored]).walk(members, sizes, similar):
        a.append(probes[columns])
        b.append(np.full(len(columns), stored[found]))
    ranks = np.argsort(np.argsort(np.array(ids), kind="stable"), kind="stable")
    root = forest(len(ids), ranks[np.concatenate(a)], ranks[np.concatenate(b)])
    ordered = sorted(ids)
    return [(ordered[r], ordered[n]) for n, r in enumerate(root.tolist()) if r != n]


def _block_links(placed: DataFrame, similar: Similar) -> DataFrame:
    """``a, b`` from ``unit, i, j, side, doc_id, grams``, sorted by the first three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets, sides = None, [], [], []

        def links() -> pa.RecordBatch:
            # A document whose rows have several texts is one node.
            found = join_sets(ids, sets, sides, similar) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())],
                ["a", "b"],
            )

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in range(6)]
            for row in zip(*columns):
                if row[:3] != key:
                    if ids:
                        yield links()
                    key, ids, sets, sides = row[:3], [], [], []
                sides.append(row[3])
                ids.append(row[4])
                sets.append(np.frombuffer(row[5], np.uint64))
        if ids:
            yield links()

    return placed.mapInArrow(run, "a long, b long")


def similar_documents(docs: DataFrame, similar: Similar = Similar()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``n_shingles`` is the size of the row's set of word n-grams, ``component_id`` the smallest
    ``doc_id`` reachable by links. Rows without words have an empty set and link with nothing. A row
    with a NULL ``doc_id`` links with nothing and has a NULL component. Rows with one ``doc_id`` are
    one node: it has the links of all of them. Other columns are ignored; an empty table gives no
    rows.

    Equal sets are a class, represented by its smallest ``doc_id``. Representatives that hang below a
    common n-gram are linked to the smallest of them, and these links gather every similar pair in a
    unit. Large units are cut at random into blocks of a bounded size. All blocks are joined with the
    first, which mostly shows that they hang together; what does not is then joined with all. A join is
    a task of its own, which returns a spanning forest of the links and not the links themselves.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = stage(digests(known, similar), "jaccard-sets")
    digest = ["size", "high", "low"]
    usable = sets.where("size > 0 and doc_id is not null")
    classes = stage(
        usable.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")), "jaccard-classes"
    )
    # Written, so that a join with a large class can be split where it is skewed.
    copied = stage(classes.where("last > rep"), "jaccard-copied")
    of_class = (
        usable.join(copied, digest).where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    )

    # Documents that are copies and nothing else hang nowhere.
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()
    copies = stage(of_class.select(F.col("b").alias("doc_id")).distinct().join(reps, "doc_id", "left_anti"), "jaccard-copies")
    own = known.where("doc_id is not null").join(broadcast_within(copies), "doc_id", "left_anti")
    spark = docs.sparkSession
    links = settled(spark, "jaccard-links", lambda: gathered_links(own, classes, similar).unionByName(of_class))
    joined = settled(spark, "jaccard-components", lambda: components(links))
    found = joined.select(F.col("node").alias("doc_id"), "component")
    return sets.join(found, "doc_id", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def gathered_links(docs: DataFrame, classes: DataFrame, similar: Similar) -> DataFrame:
    """``a, b``: links that join all similar representatives, by blocks of gathered sets."""
    total = classes.agg(F.sum("size").alias("grams")).first()["grams"] or 0
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(commonness(docs, similar, total))

    def near() -> DataFrame:
        keys = stage(keyed(docs, similar, common), "jaccard-keys")
        hubs = keys.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("last > hub")
        found = keys.join(hubs.drop("last"), "key").where("doc_id <> hub").select("hub", "doc_id").distinct()
        return found.select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))

    edges = settled(spark, "jaccard-edges", near)
    together = settled(spark, "jaccard-units", lambda: _units(edges, classes))
    units = settled(spark, "jaccard-narrowed", lambda: _narrowed(docs, together, similar))
    sets = stage(_gathered(docs, units.select("doc_id").distinct(), similar, common), "jaccard-gathered")

    # Every block meets the first one of its unit.
    other = F.explode(F.when(F.col("block") == 0, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block")))
    zero = F.lit(0).cast("long")
    at_first = units.select(
        "doc_id", "unit", zero.alias("i"), other.alias("j"), "block"
    ).select("doc_id", "unit", "i", "j", ((F.col("block") == 0) & (F.col("j") > 0)).cast("int").alias("side"))
    first = stage(_joined(sets, at_first, similar), "jaccard-first-links")

    # What is not joined to most of its unit by then meets all of it.
    wide = units.where("blocks > 1")
    known = components(first).select(F.col("node").alias("doc_id"), "component")
    named = stage(
        wide.join(known, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")), "jaccard-wide-units"
    )
    most = named.groupBy("unit", "component").agg(F.count("*").alias("n")).groupBy("unit").agg(
        F.max(F.struct("n", "component"))["component"].alias("most")
    )
    rest = named.join(most, "unit").where("component <> most").drop("component", "most")
    sizes = classes.groupBy(F.col("rep").alias("doc_id")).agg(F.max("size").alias("size"))
    rest = stage(rest.join(sizes, "doc_id"), "jaccard-rest")
    parts = rest.groupBy("unit").agg(
        F.greatest(F.ceil(F.sum("size") / BLOCK_GRAMS), F.ceil(F.count("*") / BLOCK_SETS)).alias("parts")
    )
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    stored = wide.join(parts, "unit").select("doc_id", "unit", every("parts").alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"))
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), "parts")
    probes = rest.join(parts, "unit").select("doc_id", "unit", part.alias("i"), every("blocks").alias("j"), F.lit(0).alias("side"))
    return first.unionByName(_joined(sets, stored.unionByName(probes), similar))


def _joined(sets: DataFrame, places: DataFrame, similar: Similar) -> DataFrame:
    """Links of the sets at ``places(doc_id, unit, i, j, side)``."""
    group = ["unit", "i", "j"]
    # Places grow with the documents and their stars; only Spark's own limit in bytes may send them.
    listed = places.groupBy("doc_id").agg(F.collect_list(F.struct(*group, "side")).alias("places"))
    placed = sets.join(listed, "doc_id").select("doc_id", "grams", F.inline("places")).select(*group, "side", "doc_id", "grams")
    return _block_links(placed.repartition(*group).sortWithinPartitions(*group), similar)


def _units(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """``doc_id, unit, blocks, block``: where the ends of ``edges(a, b)`` meet, hubs being ``a``.

    Two sets with a common key have a common hub, so both the component of a hub and its star, the
    sets linked to it, hold every pair to be compared. A component is a unit if that moves less than
    its stars do, each cut into as many blocks as it needs.
    """
    sizes = classes.groupBy(F.col("rep").alias("node")).agg(F.max("size").alias("size"))
    members = stage(components(edges).join(sizes, "node"), "jaccard-members")
    stars = stage(
        edges.unionByName(edges.select("a", F.col("a").alias("b"))).distinct().join(
            members.withColumnRenamed("node", "b"), "b"
        ),
        "jaccard-stars",
    )
    blocks = F.greatest(F.ceil(F.sum("size") / BLOCK_GRAMS), F.ceil(F.count("*") / BLOCK_SETS))
    of_star = stage(
        stars.groupBy("a", "component").agg(blocks.alias("blocks"), F.sum("size").alias("grams")), "jaccard-star-sizes"
    )
    of_component = members.groupBy("component").agg(blocks.alias("blocks"), F.sum("size").alias("grams"))
    by_star = of_star.groupBy("component").agg(F.sum(F.col("blocks") * F.col("grams")).alias("moved"))
    whole = stage(
        of_component.join(by_star, "component").select(
            "component", "blocks", (F.col("blocks") * F.col("grams") <= F.col("moved")).alias("whole")
        ),
        "jaccard-component-sizes",
    )
    together = members.join(whole.where("whole"), "component").select(
        F.col("node").alias("doc_id"), F.col("component").alias("unit"), "blocks"
    )
    cut = of_star.join(whole.where("not whole").select("component"), "component").select("a", F.col("blocks"))
    apart = stars.join(cut, "a").select(F.col("b").alias("doc_id"), F.col("a").alias("unit"), "blocks")
    return together.unionByName(apart).withColumn("block", F.pmod(F.xxhash64("doc_id"), "blocks"))
