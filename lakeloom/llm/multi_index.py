"""Near-duplicate vectors by an inverted multi-index.

Each half of a unit vector has a codebook of its own, and the two codebooks make a grid of cells. A
vector lives in the cell of its nearest code words. It visits cells in the order of how far it lies
beyond their borders, both halves taken together (the multi-sequence order), until the share of
partners to be found is reached, and is compared there in double precision with all that live there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.graphs import components, forest
from lakeloom.sources.staging import stage


@dataclass(frozen=True)
class Index:
    """``sample`` vectors at most fit the codebooks; every vector is indexed. A cell is meant to
    hold ``cell`` vectors, by codebooks of ``fewest`` to ``most`` words; ``recall`` is the share of
    partners at exactly the threshold that the visited cells are to hold, from one side alone; with a
    recall of 1 cells are visited as far as any partner can lie, which misses none."""

    threshold: float = 0.98
    recall: float = 0.999
    sample: int = 20_000
    cell: int = 1000
    fewest: int = 4
    most: int = 1024
    seed: int = 5

    def words(self, rows: int) -> int:
        return min(self.most, max(self.fewest, math.ceil(math.sqrt(rows / self.cell))))


#: Partners made to see how far a visit must go.
CALIBRATED = 4000

#: A task compares up to so many visitors with so many residents of a cell.
VISITORS, RESIDENTS = 8192, 2048


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    # Halved exponents keep very large and very small vectors from overflowing in the norm.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ words.T + (words * words).sum(1), 0)


class Codebooks:
    """Code words for the halves of vectors of one length, and how far a visit goes."""

    def __init__(self, units: np.ndarray, words: int, index: Index):
        rng = np.random.default_rng(index.seed)
        self.half = units.shape[1] // 2
        self.words = [self._fit(half, words, rng) for half in self._halves(units)]
        self.apart = [np.sqrt(_distances(w, w)) for w in self.words]
        self.reach = self._calibrate(units, index, rng)

    def _halves(self, units: np.ndarray) -> list[np.ndarray]:
        return [units[:, : self.half], units[:, self.half :]]

    @staticmethod
    def _fit(half: np.ndarray, words: int, rng, rounds: int = 8) -> np.ndarray:
        chosen = half[rng.choice(len(half), min(words, len(half)), replace=False)].copy()
        for _ in range(rounds):
            nearest = _distances(half, chosen).argmin(1)
            for n in np.unique(nearest):
                chosen[n] = half[nearest == n].mean(0)
        return chosen

    def _beyond(self, units: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Home words of each half, and the squared distances past the border of each word."""
        homes, beyond = [], []
        for half, words, apart in zip(self._halves(units), self.words, self.apart):
            away = _distances(half, words)
            home = away.argmin(1)
            rows = np.arange(len(units))
            gap = (away - away[rows, home][:, None]) / np.maximum(2 * apart[home], 1e-12)
            gap[rows, home] = 0
            homes.append(home)
            beyond.append(gap * gap)
        return np.stack(homes, 1), beyond

    def _calibrate(self, units: np.ndarray, index: Index, rng) -> float:
        """The visit that holds ``recall`` of partners at the threshold in random directions.

        No partner lies further past a border than its whole distance, so that is the most.
        """
        if index.recall >= 1:
            return 2 - 2 * index.threshold + 1e-9
        # A small sample is used over and over, each time with other directions.
        x = units[np.arange(CALIBRATED) % len(units)]
        aside = rng.standard_normal(x.shape)
        aside -= (aside * x).sum(1)[:, None] * x
        norms = np.linalg.norm(aside, axis=1)[:, None]
        aside = np.divide(aside, norms, out=np.zeros_like(aside), where=norms > 1e-9)
        partner = index.threshold * x + math.sqrt(1 - index.threshold**2) * aside
        homes, _ = self._beyond(partner)
        _, (first, second) = self._beyond(x)
        rows = np.arange(len(x))
        needed = first[rows, homes[:, 0]] + second[rows, homes[:, 1]]
        return min(float(np.quantile(needed, index.recall)), 2 - 2 * index.threshold) + 1e-9

    def cells(self, units: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Home cell of each vector and the cells it visits, nearest first."""
        homes, (first, second) = self._beyond(units)
        width, visits = len(self.words[1]), []
        for a, b in zip(first, second):
            order_a, order_b = np.argsort(a), np.argsort(b)
            rows = order_a[: np.searchsorted(a[order_a], self.reach, "right")]
            counts = np.searchsorted(b[order_b], self.reach - a[rows], "right")
            found = np.concatenate([row * width + order_b[:count] for row, count in zip(rows, counts)])
            nearness = np.concatenate([a[row] + b[order_b[:count]] for row, count in zip(rows, counts)])
            visits.append(found[np.argsort(nearness, kind="stable")])
        return homes[:, 0] * width + homes[:, 1], visits


def _fit(classes: DataFrame, rows: int, index: Index) -> dict[int, Codebooks]:
    """Codebooks by vector length, from a bounded sample chosen by the hash of its id."""
    sampled = classes.orderBy(F.xxhash64("rep"), "rep").limit(index.sample).select("embedding").toArrow()
    vectors = sampled["embedding"].to_pylist()
    by_length: dict[int, list] = {}
    for vector in vectors:
        by_length.setdefault(len(vector), []).append(vector)
    words = index.words(rows)
    return {n: Codebooks(_units(np.array(v)), words, index) for n, v in by_length.items()}


def _indexed(classes: DataFrame, books) -> DataFrame:
    """Adds ``cell`` and ``visits``; vectors of a length that the sample lacks share one cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2).to_pylist()
            cells, visits = np.zeros(len(vectors), np.int64), [np.zeros(1, np.int64)] * len(vectors)
            lengths = np.array([len(v) for v in vectors])
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                if int(length) in books.value:
                    homes, found = books.value[int(length)].cells(_units(np.array([vectors[r] for r in rows])))
                    cells[rows] = homes
                    for row, visited in zip(rows, found):
                        visits[row] = visited
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells), pa.array([v.tolist() for v in visits], pa.list_(pa.int64()))],
                [*batch.schema.names, "cell", "visits"],
            )

    schema = f"rep long, label {dict(classes.dtypes)['label']}, embedding array<double>, copies long, length int, cell long, visits array<long>"
    return classes.mapInArrow(run, schema)


class _Cell:
    """Compares the visitors of a cell, or of a block of it, with its residents."""

    def __init__(self, books, threshold: float):
        self.books, self.threshold = books, threshold

    def __call__(self, length: int, cell: int, rows: list[tuple]) -> tuple[list, list, list]:
        """(node, links, joined): links found for each node, and a forest of what they join."""
        ids = np.array([r[0] for r in rows])
        copies = np.array([r[1] for r in rows])
        homes = np.array([r[2] for r in rows])
        roles = np.array([r[3] for r in rows])
        units = _units(np.array([r[4] for r in rows]))
        residents, visitors = np.flatnonzero(roles == 0), np.flatnonzero(roles == 1)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start in range(0, len(visitors), 1024):
            some = visitors[start : start + 1024]
            i, j = np.nonzero(units[some] @ units[residents].T >= self.threshold)
            a.append(some[i])
            b.append(residents[j])
        a, b = np.concatenate(a), np.concatenate(b)
        apart = ids[a] != ids[b]
        a, b = a[apart], b[apart]
        counts = np.zeros(len(rows), np.int64)
        np.add.at(counts, a, copies[b])
        # The resident finds the visitor itself if it visits the visitor's home; else it is told.
        away = np.flatnonzero(homes[a] != cell)
        if len(away):
            told = np.unique(b[away])
            visits = dict(zip(told.tolist(), map(set, (v.tolist() for v in self.books.value[length].cells(units[told])[1]))))
            alone = away[[homes[a[n]] not in visits[b[n]] for n in away]]
            np.add.at(counts, b[alone], copies[a[alone]])
        distinct, of = np.unique(ids, return_inverse=True)
        root = forest(len(distinct), of[a], of[b])
        totals = np.bincount(of, weights=counts, minlength=len(distinct)).astype(np.int64)
        keep = np.flatnonzero((totals > 0) | (root != np.arange(len(distinct))))
        return distinct[keep].tolist(), totals[keep].tolist(), distinct[root[keep]].tolist()


def _compare(indexed: DataFrame, books, index: Index) -> DataFrame:
    """``node, links, joined`` from every cell."""
    at = ["label", "length", "cell"]
    resident = indexed.select("rep", "copies", F.col("cell").alias("home"), "embedding", *at)
    visitor = indexed.select(
        "rep", "copies", F.col("cell").alias("home"), "embedding", "label", "length", F.explode("visits").alias("cell")
    )
    # Only cells that are too large for one task are listed; their number is bounded by the rows
    # over a block's size, and the list is broadcast by Spark only if it is small.
    live = indexed.groupBy(*at).agg(F.count("*").alias("residents"))
    come = indexed.select("label", "length", F.explode("visits").alias("cell")).groupBy(*at).agg(F.count("*").alias("visitors"))
    large = stage(
        live.join(come, at).where((F.col("residents") > RESIDENTS) | (F.col("visitors") > VISITORS)).select(
            *at,
            F.ceil(F.col("residents") / RESIDENTS).alias("resident_blocks"),
            F.ceil(F.col("visitors") / VISITORS).alias("visitor_blocks"),
        ),
        "large-cells",
    )

    def blocked(rows: DataFrame, role: int) -> DataFrame:
        one = F.lit(1).cast("long")
        sized = rows.join(large, at, "left").withColumns(
            {c: F.coalesce(c, one) for c in ("resident_blocks", "visitor_blocks")}
        )
        own = F.xxhash64("rep")
        every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
        if role == 0:
            sized = sized.withColumn("rb", F.pmod(own, "resident_blocks")).withColumn("vb", every("visitor_blocks"))
        else:
            sized = sized.withColumn("vb", F.pmod(own, "visitor_blocks")).withColumn("rb", every("resident_blocks"))
        return sized.select(*at, "rb", "vb", "rep", "copies", "home", F.lit(role).alias("role"), "embedding")

    group = [*at, "rb", "vb"]
    rows = blocked(resident, 0).unionByName(blocked(visitor, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare, key, held = _Cell(books, index.threshold), None, []

        def answer() -> pa.RecordBatch:
            columns = compare(key[1], key[2], held)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "joined"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                if row[:5] != key:
                    if held:
                        yield answer()
                    key, held = row[:5], []
                held.append(row[5:])
        if held:
            yield answer()

    return rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, "node long, links long, joined long")


def near_duplicates(vectors: DataFrame, index: Index = Index()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding, label)``.

    Two rows link if their labels are equal and not NULL and their cosine, in double precision, is at
    least the threshold. Vectors that are NULL, empty, zero or hold NULL or non-finite components,
    vectors of different lengths and rows with a NULL label or ``vec_id`` link with nothing; a NULL
    ``vec_id`` has a NULL component. ``n_links`` counts all directly linked rows, copies included.
    Rows with one ``vec_id`` are one node, and each has the links of all of them. Other columns are ignored; an empty table gives no rows.

    Equal vectors of a label are collapsed to a class first and counted with it. A cell that holds
    or draws too many for a task is cut into blocks of residents and of visitors, and every pair of
    these is a task of its own. Tasks return counts and a spanning forest, not the pairs.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where("vec_id is not null and label is not null and size(embedding) > 0").where(
        finite & F.exists("embedding", lambda x: x != 0)
    )
    # Numbered when written: one vec_id may be the smallest of several classes.
    classes = stage(
        usable.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("class", F.monotonically_increasing_id()),
        "vector-classes",
    )
    count = classes.count()
    if not count:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    books = spark.sparkContext.broadcast(_fit(classes, count, index))
    sized = classes.select(F.col("class").alias("rep"), "label", "embedding", "copies", F.size("embedding").alias("length"))
    indexed = stage(_indexed(sized, books), "vector-cells")
    found = stage(_compare(indexed, books, index), "vector-links")

    copied = stage(classes.where("copies > 1"), "vector-copies")
    single = classes.where("copies = 1").select(F.col("rep").alias("vec_id"), "rep", "class", "copies")
    members = usable.join(copied, ["label", "embedding"]).select("vec_id", "rep", "class", "copies").unionByName(single)
    of_class = members.where("vec_id <> rep").select(F.col("rep").alias("a"), F.col("vec_id").alias("b"))
    names = classes.select("class", "rep")
    links = (
        found.where("node <> joined")
        .join(names.select(F.col("class").alias("node"), F.col("rep").alias("b")), "node")
        .join(names.select(F.col("class").alias("joined"), F.col("rep").alias("a")), "joined")
        .select("a", "b")
    )
    joined = components(links.unionByName(of_class))

    direct = found.groupBy(F.col("node").alias("class")).agg(F.sum("links").alias("links"))
    own = members.select("vec_id", "class", "copies").distinct().join(direct, "class", "left")
    counted = own.groupBy("vec_id").agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    component = joined.select(F.col("node").alias("vec_id"), "component")
    return (
        rows.select("vec_id").join(counted, "vec_id", "left")
        .join(component, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            F.col("vec_id").eqNullSafe(F.coalesce("component", "vec_id")).alias("kept"),
        )
    )
