"""Language identification by nearest centroids.

A text is the TF-IDF vector of its hashed character n-grams. Each language has several centroids,
from clustering a sample of its texts; the nearest by cosine names the language, and a text that is
further from it than its own texts with as many different n-grams is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.features import gram_counts, inverse_frequency, weighted
from lakeloom.llm.pieces import answers
from lakeloom.sources.staging import stage

UNDETERMINED = "und"

#: Characters of text that are scored at a time; each text takes a vector of fixed length besides.
SCORED_CHARS = 1_000_000

_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class LanguageFit:
    """``sample`` is the bound on the labelled texts that the centroids are made of, shared evenly by the
    languages, of which each gives one at least; everything else is counted over all rows. A text is
    rejected if its cosine is more than the share ``room`` below the ``outliers`` quantile of its centroid's
    own texts, of ``least_cosines`` or more; with fewer, those of the language and then of all count."""

    sample: int = 2000
    centroids: int = 4
    bits: int = 12
    outliers: float = 0.01
    room: float = 0.25
    least_cosines: int = 50
    seed: int = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is a multiple of 5; rows without an id are never learned."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def _classes(counts: np.ndarray) -> np.ndarray:
    """Half octaves of the different n-grams of a text; its cosine with any centroid grows with them."""
    return (2 * np.log2(np.maximum((counts > 0).sum(1), 1))).astype(int)


class Centroids:
    """Unit centroids with their language and, for each class of texts, the least cosine that they
    accept, 0 until :meth:`limit` is told how near learned texts come."""

    def __init__(self, counts: np.ndarray, languages: np.ndarray, idf: np.ndarray, fit: LanguageFit):
        self.fit, self.bits, self.idf = fit, fit.bits, idf
        vectors, rng = weighted(counts, self.idf), np.random.default_rng(fit.seed)
        names, units, sums, self.places = [], [], [], {}
        for language in sorted(set(languages.tolist())):
            own = vectors[languages == language]
            found = self._cluster(own, min(fit.centroids, len(own)), rng)
            used, nearest = np.unique((own @ found.T).argmax(1), return_inverse=True)
            self.places[language] = slice(len(names), len(names) + len(used))
            names += [language] * len(used)
            units += list(found[used])
            sums += [own[nearest == n].sum(0) for n in range(len(used))]
        self.names, self.units, self.sums = names, np.array(units), np.array(sums)
        self.least = np.zeros((len(names), 2 * self.bits + 1))

    def nearness(self, language: str, text: str) -> np.ndarray:
        """(centroid, class, cosine) of a learned text and of its starts that hold a letter, of one
        character and twice as many each time, held against the centroids as they would be without it."""
        own = self.places[language]
        counts = [gram_counts(text, self.bits, letters=True)]
        size = 1
        while size < len(text):
            if _LETTER.search(text[:size]):
                counts.append(gram_counts(text[:size], self.bits, letters=True))
            size *= 2
        parts = np.stack(counts)
        vector, others = weighted(parts[:1], self.idf)[0], self.units[own].copy()
        nearest = (others @ vector).argmax()
        rest = self.sums[own][nearest] - vector
        norm = float(np.linalg.norm(rest))
        others[nearest] = rest / norm if norm > 1e-4 else 0
        if not others.any():
            return np.zeros((0, 3))
        cosines = weighted(parts, self.idf) @ others.T
        return np.stack([own.start + cosines.argmax(1), _classes(parts), cosines.max(1)], 1)

    def limit(self, seen: np.ndarray) -> None:
        """Take the limits from rows of :meth:`nearness`."""
        self.least = self._limits(seen)

    def _limits(self, seen: np.ndarray) -> np.ndarray:
        """Least cosine by centroid and class, from rows of (centroid, class, cosine)."""
        languages = np.array(self.names, object)
        limits = np.zeros((len(self.names), 2 * self.bits + 1))
        for n, name in enumerate(self.names):
            same = languages[seen[:, 0].astype(int)] == name
            for c in range(limits.shape[1]):
                here = seen[:, 1] == c
                choices = (here & (seen[:, 0] == n), here & same, here)
                found = next((seen[rows, 2] for rows in choices if rows.sum() >= self.fit.least_cosines), None)
                if found is not None:
                    limits[n, c] = (1 - self.fit.room) * float(np.quantile(found, self.fit.outliers))
                elif c:
                    # Texts with more n-grams come nearer, so this is not too strict.
                    limits[n, c] = limits[n, c - 1]
        return limits

    @staticmethod
    def _cluster(vectors: np.ndarray, count: int, rng, rounds: int = 10) -> np.ndarray:
        centres = vectors[rng.choice(len(vectors), count, replace=False)].copy()
        for _ in range(rounds):
            nearest = (vectors @ centres.T).argmax(1)
            for n in np.unique(nearest):
                mean = vectors[nearest == n].mean(0)
                centres[n] = mean / max(float(np.linalg.norm(mean)), 1e-12)
        return centres

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, cosine and whether the text is rejected, for each text; of equally near centroids
        the first counts, by language."""
        known = [n for n, text in enumerate(texts) if text and _LETTER.search(text)]
        languages, scores, rejected = [UNDETERMINED] * len(texts), [0.0] * len(texts), [True] * len(texts)
        if known and self.names:
            counts = np.stack([gram_counts(texts[n].lower(), self.bits, letters=True) for n in known])
            cosines = weighted(counts, self.idf) @ self.units.T
            for n, best, kind, row in zip(known, cosines.argmax(1).tolist(), _classes(counts).tolist(), cosines):
                languages[n] = self.names[best]
                scores[n] = float(min(1.0, max(0.0, row[best])))
                rejected[n] = bool(row[best] < self.least[best, kind])
        return languages, scores, rejected


def document_frequency(texts: DataFrame, bits: int, letters: bool = False) -> tuple[int, np.ndarray]:
    """Rows of ``texts(text)`` that are not NULL, and in how many of them each hashed n-gram occurs.

    Each task sends one number for each n-gram hash; what reaches the driver has a fixed length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 + (1 << bits), np.int64)
        for part in answers(batches):
            for text in part.column(0).to_pylist():
                if text is not None:
                    found[0] += 1
                    found[1:] += gram_counts(text.lower() if letters else text, bits, letters=letters) > 0
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(found[used])], ["place", "n"])

    total = np.zeros(1 + (1 << bits), np.int64)
    for row in texts.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        total[row.place] = row.n
    return int(total[0]), total[1:]


def fit_languages(docs: DataFrame, fit: LanguageFit = LanguageFit()) -> Centroids:
    """Learn from text and non-NULL ``lang`` of the rows that are not held out.

    Languages and in how many texts each n-gram occurs are counted over all such rows. Then each language
    gives about its share of the sample, chosen by a hash, and at least the text with the least hash. Only
    n-gram counts of the sample, a vector of fixed length for each text, reach the driver, and then how
    near these texts and their starts come to the centroids, for which the tasks read them again, whole.
    """
    train = docs.select("doc_id", "text", "lang").where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    spread = F.pmod(F.xxhash64("doc_id", "text", F.lit(fit.seed)), F.lit(1 << 30)) / F.lit(1 << 30)
    spread_out = train.select("lang", "text", spread.alias("spread"))
    # One row for each language, as the model has.
    languages = stage(spread_out.groupBy("lang").agg(F.count("*").alias("n"), F.min("spread").alias("least")), "languages")
    share = fit.sample / max(languages.count(), 1)
    taken = (F.col("spread") * F.col("n") < share) | (F.col("spread") <= F.col("least"))
    sampled = spread_out.join(F.broadcast(languages), "lang").where(taken).select("lang", "text").distinct()
    sampled = stage(sampled, "language-sample")
    bits = fit.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in answers(batches):
            counted = [gram_counts(t.lower(), bits, letters=True).astype("<u4").tobytes() for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counted, pa.binary())], ["lang", "counts"])

    table = sampled.mapInArrow(count, "lang string, counts binary").toArrow().to_pylist()
    # A fixed order, so that the clusters do not depend on how the rows arrive.
    table.sort(key=lambda r: (r["lang"], r["counts"]))
    counts = np.stack([np.frombuffer(r["counts"], "<u4") for r in table]) if table else np.zeros((0, 1 << bits), np.uint32)
    rows, frequency = document_frequency(train, bits, letters=True)
    centroids = Centroids(counts, np.array([r["lang"] for r in table], object), inverse_frequency(rows, frequency), fit)
    model = docs.sparkSession.sparkContext.broadcast(centroids)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in answers(batches):
            pairs = zip(part.column(0).to_pylist(), part.column(1).to_pylist())
            seen = np.concatenate([np.zeros((0, 3)), *[model.value.nearness(lang, text.lower()) for lang, text in pairs]])
            yield pa.RecordBatch.from_arrays([pa.array(seen[:, n]) for n in range(3)], ["centroid", "class", "cosine"])

    seen = sampled.mapInArrow(near, "centroid double, class double, cosine double").toArrow()
    centroids.limit(np.stack([seen[name].to_numpy() for name in ("centroid", "class", "cosine")], 1).reshape(-1, 3))
    return centroids


def texts_of(records: pa.RecordBatch) -> list[str | None]:
    """The texts of a batch of records."""
    return records.column(0).field("text").to_pylist()


def identify(docs: DataFrame, centroids: Centroids) -> DataFrame:
    """All columns of ``docs`` as the struct ``record`` with ``lang_pred, score, rejected``.

    Only the text is looked at, whole. NULL texts and texts without a letter are ``und`` with score
    0 and rejected; others get the nearest learned language, rejected or not, and the cosine as
    score. Rows are independent, and an empty table gives no rows. If nothing could be learned,
    every text is ``und``.
    """
    model = docs.sparkSession.sparkContext.broadcast(centroids)
    record = docs.select(F.struct(*docs.columns).alias("record"))
    kind = record.schema["record"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in answers(batches, SCORED_CHARS):
            languages, scores, rejected = model.value.predict(texts_of(part))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["record", "lang_pred", "score", "rejected"],
            )

    return record.mapInArrow(run, f"record {kind}, lang_pred string, score double, rejected boolean")
