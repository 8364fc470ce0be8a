"""Document quality by votes of the nearest labelled documents.

Documents are vectors of hashed character n-grams and of what their words and lines look like,
reduced to a latent-semantic space by a truncated singular value decomposition of a labelled sample.
The sample's vectors go to every task, cosines with all of them are computed in blocks, and the
nearest vote with their label, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.features import SHAPES, gram_counts, inverse_frequency, shape_rates, weighted
from lakeloom.llm.language import SCORED_CHARS, document_frequency, held_out, texts_of
from lakeloom.llm.pieces import answers


@dataclass(frozen=True)
class NeighbourFit:
    """``sample`` is the bound on the labelled documents that vote, shared evenly by the labels.
    ``nearest`` of them vote, with the similarity to the power ``sharpness`` as weight; ``shapes``
    is the weight of the shape rates against the n-grams."""

    sample: int = 2000
    nearest: int = 15
    sharpness: int = 4
    dimensions: int = 64
    bits: int = 12
    shapes: float = 1.5
    seed: int = 9


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


class Neighbours:
    """Labelled vectors in the latent space, and the way there."""

    def __init__(
        self, counts: np.ndarray, shapes: np.ndarray, labels: np.ndarray, idf: np.ndarray, fit: NeighbourFit, usual: float = 0.5
    ):
        self.fit, self.labels, self.usual, self.idf = fit, labels.astype(np.float64), usual, idf
        self.space = np.zeros((counts.shape[1] + len(SHAPES), 1), np.float32)
        terms = self._terms(counts, shapes)
        if len(terms):
            self.space = self._decompose(terms)
        self.latent = _unit(terms @ self.space)

    def _terms(self, counts: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        grams = weighted(counts, self.idf)
        return _unit(np.concatenate([grams, self.fit.shapes * shapes.astype(np.float32)], axis=1))

    def _decompose(self, terms: np.ndarray) -> np.ndarray:
        """Right singular vectors of the largest singular values, by subspace iteration."""
        rng = np.random.default_rng(self.fit.seed)
        width = min(self.fit.dimensions + 16, *terms.shape)
        basis = rng.standard_normal((terms.shape[1], width)).astype(np.float32)
        for _ in range(4):
            basis, _ = np.linalg.qr(terms.T @ (terms @ basis))
        _, _, rotated = np.linalg.svd(terms @ basis, full_matrices=False)
        return (basis @ rotated.T)[:, : self.fit.dimensions]

    def score(self, counts: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        """Share of label 1 in the votes, for each row; the usual share of label 1 where nothing votes.

        Neighbours that are equally near at the last place share the votes that are left there.
        """
        if not len(self.labels):
            return np.full(len(counts), self.usual)
        cosines = _unit(self._terms(counts, shapes) @ self.space) @ self.latent.T
        nearest = min(self.fit.nearest, len(self.labels))
        last = -np.partition(-cosines, nearest - 1, axis=1)[:, nearest - 1 : nearest]
        above, tied = cosines > last, cosines == last
        left = (nearest - above.sum(1, keepdims=True)) / np.maximum(tied.sum(1, keepdims=True), 1)
        votes = np.maximum(cosines, 0).astype(np.float64) ** self.fit.sharpness * (above + tied * left)
        total = votes.sum(1)
        share = np.divide(votes @ self.labels, total, out=np.full(len(counts), self.usual), where=total > 0)
        return np.clip(share, 0, 1)


def _features(texts: list[str | None], bits: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.stack([gram_counts(text or "", bits) for text in texts])
    return counts, np.stack([shape_rates(text or "") for text in texts])


def fit_quality(docs: DataFrame, labels: DataFrame, fit: NeighbourFit = NeighbourFit()) -> Neighbours:
    """Learn from ``labels(doc_id, quality)`` of documents that are not held out.

    Labels are counted over all such rows, and in how many texts each n-gram occurs over all documents
    that are not held out; each of 0 and 1 gives about half of the sample, chosen by a hash of its id. Labels other than 0 and 1 and NULLs are left out; of different labels for one
    document the greatest counts. The chosen ids are bounded, so they are sent to the scan of the
    documents, and only vectors of fixed length, at most twice the bound, reach the driver.
    """
    usable = labels.where(~held_out() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    counts = {r["quality"]: r["n"] for r in usable.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    share = fit.sample / 2
    chance = F.lit(0.0)
    for quality, n in counts.items():
        chance = F.when(F.col("quality") == quality, min(1.0, share / n)).otherwise(chance)
    spread = F.pmod(F.xxhash64("doc_id", F.lit(fit.seed)), F.lit(1 << 30)) / F.lit(1 << 30)
    chosen = usable.where(spread < chance).limit(2 * fit.sample)
    sampled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")
    bits = fit.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in answers(batches):
            found, shapes = _features(part.column(1).to_pylist(), bits)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array([c.astype("<u4").tobytes() for c in found], pa.binary()),
                    pa.array([s.astype("<f8").tobytes() for s in shapes], pa.binary()),
                ],
                ["quality", "counts", "shapes"],
            )

    schema = "quality int, counts binary, shapes binary"
    rows = sampled.select(F.col("quality").cast("int"), "text").mapInArrow(run, schema).limit(2 * fit.sample).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["quality"], r["counts"], r["shapes"]))
    empty = (np.zeros((0, 1 << bits), np.uint32), np.zeros((0, len(SHAPES))))
    found = np.stack([np.frombuffer(r["counts"], "<u4") for r in rows]) if rows else empty[0]
    shapes = np.stack([np.frombuffer(r["shapes"], "<f8") for r in rows]) if rows else empty[1]
    usual = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    idf = inverse_frequency(*document_frequency(docs.where(~held_out()), bits))
    return Neighbours(found, shapes, np.array([r["quality"] for r in rows]), idf, fit, usual)


def score_quality(docs: DataFrame, neighbours: Neighbours, block: int = 256) -> DataFrame:
    """All columns of ``docs`` as the struct ``record`` with ``score``, the share of votes for 1.

    Only the text is looked at, whole. A NULL or empty text, or one that no labelled text is near,
    scores the share of label 1 among all learned labels. Rows are independent, so repeated ones score
    alike, and an empty table gives no rows. If nothing could be learned, every score is 0.5.
    """
    model = docs.sparkSession.sparkContext.broadcast(neighbours)
    bits = neighbours.fit.bits
    record = docs.select(F.struct(*docs.columns).alias("record"))
    kind = record.schema["record"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in answers(batches, SCORED_CHARS):
            texts, scores = texts_of(part), []
            for start in range(0, len(texts), block):
                scores += model.value.score(*_features(texts[start : start + block], bits)).tolist()
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], ["record", "score"])

    return record.mapInArrow(run, f"record {kind}, score double")
