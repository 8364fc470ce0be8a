"""Repetition within a document by suffix arrays.

The suffixes of a document's words are sorted, and the longest common prefix of each with its
neighbours is the longest repeat that starts at its place. The intervals of common prefixes are the
maximal repeated substrings; the union of their spans and the longest of them are limited.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeloom.llm.hashing import WordHashes, windows
from lakeloom.llm.pieces import answers


@dataclass(frozen=True)
class RepetitionLimits:
    """``shortest``: words of a repeat that counts. A document fails if such repeats cover more than
    the share ``covered`` of its words, or if one is longer than ``longest`` words."""

    shortest: int = 8
    covered: float = 0.5
    longest: int = 50


def suffix_array(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the common prefix of each with the one before (0 for the first).

    Prefix doubling: ranks by the first 2, 4, 8 ... words until all differ. The same ranks, from
    the longest down, then measure the common prefixes.
    """
    n = len(words)
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    levels, width = [rank], 1
    order = np.argsort(rank, kind="stable")
    while n > 1 and rank[order[-1]] < n - 1:
        later = np.full(n, -1, np.int64)
        later[: max(n - width, 0)] = rank[width:]
        both = rank * (n + 1) + later + 1
        order = np.argsort(both, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(both[order]) > 0)])
        levels.append(rank)
        width *= 2
    common = np.zeros(n, np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    for level in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[levels[level][a[inside]] == levels[level][b[inside]]]
        common[1:][same] += 1 << level
        a[same] += 1 << level
        b[same] += 1 << level
    return order, common


def repeats(words: np.ndarray, shortest: int) -> tuple[int, int]:
    """Words covered by repeated substrings of at least ``shortest`` words, and the longest repeat
    (0 if none is that long). Occurrences may overlap, and the first one counts as covered."""
    seen = windows(words, shortest)
    if len(np.unique(seen)) == len(seen):
        return 0, 0
    order, common = suffix_array(words)
    # The longest repeat at a place is what its suffix shares with either neighbour; every maximal
    # repeat that starts there is no longer, so the union of these spans is that of all of them.
    longest = np.zeros(len(words), np.int64)
    longest[order] = np.maximum(common, np.append(common[1:], 0))
    starts = np.flatnonzero(longest >= shortest)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + longest[starts], -1)
    return int((np.cumsum(edges)[:-1] > 0).sum()), int(longest.max())


# The bytes that count as symbols.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


class DocumentRules:
    """The measures of one document: words, characters, symbols, lines and repeats."""

    def __init__(self, limits: RepetitionLimits):
        self.limits, self.hashes = limits, WordHashes()

    def __call__(self, text: str | None) -> tuple:
        raw = (text or "").encode()
        data, words = np.frombuffer(raw, np.uint8), self.hashes(raw)
        n = len(words)
        white = (data == 32) | ((data >= 9) & (data <= 13))
        characters = int(((data & 0xC0) != 0x80).sum() - white.sum())
        lines = [line for line in raw.split(b"\n") if line.strip()]
        threes = windows(words, 3)
        again = np.zeros(n + 1, np.int64)
        if len(threes):
            _, inverse, counts = np.unique(threes, return_inverse=True, return_counts=True)
            starts = np.flatnonzero(counts[inverse] > 1)
            again[starts] += 1
            np.add.at(again, starts + 3, -1)
        repeated = int((np.cumsum(again)[:n] > 0).sum())
        covered, longest = repeats(words, self.limits.shortest)
        failed = n < 50 or 100 * repeated > 50 * n
        kept = not failed and covered <= self.limits.covered * n and longest <= self.limits.longest
        return n, characters, int(_SYMBOL[data].sum()), len(lines) - len(set(lines)), repeated, failed, covered, longest, kept


_COLUMNS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("covered_words", pa.int64()),
    ("longest_repeat", pa.int64()), ("kept", pa.bool_()),
]


def measure_repetition(docs: DataFrame, limits: RepetitionLimits = RepetitionLimits()) -> DataFrame:
    """``doc_id`` with the measures of every whole text and whether it is kept.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, covered_words,
    longest_repeat, kept``. A NULL or empty text has no words and fails. Words stand between ASCII
    white space and are compared by 64-bit hashes. Rows are independent: repeated rows and a NULL
    ``doc_id`` stay, other columns are ignored, an empty table gives no rows. No shuffle.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = DocumentRules(limits)
        for part in answers(batches):
            rows = [rules(text) for text in part.column(1).to_pylist()]
            columns = [pa.array([row[n] for row in rows], of) for n, (_, of) in enumerate(_COLUMNS)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", *[c for c, _ in _COLUMNS]])

    fields = [f"{name} {'boolean' if of == pa.bool_() else 'long'}" for name, of in _COLUMNS]
    return docs.select("doc_id", "text").mapInArrow(run, ", ".join([f"doc_id {kind}", *fields]))
