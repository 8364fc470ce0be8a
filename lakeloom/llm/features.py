"""Hashed term vectors of whole texts."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np

_WINDOW = 1 << 20
_MIX = np.uint32(0x9E3779B1)
_SPREAD = np.uint32(0x85EBCA6B)


_NO_LETTER = np.ones(128, bool)
_NO_LETTER[[*range(65, 91), *range(97, 123)]] = False


def spoken(points: np.ndarray) -> np.ndarray:
    """Code points with each run of ASCII other than letters as one space."""
    other = _NO_LETTER[np.minimum(points, 127)] & (points < 128)
    kept = ~other
    kept[1:] |= other[1:] & ~other[:-1]
    kept[:1] = True
    return np.where(other, np.uint32(32), points)[kept]


def gram_counts(text: str, bits: int, longest: int = 3, letters: bool = False) -> np.ndarray:
    """Counts of the character n-grams of a text, for n of 1 to ``longest``, hashed to ``2**bits``.

    With ``letters`` runs of ASCII other than letters count as a space. A long text is counted in windows, so memory does not grow with it beyond its code points.
    """
    counts = np.zeros(1 << bits, np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = spoken(points) if letters else points
    shift = np.uint32(32 - bits)
    for start in range(0, len(points), _WINDOW):
        window = points[start : start + _WINDOW + longest - 1]
        grams = np.zeros(0, np.uint32)
        for n in range(1, longest + 1):
            # An n-gram belongs to the window that its first character is in.
            size = min(_WINDOW, len(points) - start) - max(0, n - 1 - (len(window) - min(_WINDOW, len(points) - start)))
            if size <= 0:
                break
            last = window[n - 1 : n - 1 + size]
            grams = last * _MIX + np.uint32(1) if n == 1 else (grams[:size] ^ (last * _SPREAD)) * _MIX + np.uint32(n)
            counts += np.bincount(grams >> shift, minlength=len(counts))
    return counts


# What words and lines look like, whatever they say.
SHAPES = ("upper", "again", "symbols", "exclaims", "digits", "same_line", "common", "words")

_SYMBOLS = re.compile(r"[#*$%&|<>]")


def shape_rates(text: str) -> np.ndarray:
    """Rates of the :data:`SHAPES` of a text, each from 0 to 1; zeros for a text without words."""
    words = text.split()
    if not words:
        return np.zeros(len(SHAPES))
    lines = [line for line in text.split("\n") if line.strip()]
    n = len(words)
    upper = sum(map(str.isupper, words)) / n
    again = sum(a == b for a, b in zip(words, words[1:])) / n
    symbols = min(1.0, len(_SYMBOLS.findall(text)) / n)
    exclaims = min(1.0, text.count("!") / n)
    digits = sum(map(str.isdigit, words)) / n
    same_line = 1 - len(set(lines)) / len(lines) if lines else 0.0
    common = Counter(words).most_common(1)[0][1] / n
    return np.array([upper, again, symbols, exclaims, digits, same_line, common, min(1.0, np.log1p(n) / 8)])


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts as TF-IDF vectors of length one; a row of zeros stays zero."""
    vectors = np.log1p(counts.astype(np.float32)) * idf.astype(np.float32)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=vectors, where=norms > 0)


def inverse_frequency(rows: int, frequency: np.ndarray) -> np.ndarray:
    """Smoothed inverse document frequency of each term, found in so many of all rows."""
    return np.log((1 + rows) / (1 + frequency)) + 1
