"""64-bit hashes of words and word n-grams, computed over a whole text at once."""

from __future__ import annotations

import numpy as np

# Odd, so that powers have an inverse modulo 2**64.
STEP = 0x9E3779B97F4A7C15 | 1
_UNSTEP = pow(STEP, -1, 1 << 64)

# A random odd value for each byte.
_BYTE = (np.random.default_rng(7).integers(1, 2**63, 256, np.uint64) << np.uint64(1)) | np.uint64(1)


def finish(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each integer over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.empty(count, np.uint64)
    powers[0] = 1
    done = 1
    while done < count:
        more = min(done, count - done)
        powers[done : done + more] = powers[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return powers


class WordHashes:
    """Hashes of the words of a text, from sums over its bytes. Words stand between ASCII white
    space; two different ones agree with a chance of about one in 2**64."""

    def __init__(self, most: int = 1 << 17):
        self._grow(most)

    def _grow(self, most: int) -> None:
        self.most = most
        self.up, self.down = _powers(STEP, most + 1), _powers(_UNSTEP, most + 1)

    def __call__(self, text: bytes) -> np.ndarray:
        data = np.frombuffer(text, np.uint8)
        white = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.flatnonzero(np.diff(white, prepend=True, append=True))
        starts, stops = edge[::2], edge[1::2]
        if len(data) > self.most:
            self._grow(2 * len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * self.up[: len(data)], out=sums[1:])
        return finish((sums[stops] - sums[starts]) * self.down[starts] + (stops - starts).astype(np.uint64))


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of ``width`` word hashes; none if there are fewer words."""
    count = max(0, len(words) - width + 1)
    grams = np.full(count, width, np.uint64)
    for nth in range(width):
        grams = finish(grams * np.uint64(STEP) + words[nth : nth + count])
    return grams
