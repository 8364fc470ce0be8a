"""CRC-32 of parts of a byte stream, from the CRCs of its prefixes.

CRC-32 is linear over GF(2): the CRC of a prefix that is ``n`` bytes longer is the shorter one's,
shifted by ``n`` zero bytes, plus (xor) that of the bytes between. So two prefixes give the CRC of
what lies between them, without reading it again.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np

# What one byte adds to the register, from the library's own CRC of that byte.
_BYTE = np.array([crc32(bytes([b ^ 0xFF])) ^ 0xFF000000 for b in range(256)], np.uint32)


def pushed(crcs: np.ndarray, byte: int) -> np.ndarray:
    """Each CRC as it is one byte later."""
    register = crcs ^ np.uint32(0xFFFFFFFF)
    return _BYTE[(register ^ np.uint32(byte)) & np.uint32(0xFF)] ^ (register >> np.uint32(8)) ^ np.uint32(0xFFFFFFFF)


class _Shifts:
    """Shifts by 1, 2, 4, ... zero bytes, each as four tables, one for each byte of the register."""

    def __init__(self):
        one = np.arange(32, dtype=np.uint32)
        column = np.uint32(1) << one
        self.tables = [self._tables(_BYTE[column & np.uint32(0xFF)] ^ (column >> np.uint32(8)))]

    @staticmethod
    def _tables(columns: np.ndarray) -> np.ndarray:
        """From where each bit goes to where each byte goes."""
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1 == 1
        parts = columns.reshape(4, 8)
        return np.stack([np.bitwise_xor.reduce(np.where(bits, part, np.uint32(0)), axis=1) for part in parts])

    @staticmethod
    def _through(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
        out = tables[0][crcs & np.uint32(0xFF)]
        for nth in (1, 2, 3):
            out ^= tables[nth][(crcs >> np.uint32(8 * nth)) & np.uint32(0xFF)]
        return out

    def __call__(self, crcs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Each CRC shifted by its own count of zero bytes."""
        most = int(counts.max(initial=0))
        for nth in range(most.bit_length()):
            if nth == len(self.tables):
                half = self.tables[-1]
                columns = np.uint32(1) << np.arange(32, dtype=np.uint32)
                self.tables.append(self._tables(self._through(half, self._through(half, columns))))
            moved = self._through(self.tables[nth], crcs)
            crcs = np.where((counts >> nth) & 1 == 1, moved, crcs)
        return crcs


shifted = _Shifts()


def between(shorter: np.ndarray, longer: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """CRC-32 of the ``counts`` bytes by which the prefix of ``longer`` exceeds that of ``shorter``."""
    return longer ^ shifted(shorter, counts)
