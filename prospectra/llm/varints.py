"""Arrays of small whole numbers as compressed bytes: seven bits a byte, the high bit marks that more follow."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(numbers: np.ndarray) -> bytes:
    """Non-negative numbers below 2**35."""
    numbers = numbers.astype(np.int64)
    width = np.ones(len(numbers), np.int64)
    for bits in (7, 14, 21, 28):
        width += numbers >= 1 << bits
    start = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), np.uint8)
    for k in range(5):
        longer = np.flatnonzero(width > k)
        if not len(longer):
            break
        more = np.where(width[longer] > k + 1, 128, 0)
        out[start[longer] + k] = (numbers[longer] >> (7 * k)) & 127 | more
    return zstandard.ZstdCompressor(3).compress(out.tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    if not len(raw):
        return np.empty(0, np.int64)
    start = np.flatnonzero(np.concatenate([[True], raw[:-1] < 128]))
    place = np.arange(len(raw)) - np.repeat(start, np.diff(np.append(start, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), start)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
