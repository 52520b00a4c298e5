"""Vectorised 64-bit hashes of words and of runs of words."""

from __future__ import annotations

import numpy as np

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers (a finaliser of shifts and odd multipliers)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def multipliers(places: np.ndarray) -> np.ndarray:
    """An odd multiplier for each place, of its own however far the place is."""
    return mix((places.astype(U64) + U64(1)) * U64(0xD1342543DE82EF95)) | U64(1)


PLACES = multipliers(np.arange(64))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end and hash of each word of ``data``, words being separated by single spaces."""
    codes = np.frombuffer(data + b" ", np.uint8)
    end = np.flatnonzero(codes == 32)
    first = np.concatenate([[0], end[:-1] + 1])
    place = np.arange(len(codes), dtype=np.int32) - np.repeat(first.astype(np.int32), end + 1 - first)
    far = np.flatnonzero(place > 63)  # words beyond 64 bytes: addresses, and text without spaces
    near = PLACES[np.minimum(place, 63)]
    near[far] = multipliers(place[far])
    del place
    near *= BYTES[codes]
    return first, end, mix(np.add.reduceat(near, first))
