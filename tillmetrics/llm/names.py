"""Names of byte strings by prefix doubling, vectorised over a buffer of many texts.

The name of the 2k bytes at a position is made of the names of the k bytes there and of those k
further on. Names of up to 8 bytes are the bytes themselves; longer ones are 64-bit hashes of a
pair of names, so that texts in different tasks get equal names for equal strings.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
A, B, C = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names for pairs of names; the order counts."""
    x = b * B
    x ^= x >> U(29)
    x += a
    x *= A
    x ^= x >> U(32)
    x *= C
    x ^= x >> U(29)
    return x


def doubled(buffer: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """Names of the 8, 16, 32, ... bytes at each position, as far as the buffer goes."""
    one = buffer.astype(U)
    two = one[:-1] | one[1:] << U(8)
    four = two[:-2] | two[2:] << U(16)
    names, k = {8: four[:-4] | four[4:] << U(32)}, 8
    while 2 * k <= longest and len(names[k]) > k:
        names[2 * k] = pair(names[k][:-k], names[k][k:])
        k *= 2
    return names


def of_length(names: dict[int, np.ndarray], size: int) -> np.ndarray:
    """Names of `size` bytes: of the longest doubling and the one that ends where they end."""
    k = max(x for x in names if x <= size)
    return pair(names[k][: len(names[k]) - (size - k)], names[k][size - k :])


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of each `size` neighbours."""
    k = 1
    while 2 * k <= size:
        values = np.minimum(values[:-k], values[k:])
        k *= 2
    return np.minimum(values[: len(values) - (size - k)], values[size - k :]) if size > k else values
