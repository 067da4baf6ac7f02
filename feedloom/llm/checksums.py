"""CRC-32 of many byte strings at once, and of strings put together from them.

The checksum is linear over the bits: what a byte adds depends on its value and its
distance from the end alone, and a checksum is carried over n further bytes by a
fixed linear map. So the words of a slice are summed by one table lookup a byte and
a running exclusive or, and runs of words follow from the checksums of the words.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np

#: Distances with tables of their own; longer strings take the long way.
NEAR = 64
_POLYNOMIAL = 0xEDB88320


@cache
def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(_POLYNOMIAL) * (table & np.uint32(1)))
    return table


def _over_zero(sums: np.ndarray) -> np.ndarray:
    """The linear map of one further zero byte, without the inversions at both ends."""
    return (sums >> np.uint32(8)) ^ _byte_table()[sums & np.uint32(0xFF)]


def _doubled(tables: np.ndarray) -> np.ndarray:
    """Tables of a map, applied twice."""
    return _mapped(tables, tables.reshape(-1)).reshape(tables.shape)


def _mapped(tables: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """A linear map, given as a table for each byte of its argument."""
    out = tables[0][sums & np.uint32(0xFF)]
    for k in range(1, 4):
        out ^= tables[k][(sums >> np.uint32(8 * k)) & np.uint32(0xFF)]
    return out


@cache
def _shift_tables() -> tuple[np.ndarray, np.ndarray]:
    """Maps over 0 to ``NEAR`` bytes, and over powers of two of bytes."""
    near = np.empty((NEAR + 1, 4, 256), np.uint32)
    for k in range(4):
        near[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, NEAR + 1):
        near[n] = _over_zero(near[n - 1].reshape(-1)).reshape(4, 256)
    powers = [near[1]]
    for _ in range(40):
        powers.append(_doubled(powers[-1]))
    return near, np.stack(powers)


@cache
def _place_table() -> np.ndarray:
    """What a byte adds, by its distance from the end."""
    out = np.empty((NEAR, 256), np.uint32)
    out[0] = _byte_table()
    for n in range(1, NEAR):
        out[n] = _over_zero(out[n - 1])
    return out


def carried(sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The part of a longer string's checksum that its beginning adds, ``sizes`` bytes before its end."""
    near, powers = _shift_tables()
    at = np.minimum(sizes, NEAR) * 1024
    flat = near.reshape(-1)
    out = flat[at + (sums & np.uint32(0xFF))]
    for k in range(1, 4):
        out ^= flat[at + 256 * k + ((sums >> np.uint32(8 * k)) & np.uint32(0xFF))]
    far = np.flatnonzero(sizes > NEAR)
    left, values = sizes[far].copy(), sums[far]
    for k in range(int(left.max(initial=0)).bit_length()):
        odd = (left >> k) & 1 == 1
        values[odd] = _mapped(powers[k], values[odd])
    out[far] = values
    return out


def joined(first: np.ndarray, second: np.ndarray, second_sizes: np.ndarray) -> np.ndarray:
    """Checksums of strings followed by others."""
    return carried(first, second_sizes) ^ second


def of_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Checksums of ascending, disjoint spans of a byte buffer."""
    sizes = end - start
    out = np.zeros(len(start), np.uint32)
    near = np.flatnonzero((sizes > 0) & (sizes <= NEAR))
    if len(near):
        n, last = sizes[near], np.cumsum(sizes[near])
        first = last - n
        place = np.arange(last[-1]) - np.repeat(first, n)
        away = np.repeat(n, n) - 1 - place
        added = _place_table().reshape(-1)[away * 256 + data[np.repeat(start[near], n) + place]]
        running = np.bitwise_xor.accumulate(added)
        before = np.where(first > 0, running[first - 1], np.uint32(0))
        ones = np.full(len(n), 0xFFFFFFFF, np.uint32)
        out[near] = running[last - 1] ^ before ^ carried(ones, n) ^ ones
    for k in np.flatnonzero(sizes > NEAR):
        out[k] = zlib.crc32(data[start[k] : end[k]])
    return out
