"""Compressed bitmaps over non-negative positions.

Positions are cut into containers of 2^16. A container is kept in whichever of
three forms is smallest: a sorted array of 16-bit values, a bitset of 8 KiB, or
a list of runs. Set operations work container by container.
"""

from __future__ import annotations

import numpy as np

ARRAY, BITS, RUNS = 0, 1, 2
_SPAN = 1 << 16

Container = tuple[int, np.ndarray]
Bitmap = dict[int, Container]


def _pack(low: np.ndarray) -> Container:
    """``low``: sorted distinct values below 2^16."""
    cuts = np.flatnonzero(np.diff(low) != 1)
    n_runs = len(cuts) + 1
    if 4 * n_runs < min(2 * len(low), _SPAN // 8):
        starts = low[np.concatenate(([0], cuts + 1))]
        ends = low[np.concatenate((cuts, [len(low) - 1]))]
        return RUNS, np.stack([starts, ends]).astype(np.uint16)
    if 2 * len(low) <= _SPAN // 8:
        return ARRAY, low.astype(np.uint16)
    bits = np.zeros(_SPAN, dtype=bool)
    bits[low] = True
    return BITS, np.packbits(bits)


def compress(positions: np.ndarray) -> Bitmap:
    positions = np.unique(np.asarray(positions, dtype=np.int64))
    if not len(positions):
        return {}
    high = positions >> 16
    heads, starts = np.unique(high, return_index=True)
    return {int(h): _pack(part & 0xFFFF) for h, part in zip(heads, np.split(positions, starts[1:]))}


def _bits(c: Container | None) -> np.ndarray:
    """The container as 8 KiB of bits."""
    if c is None:
        return np.zeros(_SPAN // 8, dtype=np.uint8)
    form, data = c
    if form == BITS:
        return data
    if form == ARRAY:
        bits = np.zeros(_SPAN, dtype=bool)
        bits[data] = True
    else:
        edge = np.zeros(_SPAN + 1, dtype=np.int8)
        edge[data[0]] += 1
        np.subtract.at(edge, data[1].astype(np.int64) + 1, 1)
        bits = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    return np.packbits(bits)


def _positions(high: int, bits: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits)).astype(np.int64) + (high << 16)


def positions(b: Bitmap) -> np.ndarray:
    return np.concatenate([_positions(h, _bits(b[h])) for h in sorted(b)] or [np.empty(0, dtype=np.int64)])


def and_not(a: Bitmap, b: Bitmap) -> np.ndarray:
    """Positions in ``a`` that are not in ``b``, ascending."""
    return np.concatenate([_positions(h, _bits(a[h]) & ~_bits(b.get(h))) for h in sorted(a)] or [np.empty(0, dtype=np.int64)])


def intersect(a: Bitmap, b: Bitmap) -> np.ndarray:
    """Positions in both, ascending."""
    return np.concatenate([_positions(h, _bits(a[h]) & _bits(b[h])) for h in sorted(a.keys() & b.keys())] or [np.empty(0, dtype=np.int64)])


def n_bytes(b: Bitmap) -> int:
    return sum(data.nbytes for _, data in b.values())
