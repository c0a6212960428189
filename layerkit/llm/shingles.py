"""Hashed word shingles of whole texts, computed over Arrow buffers.

Words are the runs between spaces, with A-Z in lower case. A word's hash is a
polynomial over its bytes, read off running sums, so no text is split into
Python strings. Hashes have 64 bits; two different shingles of a document pair
share one with a chance near 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
_ONE = np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = mix((np.arange(256, dtype=np.uint64) + _ONE) * _STEP)
_BASE = 0xD1342543DE82EF95
_BACK = pow(_BASE, -1, 1 << 64)
_PLACE = mix((np.arange(64, dtype=np.uint64) + np.uint64(1000)) * _STEP) | _ONE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, dtype=bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, size: int) -> np.ndarray:
    held = _powers.get(name)
    if held is None or len(held) < size:
        held = np.full(max(size, 2 * CHUNK_BYTES), base, dtype=np.uint64)
        held[0] = _ONE
        _powers[name] = held = np.cumprod(held, dtype=np.uint64)
    return held[:size]


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, row offsets)`` of runs of whole texts, about ``CHUNK_BYTES`` each."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _GAP) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin; ``gap`` flags the bytes between."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~gap[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    opens[edges] = inside[edges]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    ends = offsets[1:-1]
    ends = ends[(ends > 0) & (ends < len(data))] - 1
    closes[ends] = inside[ends]
    starts, stops = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data]] * _power("up", _BASE, len(data)), out=sums[1:])
    hashes = (sums[stops] - sums[starts]) * _power("down", _BACK, len(data))[starts]
    return mix(hashes + (stops - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingles)``; fewer words than ``width`` make one shingle, none make none."""
    for first, data, offsets in text_chunks(texts):
        hashes, begin = words(data, offsets)
        joined = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
        for place in range(width):
            joined += hashes[place : place + len(joined)] * _PLACE[place]
        joined = mix(joined)
        for row in range(len(offsets) - 1):
            low, high = begin[row], begin[row + 1]
            if high - low >= width:
                found = np.sort(joined[low : high - width + 1])
                keep = np.ones(len(found), bool)
                np.not_equal(found[1:], found[:-1], out=keep[1:])
                yield first + row, found[keep]
            elif high > low:
                # Another final step, so a short text never equals a full shingle.
                short = (hashes[low:high] * _PLACE[width : width + high - low]).sum(dtype=np.uint64, keepdims=True)
                yield first + row, mix(mix(short) + np.uint64(high - low))
            else:
                yield first + row, np.zeros(0, np.uint64)
