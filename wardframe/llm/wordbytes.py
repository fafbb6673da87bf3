"""Words of many texts at once, as places in one array of bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
_ASCII_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Words beyond this many bytes are hashed one by one.
LONG_WORD = 4096
# The hash of no bytes, which no word has.
NO_WORD = np.uint64(0x27D4EB2F165667C5)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts one after the other, with 8 bytes of padding, and where each begins and ends."""
    plain = pc.fill_null(texts, "").cast(pa.large_binary())
    if len(plain) == 0:
        return np.full(8, 32, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = plain.buffers()[2]
    raw = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return np.concatenate([raw[offsets[0] : offsets[-1]], np.full(8, 32, np.uint8)]), offsets - offsets[0]


def word_bounds(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and how many there are before each bound of the texts.

    Words are runs without ``\\x20`` and ``\\x09-\\x0D``.
    """
    size = int(ends[-1])
    space = _SPACE[raw[:size]]
    if not size:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(ends), np.int64)
    starts, stops = ~space, ~space
    starts[1:] &= space[:-1]
    stops[:-1] &= space[1:]
    # Words of neighbouring texts touch, but do not run on.
    edges = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < size)]
    starts[edges] = ~space[edges]
    stops[edges - 1] = ~space[edges - 1]
    begin, stop = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    return begin, stop, np.searchsorted(begin, ends)


def word_hashes(texts: pa.Array, ascii_lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and where each text's words begin and end."""
    import xxhash

    raw, ends = bytes_of(texts)
    if ascii_lower:
        raw = _ASCII_LOWER[raw]
    begin, stop, upto = word_bounds(raw, ends)
    length = stop - begin
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    found = length.astype(np.uint64) * _STEP
    own, at, left = slice(None), begin, length
    while len(at):
        part = eight[at] & _FIRST_BYTES[np.minimum(left, 8)]
        found[own] = mixed(found[own] * _STEP ^ part)
        more = np.flatnonzero((left > 8) & (left <= LONG_WORD))
        own = more if isinstance(own, slice) else own[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(length > LONG_WORD):
        found[i] = xxhash.xxh64_intdigest(raw[begin[i] : stop[i]].tobytes())
    return found, upto
