"""Words of Arrow text columns as hash arrays, computed over whole buffers at once.

A word is a maximal run of bytes of a given class. Its 64-bit hash is a polynomial in the bytes,
taken from one running sum over the buffer, then mixed; so no Python object exists per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Odd multipliers of the polynomials and of the mixer.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
MIX_A, MIX_B = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53

PIECE_BYTES = 1 << 20
# Of words: their arrays take about fifty bytes a byte of text, in each of the workers of an executor.
WORD_PIECE_BYTES = 1 << 18

_byte = np.arange(256)
# Bytes of words [^\x20\x09-\x0D]+
NOT_SPACE = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))
# Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing A-Z)
LETTER_DIGIT = ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
LOWER = np.where((_byte >= 0x41) & (_byte <= 0x5A), _byte + 32, _byte).astype(np.uint8)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
_KEPT: list = [None, None]


def release() -> None:
    """Give memory that is free in this process back to the system; idle workers stay small."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def kept(kind, make):
    """What a worker keeps from task to task for one kind of work; other work drops it.

    Workers serve one stage after another, so the caches of earlier stages must not pile up.
    """
    if _KEPT[0] != kind:
        _KEPT[:] = [None, None]
        release()
        _KEPT[:] = [kind, make()]
    return _KEPT[1]


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = -(-n // (1 << 18)) << 18
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_BYTES, _WORDS = Powers(BYTE_BASE), Powers(WORD_BASE)


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective mixer of 64-bit values (two multiply-xor-shift rounds)."""
    h = h ^ np.uint64(salt) if salt else h.copy()
    h ^= h >> np.uint64(33)
    h *= np.uint64(MIX_A)
    h ^= h >> np.uint64(33)
    h *= np.uint64(MIX_B)
    h ^= h >> np.uint64(33)
    return h


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte span of ``data``; equal bytes give equal hashes wherever they stand."""
    up, down = _BYTES.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.multiply(up[:-1], data.astype(np.uint16) + np.uint16(1), out=sums[1:])
    np.cumsum(sums, out=sums)
    return mix((sums[ends] - sums[starts]) * down[starts])


def hash_windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values of ``words`` (runs cross document borders)."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    up, down = _WORDS.upto(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.multiply(words, up[:-1], out=sums[1:])
    np.cumsum(sums, out=sums)
    return mix((sums[size:] - sums[:-size]) * down[: len(words) - size + 1], size)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1] if offs else np.zeros(1)
    return np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8), offsets.astype(np.int64)


@dataclass
class Words:
    """Words of documents ``first`` to ``last`` of a batch; word j of document i is at ``bounds[i] + j``."""

    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def inside(self, size: int) -> np.ndarray:
        """Which window starts keep ``size`` words within one document."""
        owner_end = np.repeat(self.bounds[1:], np.diff(self.bounds))
        return np.arange(len(self.hashes)) + size <= owner_end

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.last - self.first), np.diff(self.bounds))


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes; a longer document is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_pieces(column: pa.Array, word_bytes: np.ndarray, lower: bool, limit: int = WORD_PIECE_BYTES) -> Iterator[Words]:
    """The words of a text column, piece by piece."""
    data, offsets = buffers(column)
    for first, last in pieces(offsets, limit):
        part = data[offsets[first] : offsets[last]]
        if lower:
            part = LOWER[part]
        bounds = offsets[first : last + 1] - offsets[first]
        inside = word_bytes[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[bounds] = True
        before = np.zeros(len(part), bool)
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.zeros(len(part), bool)
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        hashes = hash_spans(part, starts, ends)
        yield Words(first, last, part, starts, ends, np.searchsorted(starts, bounds), hashes)
    release()
