"""Vectorised word handling on Arrow string columns, shared by the operators of this package.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D. Because that class is ASCII, splitting the
UTF-8 bytes and splitting the characters give the same words. Every function here works on one block of
rows inside a task (a few MB of text, or one longer text), so memory does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
_CHUNK = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_NGRAM = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for n bytes."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, _CHUNK)
        out = []
        for b in (_BASE, _BASE_INV):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if size > _CHUNK:
            return out[0], out[1]
        _powers[0] = have = (out[0], out[1])
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for spans in ascending order that do not overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + _CHUNK, side="right")))
        top = int(ends[j - 1])
        pw, inv = _power_table(top - base + 1)
        total = np.zeros(top - base + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data[base:top]] * pw[: top - base], out=total[1:])
        s = starts[i:j] - base
        e = ends[i:j] - base
        out[i:j] = (total[e] - total[s]) * inv[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


@dataclass
class Block:
    """Some rows of a batch: the text bytes, and the byte range of each row."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def blocks(col: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """A string column, null as empty, in blocks of about block_bytes (a longer text is a block of its own)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return
    if col.null_count:
        col = pc.fill_null(col, "")
    if pa.types.is_null(col.type):
        col = pa.array([""] * len(col), pa.string())
    wide = pa.types.is_large_string(col.type)
    _, off, buf = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block_bytes, side="right")) - 1)
        yield Block(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of `inside` within each row: starts, ends, and the first run of each row (rows + 1 entries)."""
    n = len(inside)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = True
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = ~inside[1:]
    last[cuts - 1] = True
    starts = np.flatnonzero(inside & first)
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(block: Block, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a block in order, their starts and ends, and the first word of each row (rows + 1 entries)."""
    data = lower_ascii(block.data) if lower else block.data
    starts, ends, first = spans(~SPACE[data], block.offsets)
    return span_hashes(data, starts, ends), starts, ends, first


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive entries; len(h) - n + 1 of them (rows are the caller's care)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = h[: len(h) - n + 1] * _NGRAM[0]
    for k in range(1, n):
        out = out + h[k : len(h) - n + 1 + k] * _NGRAM[k]
    return mix(out)


def distinct(a: np.ndarray) -> np.ndarray:
    """The sorted distinct entries (a plain sort, which numpy runs in vector instructions)."""
    if len(a) < 2:
        return a
    a = np.sort(a)
    keep = np.empty(len(a), bool)
    keep[0] = True
    np.not_equal(a[1:], a[:-1], out=keep[1:])
    return a[keep]


def counted(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct entries and how often each occurs."""
    if len(a) == 0:
        return a, np.zeros(0, np.int64)
    a = np.sort(a)
    at = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    return a[at], np.diff(np.append(at, len(a)))


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each entry, from the first entry of each row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingle_sets(block: Block, n: int, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-word shingle hashes) of each row; fewer than n words make one shingle of them all."""
    h, _, _, first = words(block, lower)
    grams = ngrams(h, n)
    for i in range(block.rows):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= n:
            yield i, distinct(grams[a : b - n + 1])
        elif b > a:
            yield i, ngrams(h[a:b], b - a) + np.uint64(b - a)
        else:
            yield i, np.zeros(0, np.uint64)
