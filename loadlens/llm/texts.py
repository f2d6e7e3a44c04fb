"""Vectorised word and byte hashing over Arrow text batches (numpy, runs inside tasks).

Texts are handled as UTF-8 bytes straight from the Arrow buffers, in slices of
a few MB, so a task's memory does not depend on the batch size Spark picks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15          # odd, so invertible modulo 2^64
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_RAW = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
_LOWER = _RAW.copy()
_LOWER[65:91] = _RAW[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2^64 (kept between calls)."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


class RollingHash:
    """Hash of any byte range of a buffer from one running sum."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        up, _ = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum((_LOWER if lower else _RAW)[data] * up[:len(data)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        _, down = powers(len(self.sums))
        return mix((self.sums[end] - self.sums[start]) * down[start] + (end - start).astype(_U))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(batches, text: str = "text", limit: int = SLICE_BYTES):
    """Record batches cut or joined to about ``limit`` text bytes (one longer text stands alone)."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(off, off[at] + max(limit - size, 1), "right")) - 1
            to = max(to, at + 1) if not held else to
            if to > at:
                held.append(batch.slice(at, to - at))
                size += int(off[to] - off[at])
            if to < batch.num_rows or size >= limit:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
            at = to
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def words(data: np.ndarray, off: np.ndarray):
    """Start, end and row offsets of the words ``[^\\x20\\x09-\\x0D]+`` of each text."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before = np.ones(len(data), bool)
    before[1:] = ~solid[:-1]
    start = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.ones(len(data), bool)
    after[:-1] = ~solid[1:]
    end = np.flatnonzero(solid & (after | edge[1:])) + 1
    return start, end, np.searchsorted(start, off)


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each A-Z-lowered word, and each text's offsets in them."""
    start, end, rows = words(data, off)
    return RollingHash(data, lower=True).ranges(start, end), rows


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` neighbouring entries (it may cross texts; callers select)."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, _U)
    for k in range(n):
        out = out * _U(_BASE) + hashes[k:k + size]
    return mix(out)


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct n-word shingle hashes of each text; shorter texts have one, of all words; empty ones none."""
    h, rows = word_hashes(data, off)
    grams = runs(h, n)
    out = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            out.append(mix(runs(h[a:b], b - a) + _U(b - a)))
        else:
            out.append(np.zeros(0, _U))
    return out


def planes(x: np.ndarray, width: int) -> bytes:
    """Integers byte plane by byte plane, so that the unused high bytes compress away."""
    return np.ascontiguousarray(x.astype(np.int64).view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(b: bytes, width: int) -> np.ndarray:
    n = len(b) // width
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(b, np.uint8).reshape(width, n).T
    return wide.view(np.int64).ravel()
