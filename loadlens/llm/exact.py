"""Exact whole-number arithmetic on vectors, in tasks, and exact sums through Spark's aggregates.

A whole number of any size travels as rows ``(shift, value)`` that stand for
``value * 2 ** shift``; Spark adds up the long values per shift, and
:func:`total` puts the number together again.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

#: Bits of one row's value.
LIMB = 40
_MASK = (1 << LIMB) - 1


def finite_rows(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a list column: which rows are a list of finite numbers only, the offsets, and the values as doubles (null: NaN)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    off = column.offsets.to_numpy().astype(np.int64)
    values = column.values[int(off[0]):int(off[-1])].cast(pa.float64()).to_numpy(zero_copy_only=False)
    off = off - off[0]
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    there = np.asarray(column.is_valid().to_numpy(zero_copy_only=False), bool)
    return there & (bad[off[1:]] == bad[off[:-1]]), off, values


def floors(x: np.ndarray, factor: int) -> np.ndarray:
    """``floor(factor * x)`` of doubles, exact: int64, or Python's integers where one doesn't fit in 62 bits.

    ``factor`` is a power of two, so that the product itself is exact.
    """
    with np.errstate(over="ignore"):
        y = np.floor(x * factor)
    if not y.size or np.abs(y).max() < 2.0 ** 62:
        return y.astype(np.int64)
    whole = [int(v) * factor if abs(v) >= 2.0 ** 53 else math.floor(v * factor) for v in x.ravel().tolist()]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(x.shape)


def largest(x: np.ndarray) -> int:
    """Largest absolute value."""
    return int(max(abs(x.max()), abs(x.min()))) if x.size else 0


def limbs(v: int, shift: int = 0):
    """``(shift, value)`` rows of a whole number; none for 0."""
    sign, v = (-1, -v) if v < 0 else (1, v)
    while v:
        if v & _MASK:
            yield shift, sign * (v & _MASK)
        v >>= LIMB
        shift += LIMB


def total(rows) -> dict:
    """Whole numbers by key from collected ``(*key, shift, value)`` rows."""
    out: dict = {}
    for *key, shift, value in rows:
        out[tuple(key)] = out.get(tuple(key), 0) + (value << shift)
    return out
