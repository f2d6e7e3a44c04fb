"""Operator 13: embedding whitening by polarisation covariance.

Every entry c becomes the integer ``x = floor(64 * c) + 1000000``.  The fit
list holds each distinct x-vector once; n is its length and S its sums per
dimension.  For the centred values ``y = n * x - S`` Spark adds up, exactly,

    ``q[i] = sum(y_i ** 2)``  and  ``q[i, j] = sum((y_i + y_j) ** 2)``,

and the differences of these variances give every cross-covariance
(polarisation): ``cov(i, j) = (q[i, j] - q[i] - q[j]) / (2 * n ** 3)``.  Only
the assembled matrix (its size is set by the dimension) is decomposed on the
driver, by ``eigh``; its unit eigenvectors, by falling eigenvalue, whiten the
rows.  The covariance of the whitened fit list is then measured against the
identity.

All whole numbers are exact: a task splits values that could overflow 64 bits
into 20-bit digits, and sums travel as limbs (``exact.py``).  The offset of a
million cancels out of y, so it is never added.

Rows whose vector is null or holds a null, NaN or infinite entry are dropped.
A vector shorter than the longest one counts as filled up with zeros.
Repeated rows and null vec_ids are whitened like others.  Entries beyond 2^62
count as 2^62; a deviation over the largest long is the largest long.  A
component without variance (an eigenvalue of at most 1e-12 of the largest) has
a null ``whitened`` and takes no part in ``identity_error``, which is null
when no component has any; ``explained`` is null when the trace is 0.  Without
remaining rows there is no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import exact as X
from loadlens.llm.tables import store

SCALE, COMPONENTS = 64, 16
#: Entries handled at once in a task.
BLOCK_VALUES = 1 << 18
#: Bits of a digit of values whose squares don't fit in 64 bits.
DIGIT = 20
_MAX, _TOP = (1 << 63) - 1, 1 << 62
_WIDTHS = (1, 2, 4, 8)


def whole(x: np.ndarray) -> np.ndarray:
    """``floor(64 * x)`` as int64, cut off at 2^62."""
    with np.errstate(over="ignore"):
        y = np.floor(x * SCALE)
    return np.where(np.abs(y) < 2.0 ** 62, y, 0).astype(np.int64) + np.where(y >= 2.0 ** 62, _TOP, 0) - np.where(y <= -2.0 ** 62, _TOP, 0)


def pack(x: np.ndarray) -> list[bytes]:
    """One key per row, equal for equal vectors: a byte for the width, and the integers in the least width without trailing zeros."""
    n, dim = x.shape
    last = dim - np.argmax(x[:, ::-1] != 0, axis=1) if dim else np.zeros(n, int)
    most = np.maximum(x.max(axis=1), -(x.min(axis=1) + 1)) if dim else np.zeros(n, np.int64)
    last = np.where((x != 0).any(axis=1), last, 0)
    kind = np.digitize(most, [1 << 7, 1 << 15, 1 << 31])
    out: list = [b""] * n
    for k, width in enumerate(_WIDTHS):
        rows = np.flatnonzero(kind == k)
        data, size = x[rows].astype(f"i{width}").tobytes(), dim * width
        for at, row in enumerate(rows.tolist()):
            out[row] = bytes([k]) + data[at * size:at * size + last[row] * width]
    return out


def unpack(keys: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(keys), dim), np.int64)
    kind = np.array([k[0] for k in keys], int)
    for k, width in enumerate(_WIDTHS):
        rows = np.flatnonzero(kind == k)
        if len(rows):
            values = np.frombuffer(b"".join(keys[r][1:] for r in rows), f"i{width}")
            size = np.array([(len(keys[r]) - 1) // width for r in rows])
            part = np.zeros((len(rows), dim), np.int64)
            part[np.arange(dim) < size[:, None]] = values
            out[rows] = part
    return out


def _vectors(batches: Iterator[pa.RecordBatch]):
    """The usable rows of a batch and their whole numbers, dimension by dimension, a block at a time."""
    for t in batches:
        if not t.num_rows:
            continue
        keep, off, values = X.finite_rows(t.column("embedding"))
        size = np.diff(off)
        for dim in np.unique(size[keep]).tolist():
            chosen, step = np.flatnonzero(keep & (size == dim)), max(1, BLOCK_VALUES // max(dim, 1))
            for at in range(0, len(chosen), step):
                some = chosen[at:at + step]
                yield t, some, whole(values[off[some][:, None] + np.arange(dim)])


def fit_list(vectors: DataFrame) -> DataFrame:
    """``(key, dim)``: each distinct x-vector once, with the longest dimension it came with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some, x in _vectors(batches):
            yield pa.RecordBatch.from_arrays([pa.array(pack(x), pa.binary()), pa.array(np.full(len(some), x.shape[1], np.int32))],
                                             names=["key", "dim"])

    keys = vectors.select(F.col("embedding").cast("array<double>")).mapInArrow(run, "key binary, dim int")
    return keys.groupBy("key").agg(F.max("dim").alias("dim"))


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for t in batches:
        keys, step = t.column("key").to_pylist(), max(1, BLOCK_VALUES // max(dim, 1))
        for at in range(0, len(keys), step):
            yield unpack(keys[at:at + step], dim)


class Total:
    """Exact running sums of arrays of whole numbers: by shift, in two limbs that can't overflow."""

    def __init__(self):
        self.parts: dict = {}

    def add(self, x: np.ndarray, shift: int = 0) -> None:
        """Add ``x * 2 ** shift`` (int64, or Python's integers)."""
        if x.dtype == object:
            while x.any():
                self.add((x & X._MASK).astype(np.int64), shift)
                x, shift = x >> X.LIMB, shift + X.LIMB
                if (x == -1).any():                             # -1 shifted stays -1
                    self.add(np.where(x == -1, -1, 0).astype(np.int64), shift)
                    x = np.where(x == -1, 0, x)
            return
        for s, limb in ((shift, x & X._MASK), (shift + X.LIMB, x >> X.LIMB)):
            if s in self.parts:
                self.parts[s] += limb
            else:
                self.parts[s] = limb.copy()

    def rows(self) -> Iterator[tuple[int, np.ndarray]]:
        return iter(self.parts.items())


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``: int64 if that fits in 62 bits."""
    if n * X.largest(x) + max(map(abs, sums), default=0) < _TOP:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(z: np.ndarray, out: Total, most: int) -> None:
    """Add the sums of squares of the columns of ``z``, exactly; ``most`` bounds its absolute values."""
    if z.dtype == object or most >= _TOP:
        out.add((z.astype(object) ** 2).sum(axis=0))
    elif most * most * len(z) < _TOP:
        out.add(np.einsum("ij,ij->j", z, z))
    else:
        digits, rest = [], z
        while True:                                             # the last digit keeps the sign
            if most < 1 << DIGIT:
                digits.append(rest)
                break
            digits.append(rest & ((1 << DIGIT) - 1))
            rest, most = rest >> DIGIT, (most >> DIGIT) + 1
        for a, left in enumerate(digits):
            for b in range(a, len(digits)):
                out.add(np.einsum("ij,ij->j", left, digits[b]) * (1 if a == b else 2), DIGIT * (a + b))


def _sums(keys: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Length of the fit list and its sums per dimension (of x without the offset)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = Total(), 0
        for x in _blocks(batches, dim):
            wide = X.largest(x) * len(x) >= _TOP
            total.add((x.astype(object) if wide else x).sum(axis=0))
            n += len(x)
        yield _entries(np.array([-1]), np.array([-1]), 0, np.array([n]))
        for shift, value in total.rows():
            yield _entries(np.arange(dim), np.arange(dim), shift, value)

    found = _collect(keys, run)
    return found.get((-1, -1), 0), [found.get((i, i), 0) for i in range(dim)]


def _entries(i, j, shift: int, value) -> pa.RecordBatch:
    some = np.flatnonzero(value)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(i)[some], pa.int32()), pa.array(np.asarray(j)[some], pa.int32()),
         pa.array(np.full(len(some), shift, np.int32)), pa.array(np.asarray(value)[some], pa.int64())], names=["i", "j", "shift", "value"])


def _collect(keys: DataFrame, run) -> dict:
    """The tasks' sums, added up by Spark: a row per matrix entry and limb."""
    rows = keys.select("key").mapInArrow(run, "i int, j int, shift int, value long")
    return X.total(rows.groupBy("i", "j", "shift").agg(F.sum("value")).collect())


def covariance(keys: DataFrame, dim: int, n: int, sums: list[int]) -> tuple[np.ndarray, float]:
    """Covariance matrix of the fit list by polarisation, and its trace."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, pairs = Total(), [Total() for _ in range(dim)]
        for x in _blocks(batches, dim):
            y = centred(x, n, sums)
            most = X.largest(y)
            squares(y, own, most)
            for i in range(dim - 1):
                squares(y[:, i:i + 1] + y[:, i + 1:], pairs[i], 2 * most)
        for shift, value in own.rows():
            yield _entries(np.arange(dim), np.arange(dim), shift, value)
        for i, pair in enumerate(pairs):
            for shift, value in pair.rows():
                yield _entries(np.full(dim - 1 - i, i), np.arange(i + 1, dim), shift, value)

    q = _collect(keys, run)
    v, scale = np.zeros((dim, dim)), n ** 3
    for i in range(dim):
        v[i, i] = q.get((i, i), 0) / scale
        for j in range(i + 1, dim):
            v[i, j] = v[j, i] = (q.get((i, j), 0) - q.get((i, i), 0) - q.get((j, j), 0)) / (2 * scale)
    return v, sum(q.get((i, i), 0) for i in range(dim)) / scale


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit vectors (as columns); each vector's largest entry is positive."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:COMPONENTS], u[:, ::-1][:, :COMPONENTS]
    sign = np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])
    return e, u * np.where(sign == 0, 1, sign)


def project(y: np.ndarray, n: int, e: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Whitened values of centred rows; NaN for components without variance."""
    w = (y / n).astype(np.float64) @ u
    some = e > 1e-12 * max(e.max(initial=0), 0)
    return np.where(some, w / np.sqrt(np.where(some, e, 1)), np.nan)


def _identity_error(keys: DataFrame, dim: int, n: int, sums: list[int], e: np.ndarray, u: np.ndarray) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list, less the identity."""
    k = len(e)
    a, b = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product, plain = np.zeros((k, k)), np.zeros(k)
        for x in _blocks(batches, dim):
            w = project(centred(x, n, sums), n, e, u)
            product += w.T @ w
            plain += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([a, np.full(k, -1)]), pa.int32()), pa.array(np.concatenate([b, np.arange(k)]), pa.int32()),
             pa.array(np.concatenate([product[a, b], plain]))], names=["a", "b", "value"])

    rows = keys.select("key").mapInArrow(run, "a int, b int, value double").groupBy("a", "b").agg(F.sum("value")).collect()
    found = {(i, j): v / n for i, j, v in rows}
    mean = [found[-1, j] for j in range(k)]                     # 0 but for rounding: rows are centred before they are projected
    off = [abs(found[i, j] - mean[i] * mean[j] - (i == j)) for i, j in zip(a.tolist(), b.tolist())]
    return max((v for v in off if v == v), default=None)


def whiten(vectors: DataFrame) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    keys = store(fit_list(vectors), "whitening-fit")
    dim = keys.agg(F.max("dim")).first()[0] or 0
    if not dim:
        return spark.createDataFrame([], out)
    n, sums = _sums(keys, dim)
    v, trace = covariance(keys, dim, n, sums)
    e, u = components(v)
    error = _identity_error(keys, dim, n, sums, e, u)
    k = len(e)
    share = [float(x / trace) if trace else None for x in e]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, some, x in _vectors(batches):
            full = np.zeros((len(x), dim), np.int64)
            full[:, :x.shape[1]] = x
            y = centred(full, n, sums)
            if y.dtype != object and X.largest(y) ** 2 * dim < _TOP:
                deviation = np.einsum("ij,ij->i", y, y)
            else:
                deviation = np.array([min(d, _MAX) for d in (y.astype(object) ** 2).sum(axis=1).tolist()], np.int64)
            w, each = project(y, n, e, u).ravel(), np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [t.column("vec_id").take(some[each]), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(each), n, np.int64)), pa.array(deviation[each]), pa.array(w, mask=np.isnan(w)),
                 pa.array(share * len(x), pa.float64()), pa.array([error] * len(each), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, out)
