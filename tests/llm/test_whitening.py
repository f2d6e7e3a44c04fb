import math

import numpy as np
import pytest

from loadlens.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, n string"


def expected(rows):
    """Distinct x-vectors, exact covariance with Python's integers, eigh, projections."""
    x = {i: [math.floor(64 * c) + 1000000 for c in e] for i, e in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, s = len(fit), fit.sum(axis=0)
    y = n * fit - s
    v = np.array([[a / n ** 3 for a in row] for row in y.T @ y])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    centred = {i: n * np.array(v, object) - s for i, v in x.items()}
    return n, {i: int((c ** 2).sum()) for i, c in centred.items()}, e / np.trace(v), {
        i: (c / n).astype(float) @ u / np.sqrt(e) for i, c in centred.items()}


def run(spark, rows):
    df = spark.createDataFrame([(i, e, "x") for i, e in rows], SCHEMA).repartition(3)
    out = {}
    for r in W.whiten(df).collect():
        out.setdefault(r.vec_id, []).append(r)
    return {i: sorted(v, key=lambda r: r.component) for i, v in out.items()}


@pytest.mark.parametrize(("block", "scale"), [(1 << 18, 1), (100, 1), (1 << 18, 1e7), (300, 1e12), (300, 1e15)])
def test_equals_exact_covariance(spark, monkeypatch, block, scale):
    monkeypatch.setattr(W, "BLOCK_VALUES", block)
    r = np.random.default_rng(4)
    x = r.standard_normal((90, 20)) @ r.standard_normal((20, 20)) * scale
    x[50:60] = x[50]                                            # a vector that is repeated counts once
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    n, deviation, explained, whitened = expected(rows)
    got = run(spark, rows)
    assert n == 81 and set(got) == set(range(90))
    sign = np.sign(sum(np.array([c.whitened for c in got[i]]) * whitened[i] for i in got))
    for i, cells in got.items():
        assert [c.component for c in cells] == list(range(1, 17))
        assert {c.n for c in cells} == {n} and {c.deviation for c in cells} == {min(deviation[i], 2 ** 63 - 1)}
        assert np.allclose([c.explained for c in cells], explained, rtol=1e-6)
        assert np.allclose([c.whitened for c in cells], sign * whitened[i], rtol=1e-6, atol=1e-8)
        assert all(c.identity_error < 1e-9 for c in cells)


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [float("inf"), 1.0]), (5, [float("nan"), 1.0]), (None, [2.0, -1.0]),
            (6, [3.0]), (6, [3.0, 0.0]), (7, [])]
    got = run(spark, rows)
    assert {i: len(c) for i, c in got.items()} == {1: 2, None: 2, 6: 4, 7: 2}
    same = expected([(1, [1.0, 2.0]), (0, [2.0, -1.0]), (6, [3.0, 0.0]), (7, [0.0, 0.0])])
    assert got[1][0].n == same[0] == 4 and got[7][0].deviation == same[1][7]
    assert got[6][0].whitened == got[6][1].whitened and got[1][0].identity_error < 1e-9
    one = run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])        # no variance at all
    assert [tuple(r) for r in one[1]] == [(1, 1, 1, 0, None, None, None), (1, 2, 1, 0, None, None, None)]
    flat = run(spark, [(i, [float(i), 5.0]) for i in range(6)])  # one dimension without variance
    assert [r.whitened is None for r in flat[0]] == [False, True] and flat[0][0].explained == 1.0
    assert run(spark, [(3, None), (4, [])]) == {} and W.whiten(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("top", [10, 1 << 19, 1 << 30, 1 << 45, 1 << 60])
def test_squares_are_exact(top):
    r = np.random.default_rng(6)
    z = r.integers(-top, top, (500, 3), endpoint=True)
    total = W.Total()
    for part in (z[:300], z[300:]):
        W.squares(part, total, top)
    found = [0, 0, 0]
    for shift, values in total.rows():
        found = [f + (int(v) << shift) for f, v in zip(found, values)]
    assert found == [sum(int(v) ** 2 for v in c) for c in z.T]
    signed = W.Total()
    signed.add(np.array([-(1 << 90) - 5, (1 << 81) + 3, -1], object))
    assert [sum(int(v[k]) << s for s, v in signed.rows()) for k in range(3)] == [-(1 << 90) - 5, (1 << 81) + 3, -1]


def test_keys_are_equal_for_equal_vectors():
    x = np.array([[1, -128, 0, 0], [0, 0, 0, 0], [127, 128, 0, 1], [-129, 0, 0, 0], [1 << 40, 0, -(1 << 62), 0], [1 << 31, 0, 0, 0]])
    keys = W.pack(x)
    assert (W.unpack(keys, 4) == x).all() and W.pack(x[:, :0]) == [b"\0"] * 6
    assert W.pack(np.array([[1, -128], [0, 0]])) == keys[:2] and [k[0] for k in keys] == [0, 0, 1, 1, 3, 3]
