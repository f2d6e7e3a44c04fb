import numpy as np
import pytest

from loadlens.llm import near_vectors as N


def brute(x):
    u = x / np.linalg.norm(x, axis=1)[:, None]
    g = u @ u.T >= 0.9
    np.fill_diagonal(g, False)
    label = np.arange(len(x))
    while True:
        new = np.array([min([label[i], *label[g[i]]]) for i in range(len(x))])
        if (new == label).all():
            return g.sum(axis=1), label
        label = new


def vectors(seed):
    r = np.random.default_rng(seed)
    base = r.standard_normal((60, 16))
    near = base[r.integers(0, 60, 80)] + 0.3 * r.standard_normal((80, 16))
    hot = base[0] + 0.05 * r.standard_normal((70, 16))
    x = np.concatenate([base, near, hot, base[:5], 3 * base[5:8]]).astype(np.float32)
    return x[r.permutation(len(x))]


@pytest.mark.parametrize("block", [1000, 40])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    x = vectors(block)
    n, label = brute(x.astype(np.float64))
    rows = [(i * 10, v.tolist(), 0) for i, v in enumerate(x)]
    got = sorted(map(tuple, N.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()))
    assert got == [(i * 10, int(n[i]), int(label[i]) * 10, bool(label[i] == i)) for i in range(len(x))]


def test_unusable_vectors_link_with_nothing(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one), (2, one), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, float("nan"), 3.0]), (6, [1.0, None, 3.0]),
            (7, [float("inf"), 2.0, 3.0]), (8, [1.0, 2.0]), (9, []), (None, one), (10, one)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, usable string")
    got = {r.vec_id: tuple(r)[1:] for r in N.near_vectors(df).collect()}
    assert got.pop(None) == (0, None, False)
    assert got == {1: (2, 1, True), 2: (2, 1, False), 10: (2, 1, False)} | {i: (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)}
    assert N.near_vectors(df.limit(0)).count() == 0


def test_bound_holds_for_every_pair():
    x = N.unit(vectors(2))
    q, s, e = N.quantise(x)
    rough = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None, :]
    bound = e[:, None] * (1 + e[None, :]) + e[None, :] * (1 + e[:, None]) + e[:, None] * e[None, :]
    assert (np.abs(rough - x @ x.T) <= bound + 1e-12).all()
