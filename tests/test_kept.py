"""Detectors that are kept and applied to new rows, against plain numpy."""

import tempfile

import numpy as np
import pytest

from loadlens.operators import anomaly as AN
from loadlens.operators import detectors as DT
from loadlens.operators import kept as KP


def plain_lof(train, new, k):
    """k-distance, density and factor by sorting all distances; of equal distances the lower value comes first."""
    train = np.sort(train)

    def nearest(d, kk):
        return np.argsort(d, kind="stable")[:kk]
    n = len(train)
    kd, near = np.zeros(n), []
    for i in range(n):
        d = np.abs(train - train[i])
        d[i] = np.inf
        near.append(nearest(d, min(k, n - 1)))
        kd[i] = d[near[i][-1]]
    lrd = np.array([1 / (np.maximum(kd[near[i]], np.abs(train[near[i]] - train[i])).mean() + 1e-10) for i in range(n)])
    out = []
    for x in new:
        d = np.abs(train - x)
        j = nearest(d, min(k, n))
        out.append(lrd[j].mean() * (np.maximum(kd[j], d[j]).mean() + 1e-10))
    return np.array(out), {v: lrd[near[i]].mean() / lrd[i] for i, v in enumerate(train)}


@pytest.mark.parametrize(("block", "chunk"), [(20_000, 20_000), (110, 7)])
def test_novelty_equals_plain_distances(spark, block, chunk):
    r = np.random.default_rng(2)
    train = np.concatenate([r.normal(0, 1, 300), np.full(90, 2.5), r.integers(0, 9, 60), r.exponential(50, 50)])
    new = np.concatenate([r.normal(0, 2, 40), [2.5, -1e6, 1e6, 2.5, 0.0], train[:10]])
    rows = spark.createDataFrame([("m", f"t{i}", float(v)) for i, v in enumerate(train)], "column string, test_id string, value double")
    blocks = KP.training_blocks(DT.numbered(rows), 20, block)
    frame = spark.createDataFrame([("m", float(v)) for v in new], "column string, value double")
    got = {x.value: x.lof for x in KP.outlier_factors(frame, blocks.cache(), 20, chunk).collect()}
    want, own = plain_lof(train, new, 20)
    assert set(got) == set(new)
    assert np.allclose([got[v] for v in new], want, rtol=1e-9)
    kept = {v: f for b in blocks.collect() for v, f in zip(b.own, b.lof)}
    assert set(kept) == set(train) and np.allclose([kept[v] for v in own], list(own.values()), rtol=1e-9)


def test_few_training_values(spark):
    rows = spark.createDataFrame([("m", f"t{i}", float(i)) for i in range(12)], "column string, test_id string, value double")
    blocks = KP.training_blocks(DT.numbered(rows), 20)
    frame = spark.createDataFrame([("m", 3.5), ("m", 40.0)], "column string, value double")
    got = {x.value: x.lof for x in KP.outlier_factors(frame, blocks, 20).collect()}
    want, _ = plain_lof(np.arange(12.0), [3.5, 40.0], 20)
    assert np.allclose([got[3.5], got[40.0]], want)


def test_kept_detectors_score_another_frame(spark):
    """Scores come from the fitted rows alone: they do not change with the other new rows; repeats and nulls are kept apart."""
    r = np.random.default_rng(3)
    base = spark.createDataFrame([(f"b{i}", float(v), float(w), None) for i, (v, w) in enumerate(zip(r.normal(100, 5, 400), r.normal(0, 1, 400)))],
                                 "test_id string, x double, y double, z double")
    new = [("n1", 100.0, 0.1), ("n2", 500.0, 0.2), ("n2", 500.0, None), (None, float("nan"), 30.0), ("n3", 100.0, -40.0)]
    folder = KP.fit(base, ["x", "y", "z"], tempfile.mkdtemp(dir="/tmp") + "/kept")
    schema = "test_id string, x double, y double, note string"
    every = KP.score(spark.createDataFrame([(*t, "n") for t in new], schema), folder, carry=["note"])
    rows = every.collect()
    assert len(rows) == 8 and {x["column"] for x in rows} == {"x", "y"} and {x.note for x in rows} == {"n"}
    by = {(x.test_id, x["column"], x.value): x for x in rows}
    assert by["n2", "x", 500.0].is_anomaly and by[None, "y", 30.0].is_anomaly and by["n3", "y", -40.0].is_anomaly
    assert not by["n1", "x", 100.0].is_anomaly and by["n1", "x", 100.0].v_lof == by["n1", "x", 100.0].v_forest == 1
    alone = KP.score(spark.createDataFrame([("n1", 100.0, 0.1, "n")], schema), folder).collect()
    for x in alone:
        both = by["n1", x["column"], x.value]
        assert (x.lof, x.iforest_score, x.distance, x.model_consensus) == (both.lof, both.iforest_score, both.distance, both.model_consensus)
    own = AN.ensemble(base, ["x"]).toPandas().set_index("test_id")
    kept = KP.score(base, folder, columns=["x"]).toPandas().set_index("test_id")
    assert np.allclose(own.distance.sort_index(), kept.distance.sort_index())
    assert np.allclose(own.iforest_score.sort_index(), kept.iforest_score.sort_index())


def test_vote_rule(spark):
    """AN3 on given votes: fewer than half of the detectors say normal, or the statistical rule fires."""
    rows = [(a, b, c, s) for a in (0, 1) for b in (0, 1) for c in (0, 1) for s in (False, True)]
    df = spark.createDataFrame(rows, "a int, b int, c int, statistical boolean")
    for x in AN.vote(df, ["a", "b", "c"]).collect():
        assert abs(x.model_consensus - (x.a + x.b + x.c) / 3) < 1e-12
        assert x.is_anomaly == (x.a + x.b + x.c <= 1 or x.statistical)
