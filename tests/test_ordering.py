"""Distributed ordering helpers vs pandas, including ties, nulls and a hot group."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadlens.operators import ordering, quantiles


def _frame(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    # group "hot" holds a third of the rows; values have many ties
    g = np.where(np.arange(n) % 3 == 0, "hot", rng.choice(["a", "b", "c", "d"], n))
    v = rng.integers(0, 50, n).astype(float)
    v[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"k": np.arange(n), "g": g, "v": v, "t": rng.permutation(n)})
    sdf = spark.createDataFrame(pdf.astype({"v": "float64"})).replace(float("nan"), None)
    return pdf, sdf


def test_row_index_matches_cumcount(spark):
    pdf, sdf = _frame(spark)
    out = ordering.row_index(sdf, ["t", "k"], ["g"], num_ranges=7).toPandas()
    exp = pdf.sort_values(["t", "k"]).assign(e=lambda d: d.groupby("g").cumcount())
    m = out.merge(exp[["k", "e"]], on="k")
    assert len(m) == len(pdf) and (m.row_idx == m.e).all()


def test_running_min_and_sum(spark):
    pdf, sdf = _frame(spark)
    sdf2 = sdf.fillna(0.0, ["v"])
    pdf2 = pdf.fillna({"v": 0.0}).sort_values(["t", "k"])
    out = ordering.running(sdf2, ["t", "k"], ["g"], {"mn": ("min", "v"), "sm": ("sum", "v")}, num_ranges=5).toPandas()
    pdf2["mn"] = pdf2.groupby("g").v.cummin()
    pdf2["sm"] = pdf2.groupby("g").v.cumsum()
    m = out.merge(pdf2[["k", "mn", "sm"]], on="k", suffixes=("", "_e"))
    assert np.allclose(m.mn, m.mn_e) and np.allclose(m.sm, m.sm_e)


def test_average_rank_pct_with_ties_and_nulls(spark):
    pdf, sdf = _frame(spark)
    out = ordering.average_rank_pct(sdf, "v", "p", ["g"], num_ranges=6).toPandas().set_index("k").sort_index()
    exp = pdf.groupby("g").v.rank(pct=True)
    got = out.loc[pdf.k, "p"].to_numpy(dtype=float)
    assert np.allclose(got, exp.to_numpy(), equal_nan=True)


PROBS = [0, 0.1, 0.25, 0.5, 0.9, 1]


@pytest.mark.parametrize(("sketch", "error", "open_rows"), [(400, 0.012, 200_000), (16, 0.2, 30), (8, 0.0, 200_000), (8, 0.001, 10)])
def test_exact_quantiles_grouped(spark, monkeypatch, sketch, error, open_rows):
    """Wide brackets, brackets that are narrowed, and brackets that miss their rank and are sorted instead."""
    for name, value in (("SKETCH", sketch), ("ERROR", error), ("OPEN_ROWS", open_rows)):
        monkeypatch.setattr(quantiles, name, value)
    pdf, sdf = _frame(spark)
    tab = quantiles.quantile_table(sdf, ["v", "t"], PROBS, by=["g"])
    groups = {(g, c) for c in ("v", "t") for g in pdf[pdf[c].notna()].g.unique()}
    assert set(tab) == {(*k, float(p)) for k in groups for p in PROBS}
    for (g, c, p), val in tab.items():
        x = pdf.loc[pdf.g == g, c].dropna()
        assert abs(np.percentile(x, p * 100) - val) < 1e-9


@pytest.mark.parametrize("open_rows", [200_000, 300])
def test_quantiles_of_many_rows_with_ties_nulls_and_null_groups(spark, monkeypatch, open_rows):
    monkeypatch.setattr(quantiles, "OPEN_ROWS", open_rows)
    r = np.random.default_rng(1)
    v = np.concatenate([np.full(20_000, 3.0), r.lognormal(1, 1, 30_000), [np.inf, -np.inf, -0.0, 0.0]])
    g = r.choice(["a", "b", ""], len(v))
    df = spark.createDataFrame([(k or None, float(x)) for k, x in zip(g, v)] + [("a", None), ("a", float("nan")), ("none", None)],
                               "g string, v double").repartition(7)
    got = {(x.g, x.p): x.value for x in quantiles.quantiles(df, ["v"], [0.05, 0.5, 0.77, 0.999], ["g"]).collect()}
    assert len(got) == 12
    for (k, p), value in got.items():
        assert np.isclose(np.percentile(v[g == (k or "")], p * 100), value, rtol=1e-12)


def test_quantiles_shuffle_no_rows(spark, monkeypatch):
    """What the counting pass shuffles is a few percent of the values."""
    df = spark.range(60_000).select((F.rand(3) * 1e6).alias("v"))
    counted, picked = [], quantiles._picked
    monkeypatch.setattr(quantiles, "_picked", lambda c, *rest: counted.append(c) or picked(c, *rest))
    assert 0 < quantiles.quantile_row(df, "v", [0.5])[0.5] < 1e6
    assert counted[0].count() < 60_000 * 0.04


def test_quantiles_constant_and_single(spark):
    sdf = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 5.0)], "k long, v double")
    assert quantiles.quantile_row(sdf, "v", [0.25, 0.75]) == {0.25: 5.0, 0.75: 5.0}
    one = spark.createDataFrame([(1, 2.5)], "k long, v double")
    assert quantiles.quantile_row(one, "v", [0.5]) == {0.5: 2.5}


def test_hot_group_and_hot_tie_are_split_across_ranges(spark):
    # one group holds a third of all rows, and all of its rows tie
    n = 6000
    rows = [("hot" if i % 3 == 0 else f"g{i % 50}", 1.0 if i % 3 == 0 else float(i % 997)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = ordering.ranged(df, ["v"], ["g"], num_ranges=8).where("g = 'hot'").groupBy(ordering.RANGE).count().collect()
    assert len(got) >= 3 and sum(r["count"] for r in got) == n // 3
    idx = ordering.row_index(df, ["v"], ["g"], num_ranges=8)
    assert sorted(r.row_idx for r in idx.where("g = 'hot'").collect()) == list(range(n // 3))


def test_null_groups_and_null_order_keys(spark):
    rows = [(None if i % 4 == 0 else f"g{i % 3}", None if i % 7 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, t long, k long")
    for order in (["t", "k"], ["t"]):
        out = ordering.row_index(df, order, ["g"], num_ranges=9).toPandas()
        for _, part in out.groupby("g", dropna=False):
            assert sorted(part.row_idx) == list(range(len(part)))
            known = part[part.t.notna()].sort_values("t")
            assert known.row_idx.is_monotonic_increasing and (known.row_idx >= part.t.isna().sum()).all()


def test_many_groups(spark):
    df = spark.range(40000).selectExpr("id % 10000 as g", "id as t")
    out = ordering.row_index(df, ["t"], ["g"], num_ranges=16)
    assert out.where("row_idx <> floor(t / 10000)").count() == 0 and out.count() == 40000


def test_empty_frames(spark):
    df = spark.createDataFrame([], "g string, t long, v double")
    assert ordering.row_index(df, ["t"], ["g"]).count() == 0
    assert quantiles.quantile_table(df, ["v"], [0.5]) == {}
