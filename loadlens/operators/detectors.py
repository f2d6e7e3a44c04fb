"""Model-based one-dimensional detectors: isolation forest (AN2a), LOF (AN2b).

Isolation forest (Liu, Ting, Zhou 2008): each tree is grown on a fixed-size
sample (256 values), so building costs the same at any scale.  Samples are
drawn by hash per (row number, tree) without exploding the table; the trees
are grown by ``groupBy(tree).applyInPandas`` and, being tiny (at most 511
nodes each), collected.  A forest's score of one value is a step function of
it, so its edges (every split of every tree) and steps are broadcast to a
pandas UDF that looks each value up.

Local outlier factor in one dimension (Breunig et al. 2000): the k nearest
neighbours of a value are among the k values on either side in sorted
order.  Rows are cut into value-defined range buckets; every bucket also
receives a halo of 3k rows from each neighbouring bucket (neighbours,
their k-distances and their densities need up to 3k positions), and each
bucket is scored by ``applyInPandas``.  Exact, with each task bounded by
its bucket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from loadlens.operators.ordering import row_index, stored
from loadlens.operators.quantiles import long_quantiles, long_values  # noqa: F401  long_values is part of the interface

SAMPLE_SIZE = 256
# Rows of a column whose LOF one task computes at a time.
BLOCK_ROWS = 20_000
N_TREES = 100
# Added to a mean reachability distance, so that repeated values have a density.
EPS = 1e-10
# A score is an outlier's if it exceeds the cut by more than the rounding of sums in another order.
ROUNDING = 1e-9


def _c(n):
    """Average unsuccessful-search path length of a BST with n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2 * (np.log(n[big] - 1) + np.euler_gamma) - 2 * (n[big] - 1) / n[big]
    out[n == 2] = 1.0
    return out


def _grow(values: np.ndarray, rng: np.random.Generator, limit: int):
    """One 1-D isolation tree as flat arrays (split, left, right, size, depth)."""
    split, left, right, size, depth = [], [], [], [], []

    def node(v, d):
        i = len(split)
        split.append(np.nan)
        left.append(-1)
        right.append(-1)
        size.append(len(v))
        depth.append(d)
        lo, hi = (v.min(), v.max()) if len(v) else (0.0, 0.0)
        if d >= limit or len(v) <= 1 or lo == hi:
            return i
        s = rng.uniform(lo, hi)
        split[i] = s
        li = node(v[v < s], d + 1)
        ri = node(v[v >= s], d + 1)
        left[i], right[i] = li, ri
        return i
    node(values, 0)
    return (np.array(split), np.array(left), np.array(right), np.array(size, dtype=float), np.array(depth, dtype=float))


def _path_length(x: np.ndarray, tree) -> np.ndarray:
    split, left, right, size, depth = tree
    node = np.zeros(len(x), dtype=int)
    while True:
        inner = left[node] >= 0
        if not inner.any():
            break
        go_left = x < split[node]
        nxt = np.where(go_left, left[node], right[node])
        node = np.where(inner, nxt, node)
    return depth[node] + _c(size[node])


def numbered(long: DataFrame, key: str = "test_id") -> DataFrame:
    """``long`` with each row's position among its column's values in ``_i``, stored; as it is if it has them already.

    Detectors that work on the same rows share one numbering.
    """
    if "_i" in long.columns:
        return long
    return stored(row_index(long, ["value", key], ["column"], name="_i"), "numbered-values")


def drawn_numbers(spark: SparkSession, n: int, n_trees: int = N_TREES, sample_size: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """``(_n, _i, tree)``: the row numbers below ``n`` that form each tree's sample."""
    threshold = int(min(1.0, 2.0 * sample_size / max(n, 1)) * 2 ** 31)
    pairs = spark.range(n).select(F.col("id").alias("_i"), F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree"))
    hashed = pairs.withColumn("_h", F.xxhash64("_i", "tree", F.lit(seed))).where(F.pmod("_h", F.lit(2 ** 31)) < threshold)
    smallest = F.row_number().over(Window.partitionBy("tree").orderBy("_h", "_i"))
    return hashed.withColumn("_r", smallest).where(F.col("_r") <= sample_size).select(F.lit(n).cast("long").alias("_n"), "_i", "tree")


def fit_isolation_forest(long: DataFrame, key: str = "test_id", n_trees: int = N_TREES,
                         sample_size: int = SAMPLE_SIZE, seed: int = 42) -> dict:
    """Trees per column, grown on hash-drawn samples of ``sample_size`` values.

    ``long`` is (key, column, value).  Rows are numbered in value order, so
    that rows with one key are drawn apart.  A draw is a hash of the number and
    the tree, so the sample is known before any row is read: each (number,
    tree) pair is kept with probability ~2*psi/n of its column (pairs are made
    and dropped within one scan of the numbers, once for columns of one
    length), the psi smallest hashes per tree form the sample (a window bounded
    by ~2*psi rows), and its numbers meet the rows in a broadcast join.  All
    trees of all columns grow in one ``applyInPandas``.  Returns
    {column: {"psi", "trees"}}.
    """
    counts = {r["column"]: r["n"] for r in long.groupBy("column").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    limit = int(math.ceil(math.log2(sample_size)))
    long = numbered(long, key)
    length = F.element_at(F.create_map(*[x for c, n in counts.items() for x in (F.lit(c), F.lit(n).cast("long"))]), F.col("column"))
    drawn = reduce(DataFrame.unionByName, [drawn_numbers(long.sparkSession, n, n_trees, sample_size, seed) for n in sorted(set(counts.values()))])
    picked = long.withColumn("_n", length).join(F.broadcast(drawn), ["_n", "_i"]).select("column", "tree", "value")

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(seed * 1000003 + t)
        s, lft, rgt, sz, dp = _grow(pdf["value"].to_numpy(dtype=float), rng, limit)
        return pd.DataFrame({"column": [pdf["column"].iloc[0]], "tree": [t], "split": [s.tolist()],
                             "left": [lft.tolist()], "right": [rgt.tolist()], "size": [sz.tolist()],
                             "depth": [dp.tolist()]})
    schema = ("column string, tree int, split array<double>, left array<int>, right array<int>, "
              "size array<double>, depth array<double>")
    rows = picked.groupBy("column", "tree").applyInPandas(grow, schema).collect()
    trees = {c: {"psi": min(sample_size, n), "trees": []} for c, n in counts.items()}
    for r in sorted(rows, key=lambda r: (r["column"], r["tree"])):
        trees[r["column"]]["trees"].append(tuple(
            np.array(r[c], dtype=float if c in ("split", "size", "depth") else int)
            for c in ("split", "left", "right", "size", "depth")))
    return trees


def score_steps(trees: Sequence[tuple], psi: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest's score s = 2^(-E[h(x)] / c(psi)) of one value, which is a step function: its sorted edges, and the score on each step."""
    splits = np.concatenate([t[0][t[1] >= 0] for t in trees])
    edges = np.unique(splits[~np.isnan(splits)])
    h = np.mean([_path_length(np.concatenate([[-np.inf], edges]), t) for t in trees], axis=0)
    return edges, 2.0 ** (-h / _c(np.array([psi]))[0])


def isolation_scores(long: DataFrame, forest: dict) -> DataFrame:
    """Anomaly score per (key, column, value); columns without trees have NaN."""
    names = [c for c, f in forest.items() if f["trees"]]
    bc = long.sparkSession.sparkContext.broadcast([score_steps(forest[c]["trees"], forest[c]["psi"]) for c in names])
    place = F.array_position(F.array(*[F.lit(c) for c in names]), F.col("column")) if names else F.lit(0)

    @F.pandas_udf("double")
    def score(at: pd.Series, val: pd.Series) -> pd.Series:
        at, x, out = at.to_numpy(), val.to_numpy(dtype=float), np.full(len(val), np.nan)
        for i, (edges, scores) in enumerate(bc.value, 1):
            m = at == i
            out[m] = scores[np.searchsorted(edges, x[m], "right")]
        return pd.Series(out)
    return long.withColumn("iforest_score", score(F.coalesce(place, F.lit(0)).cast("int"), F.col("value")))


def isolation_forest(long: DataFrame, key: str = "test_id", contamination: float = 0.1, seed: int = 42) -> DataFrame:
    """AN2a: scores and outlier flag (score above its (1-contamination) quantile)."""
    return flagged_forest(long, fit_isolation_forest(long, key, seed=seed), contamination)


def flagged_forest(long: DataFrame, forest: dict, contamination: float = 0.1) -> DataFrame:
    """Forest scores and outlier flag of the rows, with the cut of their own scores."""
    return _flagged(stored(isolation_scores(long, forest), "forest-scores"), "iforest_score", "iforest_outlier", contamination)


def _lof_block(values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """LOF, k-distance and reachability density of every value of a sorted block (self excluded from its neighbours)."""
    n = len(values)
    if n <= 1:
        return np.ones(n), np.zeros(n), np.full(n, 1.0 / EPS)
    kk = min(k, n - 1)
    offs = np.concatenate([np.arange(-kk, 0), np.arange(1, kk + 1)])
    pos = np.arange(n)[:, None] + offs[None, :]
    valid = (pos >= 0) & (pos < n)
    posc = np.clip(pos, 0, n - 1)
    dist = np.where(valid, np.abs(values[posc] - values[:, None]), np.inf)
    order = np.argsort(dist, axis=1, kind="stable")[:, :kk]
    nb = np.take_along_axis(posc, order, axis=1)
    nd = np.take_along_axis(dist, order, axis=1)
    kdist = nd[:, -1]
    reach = np.maximum(kdist[nb], nd)
    lrd = 1.0 / (reach.mean(axis=1) + EPS)
    return lrd[nb].mean(axis=1) / lrd, kdist, lrd


def blocks_with_halo(rows: DataFrame, halo: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Numbered rows with their own block ``_own``, once per block ``_home`` that they lie in or within ``halo`` rows of."""
    size = max(block_rows, halo)
    at, home = F.col("_i") % size, F.floor(F.col("_i") / size).cast("long")
    homes = F.filter(F.array(home, F.when(at < halo, home - 1), F.when(at >= size - halo, home + 1)),
                     lambda h: h.isNotNull() & (h >= 0))
    return rows.select("*", home.alias("_own"), F.explode(homes).alias("_home"))


def local_outlier_factor(long: DataFrame, key: str = "test_id", k: int = 20, contamination: float = 0.1,
                         block_rows: int = BLOCK_ROWS) -> DataFrame:
    """AN2b: exact 1-D LOF of each row of ``long``, whose other columns are kept.

    The values of a column are numbered in order and cut into blocks of equal
    length; a row also goes to the neighbouring block if it lies within 3k rows
    of it, which is as far as a value's LOF can see.
    """
    kept = [c for c in long.columns if c != "_i"]
    dealt = blocks_with_halo(numbered(long, key), 3 * k, block_rows).select(*kept, "_i", "_own", "_home")

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i", kind="stable").reset_index(drop=True)
        pdf["lof"] = _lof_block(pdf["value"].to_numpy(dtype=float), k)[0]
        return pdf[pdf["_own"] == pdf["_home"]][[*kept, "lof"]]
    scored = stored(dealt.groupBy("column", "_home").applyInPandas(
        score, StructType([*[long.schema[c] for c in kept], StructField("lof", DoubleType())])), "lof")
    return _flagged(scored, "lof", "lof_outlier", contamination)


def _flagged(scored: DataFrame, score: str, flag: str, contamination: float) -> DataFrame:
    """``flag``: the score lies above the column's (1 - contamination) quantile."""
    cut = long_quantiles(scored, ["column"], score, [1 - contamination])
    return scored.withColumn(flag, above({c: v for (c, _), v in cut.items()}, score))


def above(cuts: dict, score: str):
    """Whether the score of a row's column lies above the column's cut, by more than rounding."""
    pairs = [x for c, v in cuts.items() for x in (F.lit(c), F.lit(float(v)))]
    threshold = F.element_at(F.create_map(*pairs), F.col("column")) if pairs else F.lit(None).cast("double")
    return F.col(score) > threshold * (1 + ROUNDING)
