"""Detectors that are fitted once, kept as tables and applied to new runs (AN2, AN2a-c, AN3).

``fit`` writes a folder with

* ``constants``: per column the statistical thresholds, the robust envelope and
  the cuts of the forest and the outlier factor on the rows fitted;
* ``forest``: one row per column and isolation tree;
* ``blocks``: the sorted training values of a column in blocks, each with the
  values next to it on both sides, and every value's k-distance and density.

``score`` applies them to another frame of any size.  The outlier factor of a
new value compares it with its k nearest training values (the new rows
themselves never count as neighbours).  To find a value's block the distinct
new values are sorted together with the blocks' first values, of which there
is one in many thousands of training rows; then values meet their block in an
equi-join, in chunks, so that neither a block that draws many values nor a
value that repeats is one task's work.  Values that repeat are scored once.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.operators import anomaly as AN
from loadlens.operators import detectors as DT
from loadlens.operators.ordering import join_keys, running, stored
from loadlens.operators.profile import thresholds
from loadlens.operators.quantiles import long_quantiles, quantile_table

# Neighbours of the outlier factor, and the distinct new values that one task compares with a block at a time.
NEIGHBOURS, CHUNK = 20, 20_000
CONSTANTS = ("column string, mean double, std double, z_score_3 double, iqr_upper double, iqr_lower double, "
             "median double, scale double, cutoff double, forest_cut double, lof_cut double, n long")
_BLOCK = ("column string, block long, first double, values array<double>, kdist array<double>, lrd array<double>, own array<double>, "
          "lof array<double>")


def training_blocks(rows: DataFrame, k: int = NEIGHBOURS, block_rows: int = DT.BLOCK_ROWS) -> DataFrame:
    """One row per block of numbered training values, with what scoring needs of it and of 2k values on either side.

    ``own`` and ``lof`` are the block's distinct values and their factors.
    """

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_i", kind="stable")
        v, home = pdf["value"].to_numpy(float), pdf["_home"].iloc[0]
        lof, kdist, lrd = DT._lof_block(v, k)
        own = np.flatnonzero((pdf["_own"] == home).to_numpy())
        if not len(own):
            return pd.DataFrame(columns=[c.split()[0] for c in _BLOCK.split(", ")], dtype=object)
        near = slice(max(0, own[0] - 2 * k), own[-1] + 1 + 2 * k)
        return pd.DataFrame({"column": [pdf["column"].iloc[0]], "block": [home], "first": [v[own[0]]],
                             "values": [v[near]], "kdist": [kdist[near]], "lrd": [lrd[near]], "own": [v[own]], "lof": [lof[own]]})
    dealt = DT.blocks_with_halo(rows.select("column", "value", "_i"), 5 * k, block_rows)   # 3k beyond the 2k that are kept
    return dealt.groupBy("column", "_home").applyInPandas(pack, _BLOCK)


def novelty_factor(x: np.ndarray, values: np.ndarray, kdist: np.ndarray, lrd: np.ndarray, k: int) -> np.ndarray:
    """Local outlier factor of new values against sorted training values."""
    kk = min(k, len(values))
    at = np.searchsorted(values, x, "left")[:, None] + np.arange(-kk, kk)
    near = np.clip(at, 0, len(values) - 1)
    d = np.where((at >= 0) & (at < len(values)), np.abs(values[near] - x[:, None]), np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :kk]
    near, d = np.take_along_axis(near, order, axis=1), np.take_along_axis(d, order, axis=1)
    density = 1.0 / (np.maximum(kdist[near], d).mean(axis=1) + DT.EPS)
    return lrd[near].mean(axis=1) / density


def fit(df: DataFrame, columns: Sequence[str], folder: str, key: str = "test_id", contamination: float = 0.1,
        k: int = NEIGHBOURS, block_rows: int = DT.BLOCK_ROWS, seed: int = 42) -> str:
    """Fit all detectors on ``df`` and keep them under ``folder``; columns with fewer than 10 values are skipped."""
    spark = df.sparkSession
    long = AN.metric_values(df, columns, key)
    counts = {r["column"]: r["count"] for r in long.groupBy("column").count().collect()}
    columns = [c for c in columns if counts.get(c, 0) >= AN.MIN_VALUES]
    rows = DT.numbered(long.where(F.col("column").isin(columns)), key)
    forest = DT.fit_isolation_forest(rows, key, seed=seed)
    spark.createDataFrame([(c, t, f["psi"], *[a.tolist() for a in tree]) for c, f in forest.items() for t, tree in enumerate(f["trees"])],
                          "column string, tree int, psi long, split array<double>, left array<int>, right array<int>, "
                          "size array<double>, depth array<double>").write.parquet(f"{folder}/forest")
    training_blocks(rows, k, block_rows).write.parquet(f"{folder}/blocks")
    lofs = spark.read.parquet(f"{folder}/blocks").select("column", F.explode("lof").alias("lof"))
    scores = DT.isolation_scores(rows.select("column", "value"), forest)
    at = 1 - contamination
    both = (lofs.select(F.lit("lof_cut").alias("cut"), "column", F.col("lof").alias("score"))
            .unionByName(scores.select(F.lit("forest_cut").alias("cut"), "column", F.col("iforest_score").alias("score"))))
    cuts = long_quantiles(stored(both, "training-scores"), ["cut", "column"], "score", [at])
    q = quantile_table(df, columns, [0.25, 0.5, 0.75])
    th, robust = thresholds(df, columns, q=q), AN.fit_robust(df, columns, contamination, q=q)
    out = []
    for c in columns:
        row = th[c] | robust[c] | {cut: cuts[(cut, c, at)] for cut in ("lof_cut", "forest_cut")} | {"column": c, "n": counts[c]}
        out.append(tuple(row[f.split()[0]] for f in CONSTANTS.split(", ")))
    spark.createDataFrame(out, CONSTANTS).write.parquet(f"{folder}/constants")
    return folder


def _forest(spark: SparkSession, folder: str) -> dict:
    out: dict = {}
    for r in spark.read.parquet(f"{folder}/forest").orderBy("column", "tree").collect():    # trees of at most 511 nodes
        tree = tuple(np.array(r[c], float if c in ("split", "size", "depth") else int) for c in ("split", "left", "right", "size", "depth"))
        out.setdefault(r["column"], {"psi": r["psi"], "trees": []})["trees"].append(tree)
    return out


def outlier_factors(new: DataFrame, blocks: DataFrame, k: int = NEIGHBOURS, chunk: int = CHUNK) -> DataFrame:
    """``(column, value, lof)`` of the distinct values of ``new`` (column, value) against kept training blocks."""
    values = new.select("column", "value").distinct()
    starts = blocks.select("column", F.col("first").alias("value"), "block")
    both = (values.select("column", "value", F.lit(None).cast("long").alias("block"), F.lit(1).alias("_new"))
            .unionByName(starts.withColumn("_new", F.lit(0))))
    first = starts.groupBy("column").agg(F.min("block").alias("_least"))
    # a block begins at its first value, so values equal to it come after; numbers rise with the values
    placed = (running(both, ["value", "_new", "block"], ["column"], {"_block": ("max", "block")}).where("_new = 1")
              .join(first, "column").select("column", "value", F.coalesce("_block", "_least").alias("block")))
    placed = stored(placed, "placed-values")
    sizes = placed.groupBy("column", "block").agg(F.ceil(F.count("*") / F.lit(chunk)).cast("long").alias("_parts"))
    chunks = (placed.join(sizes, ["column", "block"])
              .withColumn("_part", F.pmod(F.xxhash64("value"), F.col("_parts")))
              .groupBy("column", "block", "_part").agg(F.collect_list("value").alias("x")))     # about ``chunk`` values
    pairs = chunks.join(blocks.select("column", "block", "values", "kdist", "lrd"), ["column", "block"])

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        x = np.asarray(r["x"], float)
        lof = novelty_factor(x, *(np.asarray(r[c], float) for c in ("values", "kdist", "lrd")), k)
        return pd.DataFrame({"column": r["column"], "value": x, "lof": lof})
    return pairs.groupBy("column", "block", "_part").applyInPandas(score, "column string, value double, lof double")


def score(df: DataFrame, folder: str, key: str = "test_id", carry: Sequence[str] = (), columns: Sequence[str] | None = None,
          k: int = NEIGHBOURS) -> DataFrame:
    """AN2 + AN3 on new runs: a row per (key, column, value) with scores, the three votes and the ensemble's verdict.

    Columns are those of the kept detectors that ``df`` has; null and NaN values have no row.
    """
    spark = df.sparkSession
    kept = {r["column"]: r.asDict() for r in spark.read.parquet(f"{folder}/constants").collect()}      # a row per column
    columns = [c for c in (columns or kept) if c in kept and c in df.columns]
    kept = {c: kept[c] for c in columns}
    long = AN.metric_values(df, columns, key, carry).where(~F.isnan("value"))
    blocks = spark.read.parquet(f"{folder}/blocks").where(F.col("column").isin(columns))
    scored = join_keys(long, stored(outlier_factors(long, blocks, k), "new-factors"), ["column", "value"])
    scored = DT.isolation_scores(scored, _forest(spark, folder))
    scored = AN.robust_distance(AN.statistical_flags(scored, kept), kept)
    scored = scored.withColumns({
        "v_forest": (~DT.above({c: r["forest_cut"] for c, r in kept.items()}, "iforest_score")).cast("int"),
        "v_lof": (~DT.above({c: r["lof_cut"] for c, r in kept.items()}, "lof")).cast("int"),
        "v_envelope": (~F.col("robust_outlier")).cast("int")})
    return AN.vote(scored, ["v_forest", "v_lof", "v_envelope"])
