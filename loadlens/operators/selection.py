"""Univariate feature selection (FS1 F-test, FS2 binned mutual information)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.operators.filters import mean_impute, sparse_columns
from loadlens.operators.quantiles import quantile_table
from loadlens.schema import numeric_columns


def candidate_features(df: DataFrame, target: str) -> list[str]:
    cols = numeric_columns(df, exclude=[target])
    sparse = set(sparse_columns(df, cols))
    return [c for c in cols if c not in sparse]


def f_regression_scores(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """F = r^2/(1-r^2)*(n-2) per feature after mean imputation (one aggregate)."""
    cols = list(columns) if columns is not None else candidate_features(df, target)
    d = mean_impute(df, cols)
    r = d.agg(F.count(target).alias("_n"),
              *[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols]).first()
    n = r["_n"]
    rows = []
    for c in cols:
        rho = r[c]
        f = None
        if rho is not None and not math.isnan(rho) and rho * rho < 1:
            f = rho * rho / (1 - rho * rho) * (n - 2)
        rows.append((c, f))
    return df.sparkSession.createDataFrame(rows, "feature string, score double")


def mutual_info_scores(df: DataFrame, target: str, columns: Sequence[str] | None = None,
                       bins: int = 10) -> DataFrame:
    """Quantile-binned mutual information (nats) of each feature with the target.

    Bin edges are exact quantiles (k/bins); a value's bin is the number of
    interior edges strictly below it.  Counts come from one ``groupBy``
    of (feature, x_bin, y_bin) over the unpivoted table.
    """
    cols = list(columns) if columns is not None else candidate_features(df, target)
    d = mean_impute(df, cols).where(F.col(target).isNotNull())
    probs = [k / bins for k in range(1, bins)]
    q = quantile_table(d, [*cols, target], probs)

    def binned(c):
        e = F.lit(0)
        for p in probs:
            e = e + (F.col(c).cast("double") > F.lit(q[(c, p)])).cast("int")
        return e
    long = d.select(binned(target).alias("yb"), *[binned(c).alias(c) for c in cols]).unpivot(
        ["yb"], cols, "feature", "xb")
    joint = long.groupBy("feature", "xb", "yb").agg(F.count("*").alias("nxy"))
    from pyspark.sql import Window
    wf = Window.partitionBy("feature")
    j = (joint.withColumn("n", F.sum("nxy").over(wf))
              .withColumn("nx", F.sum("nxy").over(Window.partitionBy("feature", "xb")))
              .withColumn("ny", F.sum("nxy").over(Window.partitionBy("feature", "yb"))))
    term = (F.col("nxy") / F.col("n")) * F.log((F.col("nxy") * F.col("n")) / (F.col("nx") * F.col("ny")))
    return j.groupBy("feature").agg(F.sum(term).alias("score"))


def select_features(df: DataFrame, target: str, method: str = "mutual_info", k: int = 20):
    """(frame of the top-k features + target, ranking table)."""
    if method == "f_regression":
        sc = f_regression_scores(df, target)
    elif method == "mutual_info":
        sc = mutual_info_scores(df, target)
    else:
        raise ValueError(f"Unknown feature selection method: {method}")
    ranked = sc.orderBy(F.col("score").desc_nulls_last(), F.col("feature")).limit(k)
    names = [r["feature"] for r in ranked.collect()]
    return df.select(*names, target), ranked
