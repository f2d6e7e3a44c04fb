"""Feature scaling (SC1, SC2) with the reference's conventions.

Standard scaling divides by the *population* std, min-max maps a constant
column to 0 and robust scaling uses the median and IQR; a zero divisor
becomes 1 and nulls stay null.  ``fit_scaler`` runs one aggregate (plus the
distributed quantiles for ``robust``) and returns a small stats table that
``apply_scaler`` turns into one projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.operators.quantiles import quantile_table
from loadlens.schema import numeric_columns

# Columns never scaled.
SCALE_EXCLUDE = ["id", "concurrent_users", "duration", "timestamp", "time_since_epoch",
                 "failure_target", "reliability_target", "performance_target", "anomaly_target"]
METHODS = ("standard", "minmax", "robust")


def scalable_columns(df: DataFrame) -> list[str]:
    return numeric_columns(df, exclude=SCALE_EXCLUDE)


def fit_scaler(df: DataFrame, method: str = "standard", columns: Sequence[str] | None = None) -> DataFrame:
    """Stats table (column, center, scale) for ``method``."""
    if method not in METHODS:
        raise ValueError(f"Unknown scaling method: {method}")
    cols = list(columns) if columns is not None else scalable_columns(df)
    rows = []
    if method == "robust":
        q = quantile_table(df, cols, [0.25, 0.5, 0.75])
        for c in cols:
            if (c, 0.5) in q:
                iqr = q[(c, 0.75)] - q[(c, 0.25)]
                rows.append((c, q[(c, 0.5)], iqr if iqr != 0 else 1.0))
    else:
        aggs = []
        for c in cols:
            x = F.col(c).cast("double")
            if method == "standard":
                aggs += [F.avg(x).alias(f"{c}|a"), F.stddev_pop(x).alias(f"{c}|b")]
            else:
                aggs += [F.min(x).alias(f"{c}|a"), (F.max(x) - F.min(x)).alias(f"{c}|b")]
        r = df.agg(*aggs).first().asDict() if aggs else {}
        for c in cols:
            a, b = r[f"{c}|a"], r[f"{c}|b"]
            if a is None:
                continue
            rows.append((c, a, b if b not in (None, 0) else 1.0))
    return df.sparkSession.createDataFrame(rows, "column string, center double, scale double")


def apply_scaler(df: DataFrame, stats: DataFrame) -> DataFrame:
    """(x - center) / scale for every column in the stats table (SC2 reuse)."""
    st = {r["column"]: (r["center"], r["scale"]) for r in stats.collect()}
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(a)) / F.lit(b)
                           for c, (a, b) in st.items() if c in df.columns})


def normalize_features(df: DataFrame, method: str = "standard"):
    """(scaled frame, fitted stats) - SC1."""
    stats = fit_scaler(df, method)
    return apply_scaler(df, stats), stats
