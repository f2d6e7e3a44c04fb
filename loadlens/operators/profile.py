"""Column profiles and thresholds (A3, A4, A5, DR3 input).

Moments come from one wide aggregate (no row explosion); quantiles from
the distributed exact helper.  Results are tidy: one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.operators.quantiles import quantile_table
from loadlens.schema import numeric_columns

PROFILE_SCHEMA = ("column string, mean double, std double, min double, max double, median double, "
                  "q25 double, q75 double, count long")


def _moments(df: DataFrame, cols: Sequence[str], pop: bool = False) -> dict:
    if not cols:
        return {}
    std = F.stddev_pop if pop else F.stddev_samp
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}|mean"), std(x).alias(f"{c}|std"), F.min(x).alias(f"{c}|min"),
                 F.max(x).alias(f"{c}|max"), F.count(x).alias(f"{c}|count")]
    r = df.agg(*aggs).first().asDict()
    return {c: {k: r[f"{c}|{k}"] for k in ("mean", "std", "min", "max", "count")} for c in cols}


def column_stats(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> dict:
    """Fitted constants {column: {mean, std, min, max, median, q25, q75, count}} (A3).

    Sample std; nulls dropped; columns without values omitted.
    """
    cols = list(columns) if columns is not None else numeric_columns(df)
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return {}
    m = _moments(df, cols)
    q = quantile_table(df, cols, [0.25, 0.5, 0.75], approx=approx)
    out = {}
    for c in cols:
        if not m[c]["count"]:
            continue
        out[c] = dict(m[c], median=q.get((c, 0.5)), q25=q.get((c, 0.25)), q75=q.get((c, 0.75)))
    return out


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """A3 as a tidy DataFrame: one row per column."""
    st = column_stats(df, columns, approx)
    rows = [(c, s["mean"], s["std"], s["min"], s["max"], s["median"], s["q25"], s["q75"], int(s["count"]))
            for c, s in st.items()]
    return df.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def thresholds(df: DataFrame, columns: Sequence[str], approx: bool = False, q: dict | None = None) -> dict:
    """Statistical thresholds per column (A4): population std, z and IQR bounds; ``q`` holds quantiles that are known already."""
    cols = [c for c in columns if c in df.columns]
    m = _moments(df, cols, pop=True)
    q = q or quantile_table(df, cols, [0.25, 0.75], approx=approx)
    out = {}
    for c in cols:
        if not m[c]["count"]:
            continue
        mean, std = m[c]["mean"], m[c]["std"]
        q1, q3 = q[(c, 0.25)], q[(c, 0.75)]
        out[c] = {"mean": mean, "std": std, "z_score_2": mean + 2 * std, "z_score_3": mean + 3 * std,
                  "iqr_upper": q3 + 1.5 * (q3 - q1), "iqr_lower": q1 - 1.5 * (q3 - q1), "count": m[c]["count"]}
    return out


def thresholds_frame(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    th = thresholds(df, columns, approx)
    rows = [(c, t["mean"], t["std"], t["z_score_2"], t["z_score_3"], t["iqr_upper"], t["iqr_lower"])
            for c, t in th.items()]
    return df.sparkSession.createDataFrame(
        rows, "column string, mean double, std double, z_score_2 double, z_score_3 double, "
              "iqr_upper double, iqr_lower double")


# The key metrics of a data summary.
KEY_METRICS = ["avg_response_time", "requests_per_sec", "error_rate"]


def data_summary(df: DataFrame, time_col: str = "timestamp", approx: bool = False) -> DataFrame:
    """Dataset summary (A5): one row per key metric with the table-level facts.

    Columns: metric, mean, median, std, min, max, total_records, start, end,
    numerical, categorical, total_columns, missing_values (all columns).
    """
    from pyspark.sql import types as T
    metrics = [c for c in KEY_METRICS if c in df.columns]
    aggs = [F.count("*").alias("n"),
            *[F.count_if(F.col(c).isNull()).alias(f"null|{c}") for c in df.columns]]
    if time_col in df.columns:
        aggs += [F.min(time_col).alias("start"), F.max(time_col).alias("end")]
    top = df.agg(*aggs).first().asDict()
    st = column_stats(df, metrics, approx)
    numer = sum(isinstance(f.dataType, T.NumericType) for f in df.schema.fields)
    categ = sum(isinstance(f.dataType, T.StringType) for f in df.schema.fields)
    missing = sum(int(top[f"null|{c}"]) for c in df.columns)
    fmt = (lambda v: v.strftime("%Y-%m-%dT%H:%M:%S") if v is not None else None)
    rows = [(c, s["mean"], s["median"], s["std"], s["min"], s["max"], int(top["n"]),
             fmt(top.get("start")), fmt(top.get("end")), numer, categ, len(df.columns), missing)
            for c, s in st.items()]
    return df.sparkSession.createDataFrame(
        rows, "metric string, mean double, median double, std double, min double, max double, "
              "total_records long, start string, end string, numerical int, categorical int, "
              "total_columns int, missing_values long")
