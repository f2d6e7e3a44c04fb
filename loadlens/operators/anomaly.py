"""Anomaly detection over run metrics (AN1, AN2c, AN3-AN5, A8).

Detectors are fitted once per column (one aggregate + exact quantiles,
all fitted constants), then applied as Column predicates on an unpivoted
``(test_id, column, value)`` table, so scoring is one codegen'd pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.operators.profile import thresholds
from loadlens.operators import detectors
from loadlens.operators.quantiles import long_quantiles, long_values, quantile_table

# Alert recommendations.
ALERT_RECOMMENDATIONS = [
    "Review recent system changes",
    "Check for infrastructure issues",
    "Consider model retraining",
    "Monitor system resources",
]


# A column needs this many values for its detectors to vote.
MIN_VALUES = 10


def _by_column(mapping: dict, key: str) -> Column:
    """Literal lookup column -> value (bounded by the number of columns)."""
    pairs = [x for c, v in mapping.items() if v is not None for x in (F.lit(c), F.lit(float(v)))]
    if not pairs:
        return F.lit(None).cast("double")
    return F.element_at(F.create_map(*pairs), F.col("column"))


def metric_values(df: DataFrame, columns: Sequence[str], key: str = "test_id", carry: Sequence[str] = ()) -> DataFrame:
    """(key, carried columns, column, value) rows for non-null values."""
    return long_values(df, columns, [key, *carry]).where(F.col("value").isNotNull())


def statistical_flags(long: DataFrame, th: dict) -> DataFrame:
    """AN1: value > mean + 3 std (population) or value < Q1 - 1.5 IQR."""
    z3 = _by_column({c: t["z_score_3"] for c, t in th.items()}, "column")
    low = _by_column({c: t["iqr_lower"] for c, t in th.items()}, "column")
    return long.withColumns({
        "z_score_3": z3,
        "statistical": (F.col("value") > z3) | (F.col("value") < low),
        "threshold_exceeded": F.col("value") > z3})


def fit_robust(df: DataFrame, columns: Sequence[str], contamination: float = 0.1, q: dict | None = None) -> dict:
    """AN2c fit: median, MAD and the (1-contamination) quantile of the robust distance.

    One-dimensional robust envelope: d = |x - median| / (1.4826 * MAD),
    MAD = median |x - median| (1 when 0); outliers are d above the
    contamination quantile of the fitted d.  ``q`` holds medians that are known already.
    """
    med = q or quantile_table(df, columns, [0.5])
    long = metric_values(df.select(*columns).withColumn("test_id", F.lit(0)), columns)
    mcol = _by_column({c: med.get((c, 0.5)) for c in columns}, "column")
    dev = long.withColumn("dev", F.abs(F.col("value") - mcol))
    mad = long_quantiles(dev, ["column"], "dev", [0.5])
    fit = {}
    for c in columns:
        m = med.get((c, 0.5))
        if m is None:
            continue
        s = mad.get((c, 0.5)) or 1.0
        fit[c] = {"median": m, "scale": 1.4826 * s}
    scale = _by_column({c: f["scale"] for c, f in fit.items()}, "column")
    center = _by_column({c: f["median"] for c, f in fit.items()}, "column")
    dist = long.withColumn("d", F.abs(F.col("value") - center) / scale)
    cut = long_quantiles(dist, ["column"], "d", [1 - contamination])
    for c in fit:
        fit[c]["cutoff"] = cut.get((c, 1 - contamination))
    return fit


def robust_distance(long: DataFrame, fit: dict) -> DataFrame:
    """AN2c apply: distance and outlier flag per (key, column, value)."""
    center = _by_column({c: f["median"] for c, f in fit.items()}, "column")
    scale = _by_column({c: f["scale"] for c, f in fit.items()}, "column")
    cut = _by_column({c: f["cutoff"] for c, f in fit.items()}, "column")
    d = F.abs(F.col("value") - center) / scale
    return long.withColumns({"distance": d, "robust_outlier": d > cut})


def vote(long: DataFrame, votes: Sequence[str]) -> DataFrame:
    """AN3: detectors vote normal=1; anomaly if mean vote < 0.5; OR statistical."""
    mean_vote = sum((F.col(v).cast("double") for v in votes), F.lit(0.0)) / float(len(votes))
    return long.withColumns({"model_consensus": mean_vote,
                             "is_anomaly": (mean_vote < 0.5) | F.col("statistical")})


def ensemble(df: DataFrame, columns: Sequence[str], key: str = "test_id", contamination: float = 0.1,
             carry: Sequence[str] = ()) -> DataFrame:
    """AN2 + AN3: isolation forest, local outlier factor and robust envelope vote; OR the statistical rule.

    One frame, a row per value, without joins on the key (keys may repeat).
    Columns with fewer than 10 values are skipped.
    """
    long = metric_values(df, columns, key, carry)
    counts = {r["column"]: r["count"] for r in long.groupBy("column").count().collect()}
    columns = [c for c in columns if counts.get(c, 0) >= MIN_VALUES]
    long = long.where(F.col("column").isin(columns)) if columns else long.limit(0)
    rows = detectors.numbered(long, key)                        # both detectors work on this numbering
    scored = detectors.local_outlier_factor(rows, key, contamination=contamination)
    forest = detectors.fit_isolation_forest(rows, key)
    scored = detectors.flagged_forest(scored, forest, contamination)
    q = quantile_table(df, columns, [0.25, 0.5, 0.75])
    scored = robust_distance(statistical_flags(scored, thresholds(df, columns, q=q)), fit_robust(df, columns, contamination, q=q))
    flags = {"v_forest": "iforest_outlier", "v_lof": "lof_outlier", "v_envelope": "robust_outlier"}
    return vote(scored.withColumns({v: (~F.col(f)).cast("int") for v, f in flags.items()}), list(flags))


def detect(df: DataFrame, columns: Sequence[str], key: str = "test_id", contamination: float = 0.1,
           carry: Sequence[str] = ()) -> DataFrame:
    """The same vote from detectors that SQL can express; one row per (key, column, value).

    Votes: robust envelope (AN2c), IQR fence and 3-sigma z-score.
    """
    q = quantile_table(df, columns, [0.25, 0.5, 0.75])
    th = thresholds(df, columns, q=q)
    fit = fit_robust(df, columns, contamination, q=q)
    long = metric_values(df, columns, key, carry)
    long = robust_distance(statistical_flags(long, th), fit)
    mean = _by_column({c: t["mean"] for c, t in th.items()}, "column")
    std = _by_column({c: t["std"] for c, t in th.items()}, "column")
    up = _by_column({c: t["iqr_upper"] for c, t in th.items()}, "column")
    low = _by_column({c: t["iqr_lower"] for c, t in th.items()}, "column")
    long = long.withColumns({
        "v_robust": (~F.col("robust_outlier")).cast("int"),
        "v_iqr": ((F.col("value") >= low) & (F.col("value") <= up)).cast("int"),
        "v_z": F.coalesce(F.abs(F.col("value") - mean) <= 3 * std, F.lit(True)).cast("int")})
    return vote(long, ["v_robust", "v_iqr", "v_z"])


def anomaly_log(scored: DataFrame, key: str = "test_id", time_col: str | None = None) -> DataFrame:
    """AN4: the anomaly log records (one per anomalous value)."""
    cols = [key, "column", "value", "threshold_exceeded", "model_consensus"]
    if time_col:
        cols.append(time_col)
    return scored.where(F.col("is_anomaly")).select(*cols)


def anomaly_rates(scored: DataFrame) -> DataFrame:
    """Per column: anomaly count and rate over non-null values."""
    return scored.groupBy("column").agg(
        F.count_if("is_anomaly").alias("anomaly_count"),
        (F.count_if("is_anomaly") / F.count("*")).alias("anomaly_rate"))


def anomaly_alerts(rates: DataFrame, alert_threshold: float = 0.1, by: Sequence[str] = ()) -> DataFrame:
    """AN5: alert per column (and ``by``, as a time window) with a rate above the threshold."""
    msg = F.format_string("High anomaly rate detected in %s: %.2f%%", F.col("column"), F.col("anomaly_rate") * 100)
    return rates.where(F.col("anomaly_rate") > alert_threshold).select(
        *by, "column", "anomaly_rate", "anomaly_count",
        F.when(F.col("anomaly_rate") > 0.2, "high").otherwise("medium").alias("severity"),
        msg.alias("message"),
        F.array(*[F.lit(r) for r in ALERT_RECOMMENDATIONS]).alias("recommendations"))


def anomaly_summary(log: DataFrame, as_of=None, time_col: str = "timestamp") -> DataFrame:
    """Per-column anomaly counts with the log totals on every row.

    Totals: anomalies, last-24h anomalies (before ``as_of``), threshold
    violations and mean model consensus.  The window runs over the small
    per-column table only.
    """
    from pyspark.sql import Window
    recent = F.lit(0)
    if as_of is not None and time_col in log.columns:
        cutoff = F.lit(as_of).cast("timestamp") - F.expr("INTERVAL 24 HOURS")
        recent = F.count_if(F.col(time_col) > cutoff)
    per = log.groupBy("column").agg(
        F.count("*").alias("anomalies"), recent.alias("_recent"),
        F.count_if("threshold_exceeded").alias("_viol"), F.sum("model_consensus").alias("_cons"))
    w = Window.partitionBy()
    return per.select(
        "column", "anomalies",
        F.sum("anomalies").over(w).alias("total_anomalies"),
        F.sum("_recent").over(w).alias("recent_anomalies"),
        F.sum("_viol").over(w).alias("threshold_violations"),
        (F.sum("_cons").over(w) / F.sum("anomalies").over(w)).alias("average_model_consensus"))
