"""Prediction deviation, data drift and retraining decisions (DR1-DR6, A9).

Profiles are tidy tables ``(group..., column, mean, std, q25, q75, ...)``;
drift is a join of two such tables (small: groups x columns rows) followed
by Column arithmetic, so the only pass over raw rows is the profile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.operators.ordering import join_keys, row_index, stored
from loadlens.operators.quantiles import long_values, quantile_rows
from loadlens.schema import numeric_columns

EPS = 1e-8


def occurrences(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``df`` with the number of each row among the rows of its key, by ``order``, in ``_occurrence``.

    Only keys that repeat are numbered, through sorted ranges, so that a hot
    key is split; a key that occurs once is 0 and isn't sorted.
    """
    keys = list(keys)
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    repeated = stored(repeated, "repeated-keys")
    if not repeated.head(1):
        return df.withColumn("_occurrence", F.lit(0).cast("long"))
    hot = row_index(join_keys(df, repeated, keys, "left_semi"), [order], keys, name="_occurrence")
    return join_keys(df, repeated, keys, "left_anti").withColumn("_occurrence", F.lit(0).cast("long")).unionByName(hot)


def prediction_deviation(pred: DataFrame, actual: DataFrame, key: str = "test_id",
                         threshold: float = 0.2) -> DataFrame:
    """DR1: per (key, metric) deviation |p-a|/a (|p-a| when a=0), flagged above threshold.

    Inputs are long tables (key, metric, predicted) and (key, metric, actual);
    only metrics present in both are compared (J5).  A (key, metric) that
    repeats is paired occurrence by occurrence, in the order of its values, so
    that k rows on each side give k pairs; a null key matches a null key.
    """
    at = [key, "metric", "_occurrence"]
    j = join_keys(occurrences(pred, [key, "metric"], "predicted"), occurrences(actual, [key, "metric"], "actual"), at).drop("_occurrence")
    dev = F.when(F.col("actual") != 0, F.abs(F.col("predicted") - F.col("actual")) / F.col("actual")) \
           .otherwise(F.abs(F.col("predicted") - F.col("actual")))
    return j.withColumn("deviation", dev).withColumn("is_anomaly", F.col("deviation") > threshold)


def deviation_assessment(dev: DataFrame, key: str = "test_id", threshold: float = 0.2) -> DataFrame:
    """DR1 overall per key: mean deviation, flagged count, significant drift."""
    g = dev.groupBy(key).agg(F.avg("deviation").alias("average_deviation"),
                             F.count_if("is_anomaly").alias("anomaly_count"))
    return g.withColumn("is_significant_drift",
                        (F.col("average_deviation") > threshold) | (F.col("anomaly_count") > 0))


def profile_long(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per (group, column): mean, sample std, min, max, median, q25, q75, count (A3/DR3).

    Moments by one ``groupBy`` of the unpivoted table (algebraic, map-side
    combined); quantiles by the distributed exact helper.
    """
    by = list(by)
    cols = list(columns) if columns is not None else numeric_columns(df, exclude=by)
    lv = long_values(df, cols, by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    keys = [*by, "column"]
    mom = lv.groupBy(*keys).agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                F.min("value").alias("min"), F.max("value").alias("max"),
                                F.count("value").alias("count"))
    q = quantile_rows(lv, keys, "value", [0.25, 0.5, 0.75]).groupBy(*keys).agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for p, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))])
    return join_keys(mom, q, keys, "left")


def mean_shift(recent: DataFrame, baseline: DataFrame, threshold: float = 0.3,
               columns: Sequence[str] | None = None) -> DataFrame:
    """DR2: per column relative change of the mean; overall retrain flag.

    Columns numeric in ``recent`` and present in ``baseline``; drift is
    |r-b|/|b| (|r-b| when b=0); retrain when more than 30 % of the
    columns drifted or the mean drift exceeds the threshold.
    """
    cols = list(columns) if columns is not None else [c for c in numeric_columns(recent) if c in baseline.columns]
    r = recent.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    b = baseline.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])

    def long(df, name):
        return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v"))
                                             for c in cols])).alias("s")).select("s.column", F.col("s.v").alias(name))
    j = long(r, "recent_mean").join(long(b, "baseline_mean"), "column")
    d = F.when(F.col("baseline_mean") != 0,
               F.abs(F.col("recent_mean") - F.col("baseline_mean")) / F.abs(F.col("baseline_mean"))) \
         .otherwise(F.abs(F.col("recent_mean") - F.col("baseline_mean")))
    j = j.withColumn("drift", d).withColumn("is_drifted", F.col("drift") > threshold)
    w = Window.partitionBy()   # bounded: one row per column
    return (j.withColumn("average_drift", F.avg("drift").over(w))
             .withColumn("drifted_features", F.count_if("is_drifted").over(w))
             .withColumn("total_features", F.count("*").over(w))
             .withColumn("model_needs_retraining",
                         (F.col("drifted_features") > F.col("total_features") * 0.3)
                         | (F.col("average_drift") > threshold)))


def data_drift(current: DataFrame, baseline_profile: DataFrame, threshold: float = 0.3,
               by: Sequence[str] = ()) -> DataFrame:
    """DR4: per (group, column) drift score = mean of four relative shifts.

    Shifts of mean, std, q25, q75 with denominator |baseline| + 1e-8; a
    column drifts above the threshold; a group is significant when more
    than 30 % of its columns drifted or the mean score exceeds it.
    Columns are those profiled in both (J4).
    """
    by = list(by)
    cols = [c for c in numeric_columns(current, exclude=by)]
    cur = profile_long(current, cols, by)
    keys = [*by, "column"]
    b = baseline_profile.select(*keys, *[F.col(c).alias(f"b_{c}") for c in ("mean", "std", "q25", "q75")])
    j = join_keys(cur, b, keys)

    def shift(c):
        return F.abs(F.col(c) - F.col(f"b_{c}")) / (F.abs(F.col(f"b_{c}")) + EPS)
    j = j.withColumns({f"{c}_drift": shift(c) for c in ("mean", "std", "q25", "q75")})
    j = j.withColumn("drift_score", (F.col("mean_drift") + F.col("std_drift") + F.col("q25_drift")
                                     + F.col("q75_drift")) / 4.0)
    j = j.withColumn("is_drifted", F.col("drift_score") > threshold)
    w = Window.partitionBy(*by)   # bounded: columns per group
    j = (j.withColumn("total_features", F.count("*").over(w))
          .withColumn("drifted_count", F.count_if("is_drifted").over(w))
          .withColumn("average_drift", F.avg("drift_score").over(w)))
    return (j.withColumn("drift_rate", F.col("drifted_count") / F.col("total_features"))
             .withColumn("significant_drift", (F.col("drifted_count") > F.col("total_features") * 0.3)
                         | (F.col("average_drift") > threshold)))


def drift_checks(drift: DataFrame, by: Sequence[str], baseline_name, checked_at) -> DataFrame:
    """One drift-log row per group (the reference's drift history records)."""
    by = list(by)
    return drift.groupBy(*by).agg(
        F.first("total_features").alias("total_features"), F.first("drifted_count").alias("drifted_count"),
        F.first("drift_rate").alias("drift_rate"), F.first("average_drift").alias("average_drift"),
        F.first("significant_drift").alias("significant_drift")).withColumns({
            "baseline_name": baseline_name if not isinstance(baseline_name, str) else F.lit(baseline_name),
            "checked_at": F.lit(checked_at).cast("timestamp") if isinstance(checked_at, str) else checked_at})


def drift_summary(log: DataFrame, as_of) -> DataFrame:
    """Checks, significant events, last-7-day checks, mean drift rate, baselines used."""
    cutoff = F.lit(as_of).cast("timestamp") - F.expr("INTERVAL 7 DAYS")
    return log.agg(F.count("*").alias("total_drift_checks"),
                   F.count_if("significant_drift").alias("significant_drift_events"),
                   F.count_if(F.col("checked_at") > cutoff).alias("recent_drift_checks"),
                   F.avg("drift_rate").alias("average_drift_rate"),
                   F.array_join(F.array_sort(F.collect_set("baseline_name")), ",").alias("baselines_used"))


def retrain_trigger(new_rows: DataFrame, drift_flag, anomaly_log: DataFrame | None, as_of,
                    last_update=None, threshold: int = 100, time_col: str = "timestamp") -> DataFrame:
    """DR5: one-row trigger table; retrain when any condition holds."""
    n = new_rows.agg(F.count("*").alias("n"))
    cutoff = F.lit(as_of).cast("timestamp") - F.expr("INTERVAL 24 HOURS")
    if anomaly_log is not None:
        a = anomaly_log.agg(F.count_if(F.col(time_col) > cutoff).alias("recent_anomalies"))
    else:
        a = n.select(F.lit(0).cast("long").alias("recent_anomalies"))
    base = n.unionByName(a, allowMissingColumns=True).agg(F.max("n").alias("n"),
                                                         F.max("recent_anomalies").alias("recent_anomalies"))
    since = (F.lit(True) if last_update is None else
             (F.lit(as_of).cast("timestamp") - F.lit(last_update).cast("timestamp")) > F.expr("INTERVAL 7 DAYS"))
    out = base.select(
        (F.lit(bool(drift_flag)) if isinstance(drift_flag, bool) else drift_flag).alias("model_drift_detected"),
        (F.col("n") >= threshold).alias("sufficient_new_data"),
        since.alias("significant_time_passed"),
        (F.col("recent_anomalies") > 10).alias("high_anomaly_rate"))
    return out.withColumn("should_retrain", F.col("model_drift_detected") | F.col("sufficient_new_data")
                          | F.col("significant_time_passed") | F.col("high_anomaly_rate"))


def retrain_decisions(models: DataFrame, as_of, min_rows: int = 100) -> DataFrame:
    """DR6: per model row (significant_drift, drift_rate, new_rows, last_retrained).

    Retrain when drift is significant, the drift rate exceeds 0.5, or the
    last retraining is more than 30 days old; ``reasons`` lists every rule
    that fired, including the informational "Insufficient new data".
    """
    days = F.datediff(F.lit(as_of).cast("timestamp"), F.col("last_retrained"))
    old = F.coalesce((F.lit(as_of).cast("timestamp") - F.col("last_retrained")) > F.expr("INTERVAL 30 DAYS"),
                     F.lit(False))
    sufficient = F.col("new_rows") >= min_rows
    reasons = F.filter(F.array(
        F.when(F.col("significant_drift"), F.lit("Significant data drift detected")),
        F.when(F.col("drift_rate") > 0.5, F.lit("High drift rate (>50%)")),
        F.when(~sufficient, F.lit("Insufficient new data")),
        F.when(old, F.lit("More than 30 days since last retraining"))), lambda x: x.isNotNull())
    out = models.withColumns({
        "should_retrain": F.coalesce(F.col("significant_drift"), F.lit(False)) | (F.col("drift_rate") > 0.5) | old,
        "sufficient_data": sufficient, "days_since_retraining": days})
    return out.withColumn("reasons", F.when(F.size(reasons) == 0, F.array(F.lit("No retraining criteria met")))
                          .otherwise(reasons))
