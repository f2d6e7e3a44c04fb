"""Metric trends over time (TR1-TR3).

The x of the regression is the row's position in time order among the
metric's non-null values (tie-break ``test_id``); positions come from the
bucketed ordering helper, so no window sees a whole metric.  Slope,
intercept and R^2 are Spark's ``regr_*`` aggregates (least squares,
identical to ``polyfit`` degree 1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.operators.ordering import row_index
from loadlens.operators.quantiles import long_values

# Default metrics and the substrings of lower-is-better names.
DEFAULT_METRICS = ["avg_response_time", "requests_per_sec", "error_rate"]
LOWER_IS_BETTER_MARKERS = ["latency", "error"]


def metric_trends(df: DataFrame, metrics: Sequence[str] = DEFAULT_METRICS, time_col: str = "timestamp",
                  key: str = "test_id", min_points: int = 10) -> DataFrame:
    """TR1/TR2: one row per metric with more than ``min_points`` values."""
    metrics = [m for m in metrics if m in df.columns]
    long = (long_values(df.select(key, time_col, *metrics), metrics, [key, time_col])
            .where(F.col("value").isNotNull() & ~F.isnan("value")))
    idx = row_index(long, [time_col, key], ["column"], name="x")
    g = idx.groupBy("column").agg(
        F.count("*").alias("n"),
        F.regr_slope("value", "x").alias("slope"),
        F.regr_intercept("value", "x").alias("intercept"),
        F.regr_r2("value", "x").alias("r2_raw"),
        F.var_pop("value").alias("_var"),
        F.stddev_pop("value").alias("_sd_pop"),
        F.avg("value").alias("mean_value"),
        F.stddev_samp("value").alias("std_value"),
        F.min(time_col).alias("start"), F.max(time_col).alias("end"))
    g = g.where(F.col("n") > min_points)
    # a zero-variance series is Stable (its fitted slope is float noise)
    direction = (F.when((F.col("_var") == 0) | (F.abs("slope") < 0.01 * F.col("_sd_pop")), "Stable")
                  .when(F.col("slope") > 0, "Increasing").otherwise("Decreasing"))
    r2 = F.when(F.col("_var") == 0, F.lit(None).cast("double")).otherwise(F.col("r2_raw"))
    return g.select(
        F.col("column").alias("metric"), "n", "slope", "intercept", r2.alias("r_squared"),
        direction.alias("trend_direction"),
        F.when(F.coalesce(r2 > 0.3, F.lit(False)), "Significant").otherwise("Weak").alias("trend_significance"),
        "mean_value", "std_value",
        F.when(F.col("mean_value") != 0, F.col("slope") * F.col("n") / F.col("mean_value") * 100)
         .otherwise(F.lit(0.0)).alias("change_percentage"),
        "start", "end", F.datediff("end", "start").alias("duration_days"))


# Fixed value: the message for a missing time column.
NO_TIME = "Time column '%s' not found"


def trends_or_error(df: DataFrame, metrics: Sequence[str] = DEFAULT_METRICS, time_col: str = "timestamp", key: str = "test_id",
                    min_points: int = 10) -> DataFrame:
    """TR1/TR2 with an ``error`` column: a missing time column gives one row that holds only the error."""
    if time_col in df.columns:
        return metric_trends(df, metrics, time_col, key, min_points).withColumn("error", F.lit(None).cast("string"))
    empty = metric_trends(df.limit(0).withColumn(time_col, F.lit(None).cast("timestamp")), metrics, time_col, key, min_points)
    row = df.sparkSession.createDataFrame([(NO_TIME % time_col,)], "error string")
    return empty.limit(0).withColumn("error", F.lit(None).cast("string")).unionByName(row, allowMissingColumns=True)


def overall_trend(trends: DataFrame, lower_is_better: Sequence[str] | None = None) -> DataFrame:
    """TR3: improving / degrading / stable lists and the majority direction.

    A metric whose name contains "latency" or "error" (or listed in
    ``lower_is_better``) improves when it decreases; others when they rise.
    """
    low = F.lit(False)
    for m in LOWER_IS_BETTER_MARKERS:
        low = low | F.lower("metric").contains(m)
    if lower_is_better:
        low = low | F.col("metric").isin(list(lower_is_better))
    d = F.col("trend_direction")
    cls = (F.when(d == "Increasing", F.when(low, "degrading").otherwise("improving"))
            .when(d == "Decreasing", F.when(low, "improving").otherwise("degrading"))
            .otherwise("stable"))
    t = trends.withColumn("_cls", cls)

    def names(cond):
        return F.array_join(F.array_sort(F.collect_list(F.when(cond, F.col("metric")))), ",")
    g = t.agg(names(F.col("_cls") == "improving").alias("improving_metrics"),
              names(F.col("_cls") == "degrading").alias("degrading_metrics"),
              names(F.col("_cls") == "stable").alias("stable_metrics"),
              names(F.col("trend_significance") == "Significant").alias("significant_trends"),
              F.count_if(F.col("_cls") == "improving").alias("_i"),
              F.count_if(F.col("_cls") == "degrading").alias("_d"))
    return g.withColumn("overall_performance_direction",
                        F.when(F.col("_i") > F.col("_d"), "Improving")
                         .when(F.col("_d") > F.col("_i"), "Degrading").otherwise("Stable")).drop("_i", "_d")
