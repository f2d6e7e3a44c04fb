"""Profile, threshold, scaling, selection and framing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import features as FE
from loadlens.operators import filters as FL
from loadlens.operators import profile as PR
from loadlens.operators import scaling as SC
from loadlens.operators import selection as SE
from loadlens.plans.catalog import register
from loadlens.sources.tables import order_runs

# Numeric columns of order_runs, in schema order.
NUMERIC = ["total_requests", "total_failures", "error_rate", "avg_response_time", "max_response_time",
           "min_response_time", "requests_per_sec", "concurrent_users", "spawn_rate", "duration",
           "performance_score", "accessibility_score", "best_practices_score", "seo_score"]
SCALABLE = [c for c in NUMERIC if c not in ("concurrent_users", "duration")]
KEY3 = ["avg_response_time", "requests_per_sec", "error_rate"]


def _unpivot_sql(cols):
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return (f"(UNPIVOT (SELECT {sel} FROM order_runs) ON {', '.join(cols)} "
            f"INTO NAME \"column\" VALUE value)")


PROFILE_RND = ["mean", "std", "min", "max", "median", "q25", "q75"]


@register("column_profile", views=["order_runs"], rnd=PROFILE_RND, sql=f"""
SELECT "column", avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
  quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.75) AS q75,
  count(value) AS count
FROM {_unpivot_sql(NUMERIC)} GROUP BY "column" """)
def column_profile(spark, sf):
    """A3: mean/std/min/max/median/q25/q75/count of every numeric column."""
    return PR.column_profile(order_runs(spark, sf))


@register("thresholds", views=["order_runs"], rnd=["mean", "std", "z_score_2", "z_score_3", "iqr_upper", "iqr_lower"], sql=f"""
SELECT "column", avg(value) AS mean, stddev_pop(value) AS std, avg(value) + 2 * stddev_pop(value) AS z_score_2,
  avg(value) + 3 * stddev_pop(value) AS z_score_3,
  quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS iqr_upper,
  quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS iqr_lower
FROM {_unpivot_sql(KEY3)} GROUP BY "column" """)
def thresholds(spark, sf):
    """A4: statistical thresholds of the key metrics."""
    return PR.thresholds_frame(order_runs(spark, sf), KEY3)


_ALL_COLS = ["test_id", "test_type", "ts", "total_requests", "total_failures", "error_rate", "avg_response_time",
             "max_response_time", "min_response_time", "requests_per_sec", "concurrent_users", "spawn_rate",
             "duration", "network_condition", "browser", "performance_score", "accessibility_score",
             "best_practices_score", "seo_score", "status"]


@register("data_summary", views=["order_runs"], rnd=["mean", "median", "std", "min", "max"], sql=f"""
WITH top AS (SELECT count(*) AS total_records, strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS "start",
    strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS "end",
    {' + '.join(f'(count(*) - count({c}))' for c in _ALL_COLS)} AS missing_values FROM order_runs)
SELECT "column" AS metric, avg(value) AS mean, quantile_cont(value, 0.5) AS median, stddev_samp(value) AS std,
  min(value) AS min, max(value) AS max, any_value(total_records) AS total_records, any_value("start") AS "start",
  any_value("end") AS "end", 14 AS numerical, 5 AS categorical, 20 AS total_columns,
  any_value(missing_values) AS missing_values
FROM {_unpivot_sql(KEY3)}, top GROUP BY "column" """)
def data_summary(spark, sf):
    """A5: dataset summary with the key-metric statistics."""
    return PR.data_summary(order_runs(spark, sf))


def _scale_sql(method):
    if method == "standard":
        stats = ", ".join(f"avg({c}) AS a_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS b_{c}" for c in SCALABLE)
    elif method == "minmax":
        stats = ", ".join(f"min({c}) AS a_{c}, coalesce(nullif(max({c}) - min({c}), 0), 1) AS b_{c}" for c in SCALABLE)
    else:
        stats = ", ".join(f"quantile_cont({c}, 0.5) AS a_{c}, coalesce(nullif(quantile_cont({c}, 0.75) "
                          f"- quantile_cont({c}, 0.25), 0), 1) AS b_{c}" for c in SCALABLE)
    cols = ", ".join(f"(CAST({c} AS DOUBLE) - a_{c}) / b_{c} AS {c}" for c in SCALABLE)
    return f"WITH s AS (SELECT {stats} FROM order_runs)\nSELECT test_id, {cols} FROM order_runs, s"


def _scale_query(method):
    def q(spark, sf):
        r = order_runs(spark, sf)
        scaled, _ = SC.normalize_features(r, method)
        return scaled.select("test_id", *SCALABLE)
    q.__doc__ = f"SC1: {method} scaling of the numeric run columns."
    return q


for _m in SC.METHODS:
    register(f"scale_{_m}", views=["order_runs"], rnd=SCALABLE, sql=_scale_sql(_m))(_scale_query(_m))

TARGET = "avg_response_time"
CANDIDATES = [c for c in NUMERIC if c != TARGET]


def _dense_filter(c):
    return f"(SELECT count({c}) >= 0.5 * count(*) FROM order_runs)"


@register("select_f_regression", views=["order_runs"], rnd=["score"], sql="""
WITH sc AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, (SELECT CASE WHEN corr(coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM order_runs)), {TARGET}) ^ 2 < 1 "
    f"THEN corr(coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM order_runs)), {TARGET}) ^ 2 / "
    f"(1 - corr(coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM order_runs)), {TARGET}) ^ 2) * (count({TARGET}) - 2) END "
    f"FROM order_runs) AS score WHERE {_dense_filter(c)}" for c in CANDIDATES) + """)
SELECT feature, score FROM sc ORDER BY score DESC NULLS LAST, feature LIMIT 5""")
def select_f_regression(spark, sf):
    """FS1: top-5 features by univariate F statistic for latency."""
    _, ranked = SE.select_features(order_runs(spark, sf), TARGET, "f_regression", k=5)
    return ranked


def _mi_sql(bins=10):
    probs = [k / bins for k in range(1, bins)]
    imp = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM order_runs)) AS {c}" for c in CANDIDATES)
    edges = ", ".join(f"quantile_cont({c}, {p}) AS e_{c}_{i}" for c in [*CANDIDATES, TARGET]
                      for i, p in enumerate(probs))

    def b(c):
        return " + ".join(f"CAST({c} > e_{c}_{i} AS INTEGER)" for i in range(len(probs)))
    parts = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, {b(c)} AS xb, {b(TARGET)} AS yb FROM d, e WHERE {_dense_filter(c)}"
        for c in CANDIDATES)
    return f"""
WITH d AS (SELECT {imp}, CAST({TARGET} AS DOUBLE) AS {TARGET} FROM order_runs WHERE {TARGET} IS NOT NULL),
e AS (SELECT {edges} FROM d),
l AS ({parts}),
j AS (SELECT feature, xb, yb, count(*) AS nxy FROM l GROUP BY ALL),
k AS (SELECT *, sum(nxy) OVER (PARTITION BY feature) AS n, sum(nxy) OVER (PARTITION BY feature, xb) AS nx,
             sum(nxy) OVER (PARTITION BY feature, yb) AS ny FROM j),
m AS (SELECT feature, sum(nxy / n * ln((nxy * n) / (nx * ny))) AS score FROM k GROUP BY feature)
SELECT feature, score FROM m ORDER BY score DESC NULLS LAST, feature LIMIT 5"""


@register("select_mi_binned", views=["order_runs"], rnd=["score"], sql=_mi_sql())
def select_mi_binned(spark, sf):
    """FS2: top-5 features by decile-binned mutual information with latency."""
    _, ranked = SE.select_features(order_runs(spark, sf), TARGET, "mutual_info", k=5)
    return ranked


@register("frame_regression", views=["order_runs"], rnd=[*CANDIDATES, TARGET], sql=f"""
SELECT test_id, {', '.join(f'coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM order_runs WHERE {TARGET} IS NOT NULL)) AS {c}' for c in CANDIDATES)},
  {TARGET} FROM order_runs WHERE {TARGET} IS NOT NULL""")
def frame_regression(spark, sf):
    """M1 (F7+F9+F10): numeric features, mean-imputed, rows with a target."""
    fr, _ = FL.frame_problem(order_runs(spark, sf), TARGET)
    return fr


# (column, kind, type) of basic features + targets over order_runs, fixed by the schema.
_SUMMARY_COLS = [(c, "numerical", t) for c, t in [
    ("total_requests", "bigint"), ("total_failures", "bigint"), ("error_rate", "double"),
    ("avg_response_time", "double"), ("max_response_time", "double"), ("min_response_time", "double"),
    ("requests_per_sec", "double"), ("concurrent_users", "bigint"), ("spawn_rate", "double"),
    ("duration", "bigint"), ("performance_score", "double"), ("accessibility_score", "double"),
    ("best_practices_score", "double"), ("seo_score", "double")]]


@register("feature_summary", views=["order_runs"], sql="""
WITH f AS (SELECT *, avg_response_time * 1.5 AS response_time_p95, avg_response_time * 2.0 AS response_time_p99,
  requests_per_sec / nullif(concurrent_users, 0) AS throughput_per_user,
  CAST(coalesce(error_rate > 0.05, false) AS INTEGER) AS failure_target FROM order_runs),
u AS (UNPIVOT (SELECT """ + ", ".join(
    f"CAST({c} IS NULL AS INTEGER) AS {c}" for c in
    ["test_id", "test_type", "ts", *NUMERIC, "network_condition", "browser", "status",
     "response_time_p95", "response_time_p99", "throughput_per_user", "failure_target"]) + """ FROM f)
  ON COLUMNS(*) INTO NAME "column" VALUE is_null)
SELECT CASE "column" WHEN 'ts' THEN 'timestamp' ELSE "column" END AS "column",
  CASE WHEN "column" IN ('test_id', 'test_type', 'network_condition', 'browser', 'status') THEN 'categorical'
       WHEN "column" = 'ts' THEN 'other' ELSE 'numerical' END AS kind,
  CAST(sum(is_null) AS BIGINT) AS missing_values,
  "column" IN ('response_time_p95', 'response_time_p99', 'throughput_per_user', 'failure_target') AS engineered
FROM u GROUP BY "column" """)
def feature_summary(spark, sf):
    """FE32: per column kind, null count and engineered flag."""
    r = order_runs(spark, sf)
    f = FE.basic_features(r).drop("response_time_variance", "user_efficiency", "load_intensity")
    f = f.withColumn("failure_target", (F.coalesce(F.col("error_rate") > 0.05, F.lit(False))).cast("int"))
    return FE.feature_summary(f).drop("data_type")
