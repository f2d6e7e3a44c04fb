"""Feature, target, scaling and selection queries over ``order_runs``."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import features as FE
from loadlens.operators import targets as TG
from loadlens.plans.catalog import register
from loadlens.sources.tables import hourly_runs, order_configs, order_runs


def _runs(spark, sf):
    return order_runs(spark, sf)


@register("run_profile_by_category", views=["order_runs"], rnd=["avg_latency", "failure_share", "avg_error_rate"], sql="""
WITH f AS (
  SELECT *,
    CASE WHEN concurrent_users > 0 AND concurrent_users <= 50 THEN 'light'
         WHEN concurrent_users > 50 AND concurrent_users <= 100 THEN 'medium'
         WHEN concurrent_users > 100 AND concurrent_users <= 200 THEN 'high'
         WHEN concurrent_users > 200 AND concurrent_users <= 500 THEN 'very_high'
         WHEN concurrent_users > 500 THEN 'extreme' END AS load_category,
    CASE WHEN error_rate > 0 AND error_rate <= 0.01 THEN 'excellent'
         WHEN error_rate > 0.01 AND error_rate <= 0.05 THEN 'good'
         WHEN error_rate > 0.05 AND error_rate <= 0.1 THEN 'acceptable'
         WHEN error_rate > 0.1 AND error_rate <= 0.2 THEN 'poor'
         WHEN error_rate > 0.2 AND error_rate <= 1.0 THEN 'critical' END AS error_severity,
    CAST(coalesce(error_rate > 0.05, false) AS INTEGER) AS failure_target
  FROM order_runs)
SELECT load_category, error_severity, count(*) AS runs, avg(avg_response_time) AS avg_latency,
       avg(failure_target) AS failure_share, avg(error_rate) AS avg_error_rate
FROM f GROUP BY load_category, error_severity""")
def run_profile_by_category(spark, sf):
    """Flagship: runs -> features/targets -> profile per load and error class."""
    runs = _runs(spark, sf)
    f = FE.reliability_features(FE.load_features(runs, FE.FeatureStats(), rank=False))
    f = f.withColumn("failure_target", (F.coalesce(F.col("error_rate") > 0.05, F.lit(False))).cast("int"))
    return f.groupBy("load_category", "error_severity").agg(
        F.count("*").alias("runs"), F.avg("avg_response_time").alias("avg_latency"),
        F.avg("failure_target").alias("failure_share"), F.avg("error_rate").alias("avg_error_rate"))


BASIC = ["response_time_p95", "response_time_p99", "response_time_variance",
         "throughput_per_user", "user_efficiency", "load_intensity"]


@register("features_basic", views=["order_runs"], rnd=BASIC, sql="""
SELECT test_id, avg_response_time * 1.5 AS response_time_p95, avg_response_time * 2.0 AS response_time_p99,
       max_response_time - min_response_time AS response_time_variance,
       requests_per_sec / nullif(concurrent_users, 0) AS throughput_per_user,
       requests_per_sec / nullif(concurrent_users, 0) / nullif(spawn_rate, 0) AS user_efficiency,
       concurrent_users * spawn_rate / nullif(duration, 0) AS load_intensity
FROM order_runs""")
def features_basic(spark, sf):
    return FE.basic_features(_runs(spark, sf)).select("test_id", *BASIC)


LOAD = ["peak_load_ratio", "load_progression", "spawn_efficiency"]


@register("features_load", views=["order_runs"], rnd=LOAD, sql="""
SELECT test_id,
  CASE WHEN (SELECT min(concurrent_users) FROM order_runs) > 0
       THEN concurrent_users / (SELECT min(concurrent_users) FROM order_runs) ELSE 1.0 END AS peak_load_ratio,
  (rank() OVER (ORDER BY concurrent_users)
     + (count(*) OVER (PARTITION BY concurrent_users) - 1) / 2.0) / count(concurrent_users) OVER () AS load_progression,
  concurrent_users / nullif(spawn_rate * duration, 0) AS spawn_efficiency,
  CASE WHEN concurrent_users > 0 AND concurrent_users <= 50 THEN 'light'
       WHEN concurrent_users > 50 AND concurrent_users <= 100 THEN 'medium'
       WHEN concurrent_users > 100 AND concurrent_users <= 200 THEN 'high'
       WHEN concurrent_users > 200 AND concurrent_users <= 500 THEN 'very_high'
       WHEN concurrent_users > 500 THEN 'extreme' END AS load_category
FROM order_runs""")
def features_load(spark, sf):
    runs = _runs(spark, sf)
    st = FE.fit_feature_stats(runs.select("concurrent_users"))
    return FE.load_features(runs, st).select("test_id", *LOAD, "load_category")


REL = ["error_rate_normalized", "reliability_score", "success_rate", "failure_ratio"]


@register("features_reliability", views=["order_runs"], rnd=REL, sql="""
SELECT test_id, error_rate * 100 AS error_rate_normalized, 100 - error_rate * 100 AS reliability_score,
  (total_requests - total_failures) / nullif(CAST(total_requests AS DOUBLE), 0) AS success_rate,
  total_failures / nullif(CAST(total_requests AS DOUBLE), 0) AS failure_ratio,
  CASE WHEN error_rate > 0 AND error_rate <= 0.01 THEN 'excellent'
       WHEN error_rate > 0.01 AND error_rate <= 0.05 THEN 'good'
       WHEN error_rate > 0.05 AND error_rate <= 0.1 THEN 'acceptable'
       WHEN error_rate > 0.1 AND error_rate <= 0.2 THEN 'poor'
       WHEN error_rate > 0.2 AND error_rate <= 1.0 THEN 'critical' END AS error_severity
FROM order_runs""")
def features_reliability(spark, sf):
    return FE.reliability_features(_runs(spark, sf)).select("test_id", *REL, "error_severity")


RAT = ["response_time_consistency", "response_time_spread", "throughput_ratio", "performance_efficiency"]


@register("features_ratios", views=["order_runs"], rnd=RAT, sql="""
SELECT test_id, min_response_time / nullif(max_response_time, 0) AS response_time_consistency,
  max_response_time / nullif(avg_response_time, 0) AS response_time_spread,
  CASE WHEN (SELECT min(requests_per_sec) FROM order_runs) > 0
       THEN requests_per_sec / (SELECT min(requests_per_sec) FROM order_runs) ELSE 1.0 END AS throughput_ratio,
  requests_per_sec / nullif(avg_response_time, 0) AS performance_efficiency
FROM order_runs""")
def features_ratios(spark, sf):
    runs = _runs(spark, sf)
    st = FE.fit_feature_stats(runs.select("requests_per_sec", "concurrent_users"))
    return FE.ratio_features(runs, st).select("test_id", *RAT)


@register("features_time", views=["order_runs"], rnd=["duration_minutes"], sql="""
SELECT test_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
  CAST(isodow(ts) - 1 IN (5, 6) AS INTEGER) AS is_weekend,
  CAST(epoch(ts) AS BIGINT) AS time_since_epoch,
  CAST(hour(ts) >= 9 AND hour(ts) <= 17 AS INTEGER) AS is_business_hours,
  duration / 60.0 AS duration_minutes,
  CASE WHEN duration > 0 AND duration <= 300 THEN 'short' WHEN duration > 300 AND duration <= 600 THEN 'medium'
       WHEN duration > 600 AND duration <= 1200 THEN 'long' WHEN duration > 1200 THEN 'very_long' END AS duration_category
FROM order_runs""")
def features_time(spark, sf):
    return FE.time_features(_runs(spark, sf)).select(
        "test_id", "hour_of_day", "day_of_week", "is_weekend", "time_since_epoch",
        "is_business_hours", "duration_minutes", "duration_category")


@register("features_time_hourly", views=["hourly_runs"], sql="""
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS run_time, CAST(hour(window_start) AS INTEGER) AS hour_of_day,
  CAST(isodow(window_start) - 1 AS INTEGER) AS day_of_week, CAST(isodow(window_start) - 1 IN (5, 6) AS INTEGER) AS is_weekend,
  CAST(epoch(window_start) AS BIGINT) AS time_since_epoch,
  CAST(hour(window_start) >= 9 AND hour(window_start) <= 17 AS INTEGER) AS is_business_hours
FROM hourly_runs""")
def features_time_hourly(spark, sf):
    """FE15-FE18 on hourly runs, whose timestamps are strings and fall on every hour of the day."""
    runs = hourly_runs(spark, sf).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("run_time"))
    return FE.time_features(runs.withColumn("timestamp", F.col("run_time"))).select(
        "run_time", "hour_of_day", "day_of_week", "is_weekend", "time_since_epoch", "is_business_hours")


@register("features_network", views=["order_runs"], rnd=["network_speed_mbps", "network_speed_kbps", "network_performance_impact"], sql="""
WITH codes AS (
  SELECT network_condition AS v, CAST(row_number() OVER (ORDER BY network_condition) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT network_condition FROM order_runs WHERE network_condition IS NOT NULL))
SELECT test_id,
  CASE network_condition WHEN 'wifi' THEN 50.0E0 WHEN '4g' THEN 20.0E0 WHEN '3g' THEN 3.0E0 WHEN 'slow_3g' THEN 1.5E0 END AS network_speed_mbps,
  CASE network_condition WHEN 'wifi' THEN 50.0E0 WHEN '4g' THEN 20.0E0 WHEN '3g' THEN 3.0E0 WHEN 'slow_3g' THEN 1.5E0 END * 1000 AS network_speed_kbps,
  coalesce(code, -1) AS network_condition_encoded,
  avg_response_time * CASE network_condition WHEN 'wifi' THEN 50.0E0 WHEN '4g' THEN 20.0E0 WHEN '3g' THEN 3.0E0
       WHEN 'slow_3g' THEN 1.5E0 END / 50 AS network_performance_impact
FROM order_runs LEFT JOIN codes ON network_condition = v""")
def features_network(spark, sf):
    runs = _runs(spark, sf)
    st = FE.fit_feature_stats(runs.select("network_condition"))
    return FE.network_features(runs, st).select(
        "test_id", "network_speed_mbps", "network_speed_kbps", "network_condition_encoded",
        "network_performance_impact")


def _score_case(s):
    v = f"coalesce({s}, 0.5)"
    return (f"CASE WHEN {v} > 0 AND {v} <= 0.5 THEN 'poor' WHEN {v} > 0.5 AND {v} <= 0.7 THEN 'needs_improvement' "
            f"WHEN {v} > 0.7 AND {v} <= 0.9 THEN 'good' WHEN {v} > 0.9 AND {v} <= 1.0 THEN 'excellent' END AS {s}_category")


@register("features_frontend", views=["order_runs"], rnd=["overall_frontend_score", "frontend_consistency"], sql=f"""
WITH codes AS (
  SELECT browser AS v, CAST(row_number() OVER (ORDER BY browser) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT browser FROM order_runs WHERE browser IS NOT NULL)),
s AS (SELECT test_id, browser, performance_score, accessibility_score, best_practices_score, seo_score,
        coalesce(performance_score, 0.5) AS a, coalesce(accessibility_score, 0.5) AS b,
        coalesce(best_practices_score, 0.5) AS c, coalesce(seo_score, 0.5) AS d FROM order_runs)
SELECT test_id, {_score_case('performance_score')}, {_score_case('accessibility_score')},
  {_score_case('best_practices_score')}, {_score_case('seo_score')},
  (a + b + c + d) / 4.0 AS overall_frontend_score,
  sqrt(((a - (a + b + c + d) / 4.0) ^ 2 + (b - (a + b + c + d) / 4.0) ^ 2 + (c - (a + b + c + d) / 4.0) ^ 2
        + (d - (a + b + c + d) / 4.0) ^ 2) / 3.0) AS frontend_consistency,
  coalesce(code, -1) AS browser_encoded
FROM s LEFT JOIN codes ON browser = v""")
def features_frontend(spark, sf):
    runs = _runs(spark, sf)
    st = FE.fit_feature_stats(runs.select("browser"))
    return FE.frontend_features(runs, st).select(
        "test_id", *[f"{s}_category" for s in ("performance_score", "accessibility_score",
                                              "best_practices_score", "seo_score")],
        "overall_frontend_score", "frontend_consistency", "browser_encoded")


INTER = ["user_session_duration", "user_arrival_rate", "load_distribution", "test_intensity"]


@register("features_interaction", views=["order_runs"], rnd=INTER, sql="""
SELECT test_id, duration / nullif(CAST(concurrent_users AS DOUBLE), 0) AS user_session_duration,
  spawn_rate / nullif(concurrent_users, 0) AS user_arrival_rate,
  concurrent_users / nullif(CAST((SELECT max(concurrent_users) FROM order_runs) AS DOUBLE), 0) AS load_distribution,
  concurrent_users * requests_per_sec / nullif(duration, 0) AS test_intensity
FROM order_runs""")
def features_interaction(spark, sf):
    runs = _runs(spark, sf)
    st = FE.fit_feature_stats(runs.select("concurrent_users"))
    return FE.interaction_features(runs, st).select("test_id", *INTER)


@register("features_complexity", views=["order_runs", "order_configs"], rnd=["payload_size_kb", "resource_complexity"], sql="""
SELECT r.test_id, CAST(CASE WHEN api_endpoints IS NOT NULL THEN len(api_endpoints) ELSE 1 END AS INTEGER) AS endpoint_count,
  payload_size / 1024.0 AS payload_size_kb,
  CASE WHEN payload_size / 1024.0 > 0 AND payload_size / 1024.0 <= 1 THEN 'tiny'
       WHEN payload_size / 1024.0 > 1 AND payload_size / 1024.0 <= 10 THEN 'small'
       WHEN payload_size / 1024.0 > 10 AND payload_size / 1024.0 <= 100 THEN 'medium'
       WHEN payload_size / 1024.0 > 100 AND payload_size / 1024.0 <= 1000 THEN 'large'
       WHEN payload_size / 1024.0 > 1000 THEN 'huge' END AS payload_complexity,
  ((CASE WHEN api_endpoints IS NOT NULL THEN len(api_endpoints) ELSE 1 END) + payload_size / 1024.0 / 100) / 2.0 AS resource_complexity
FROM order_runs r JOIN order_configs c ON r.test_id = c.test_id""")
def features_complexity(spark, sf):
    """J1 + FE28-FE30: runs joined to their configuration on test_id."""
    runs = _runs(spark, sf)
    cfg = order_configs(spark, sf)
    j = runs.join(cfg, "test_id")
    st = FE.fit_feature_stats(j.select("payload_size"))
    return FE.complexity_features(j, st).select(
        "test_id", "endpoint_count", "payload_size_kb", "payload_complexity", "resource_complexity")


TGT = ["latency_target", "latency_log", "throughput_target"]


@register("targets", views=["order_runs"], rnd=TGT, sql="""
WITH q AS (SELECT quantile_cont(avg_response_time, 0.25) AS q1, quantile_cont(avg_response_time, 0.75) AS q3 FROM order_runs)
SELECT test_id, avg_response_time AS latency_target, ln(1 + avg_response_time) AS latency_log,
  requests_per_sec AS throughput_target,
  CAST(coalesce(error_rate > 0.05, false) AS INTEGER) AS failure_target,
  CAST(coalesce(error_rate < 0.01, false) AS INTEGER) AS reliability_target,
  CAST(coalesce(avg_response_time < 1000, false) AS INTEGER) AS performance_target,
  CAST(coalesce(avg_response_time > q3 + 1.5 * (q3 - q1), false) AS INTEGER) AS anomaly_target
FROM order_runs, q""")
def targets(spark, sf):
    return TG.create_targets(_runs(spark, sf)).select(
        "test_id", *TGT, "failure_target", "reliability_target", "performance_target", "anomaly_target")
