"""Boundary semantics of the feature and target operators (hand-computed)."""

import datetime as dt

import pytest

from loadlens.operators import features as FE
from loadlens.operators import targets as TG

SCHEMA = ("test_id string, test_type string, timestamp timestamp, total_requests long, total_failures long, "
          "error_rate double, avg_response_time double, max_response_time double, min_response_time double, "
          "requests_per_sec double, concurrent_users long, spawn_rate double, duration long, "
          "network_condition string, browser string, performance_score double, accessibility_score double, "
          "best_practices_score double, seo_score double, status string")


@pytest.fixture(scope="module")
def runs(spark):
    ts = dt.datetime(2024, 1, 6, 10, 0)   # a Saturday, business hour
    rows = [
        ("t1", "api", ts, 100, 0, 0.0, 150.5, 500.0, 50.0, 100.0, 50, 5.0, 300, "wifi", None,
         None, None, None, None, "success"),
        ("t2", "frontend", ts + dt.timedelta(days=2, hours=8), 0, 0, 0.01, 200.0, 800.0, 100.0, 0.0, 50, 0.0, 0,
         "3g", "chrome", 0.9, 0.5, 1.0, 0.0, "success"),
        ("t3", "load", ts + dt.timedelta(days=3), 1000, 100, 0.1, 800.0, 2000.0, 200.0, 200.0, 501, 20.0, 1200,
         None, "firefox", 0.95, 0.8, 0.7, 0.6, "error"),
        ("t4", "load", ts, 10, 5, 0.5, 2500.0, 3000.0, 0.0, 50.0, 0, 1.0, 601, "slow_3g", None,
         None, None, None, None, "success"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_bins_and_flags(spark, runs):
    st = FE.fit_feature_stats(runs)
    out = {r.test_id: r for r in FE.engineer_features(runs, st).collect()}
    assert out["t1"].load_category == "light"          # 50 is in (0, 50]
    assert out["t3"].load_category == "extreme"
    assert out["t4"].load_category is None             # 0 is below the lowest edge
    assert out["t1"].error_severity is None            # exact 0 -> no bin
    assert out["t2"].error_severity == "excellent"     # 0.01 in (0, 0.01]
    assert out["t4"].error_severity == "critical"
    assert out["t1"].duration_category == "short" and out["t4"].duration_category == "long"
    assert out["t2"].duration_category is None
    assert out["t1"].is_weekend == 1 and out["t1"].day_of_week == 5 and out["t1"].is_business_hours == 1
    assert out["t2"].hour_of_day == 18 and out["t2"].is_business_hours == 0


def test_zero_denominators_are_null(spark, runs):
    st = FE.fit_feature_stats(runs)
    out = {r.test_id: r for r in FE.engineer_features(runs, st).collect()}
    assert out["t2"].success_rate is None and out["t2"].failure_ratio is None
    assert out["t2"].load_intensity is None and out["t2"].user_efficiency is None
    assert out["t4"].throughput_per_user is None      # 0 users
    assert out["t1"].success_rate == 1.0


def test_global_features(spark, runs):
    st = FE.fit_feature_stats(runs)
    out = {r.test_id: r for r in FE.engineer_features(runs, st).collect()}
    # min users is 0 -> ratio is the constant 1; min rps 0 -> 1
    assert out["t1"].peak_load_ratio == 1.0 and out["t3"].throughput_ratio == 1.0
    assert out["t3"].load_distribution == 1.0
    # average rank of ties: users 50, 50 share ranks 2 and 3 -> 2.5 / 4
    assert out["t1"].load_progression == pytest.approx(2.5 / 4)
    # lexicographic codes, null -> -1
    assert [out[k].network_condition_encoded for k in ("t1", "t2", "t3", "t4")] == [2, 0, -1, 1]
    assert [out[k].browser_encoded for k in ("t1", "t2", "t3")] == [-1, 0, 1]


def test_frontend_scores(spark, runs):
    st = FE.fit_feature_stats(runs)
    out = {r.test_id: r for r in FE.engineer_features(runs, st).collect()}
    # t1 has no scores: filled with 0.5 -> poor, mean 0.5, std 0
    assert out["t1"].performance_score_category == "poor"
    assert out["t1"].overall_frontend_score == 0.5 and out["t1"].frontend_consistency == 0.0
    assert out["t2"].seo_score_category is None          # 0 is below the lowest edge
    assert out["t2"].best_practices_score_category == "excellent"
    import statistics
    assert out["t3"].frontend_consistency == pytest.approx(statistics.stdev([0.95, 0.8, 0.7, 0.6]))


def test_complexity(spark):
    df = spark.createDataFrame([("a", ["/x", "/y"], None), ("b", None, None)],
                               "test_id string, api_endpoints array<string>, payload_size long")
    out = {r.test_id: r for r in FE.engineer_features(df).collect()}
    assert out["a"].endpoint_count == 2 and out["b"].endpoint_count == 1
    assert out["a"].payload_size_kb == 0.0 and out["a"].payload_complexity is None
    assert out["a"].resource_complexity == 1.0


def test_missing_columns_skip_groups(spark):
    df = spark.createDataFrame([("a", 1.0)], "test_id string, avg_response_time double")
    out = FE.engineer_features(df)
    assert "load_category" not in out.columns and "response_time_p95" in out.columns


def test_targets(spark, runs):
    out = {r.test_id: r for r in TG.create_targets(runs).collect()}
    assert out["t1"].failure_target == 0 and out["t4"].failure_target == 1
    assert out["t1"].reliability_target == 1 and out["t2"].reliability_target == 0
    assert out["t4"].performance_target == 0
    # Q1/Q3 of (150.5, 200, 800, 2500) = 187.625, 1225 -> upper 2780.9375
    assert sum(r.anomaly_target for r in out.values()) == 0


def test_feature_summary(spark, runs):
    s = {r.column: r for r in FE.feature_summary(FE.basic_features(runs)).collect()}
    assert s["browser"].missing_values == 2 and s["browser"].kind == "categorical"
    assert s["response_time_p95"].engineered and not s["test_id"].engineered
