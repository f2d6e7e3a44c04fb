"""Run-store operators on the reference's three sample runs and small batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadlens.operators import runs as RS


@pytest.fixture(scope="module")
def three(spark):
    # the three sample runs of the reference's smoke script (newest last)
    rows = [
        ("api_test_1", "api", dt.datetime(2024, 1, 1, 10, 0), 1000, 50, 0.05, 150.5, 500.0, 50.0, 100.0, 10, 1.0, 60,
         "wifi", None, "success"),
        ("frontend_test_1", "frontend", dt.datetime(2024, 1, 1, 11, 0), None, None, None, 200.0, None, None, 50.0, 1,
         0.1, 60, "4g", "chrome", "success"),
        ("load_test_1", "load", dt.datetime(2024, 1, 1, 12, 0), 5000, 500, 0.1, 800.0, 2000.0, 100.0, 200.0, 100, 5.0,
         300, "3g", None, "error"),
    ]
    return spark.createDataFrame(rows, "test_id string, test_type string, timestamp timestamp, total_requests long, "
                                       "total_failures long, error_rate double, avg_response_time double, "
                                       "max_response_time double, min_response_time double, requests_per_sec double, "
                                       "concurrent_users long, spawn_rate double, duration long, network_condition "
                                       "string, browser string, status string")


def ids(df):
    return [r.test_id for r in df.collect()]


def test_filters(three):
    assert sorted(ids(RS.filter_runs(three, {"test_type": "api"}))) == ["api_test_1"]
    assert sorted(ids(RS.filter_runs(three, {"test_type": ["api", "load"]}))) == ["api_test_1", "load_test_1"]
    assert ids(RS.filter_runs(three, {"test_type": []})) == []
    assert ids(RS.filter_runs(three, {"browser": None})) == []
    assert ids(RS.get_results(three)) == ["load_test_1", "frontend_test_1", "api_test_1"]
    assert ids(RS.get_results(three, limit=2)) == ["load_test_1", "frontend_test_1"]
    assert len(ids(RS.get_results(three, limit=0))) == 3


def test_recent_and_retention(three):
    as_of = "2024-01-01 13:00:00"
    assert sorted(ids(RS.recent_runs(three, 2, as_of))) == ["frontend_test_1", "load_test_1"]   # inclusive
    kept, deleted = RS.retention_split(three, 0, "2024-01-01 11:00:00")
    assert sorted(ids(kept)) == ["frontend_test_1", "load_test_1"] and ids(deleted) == ["api_test_1"]


def test_summary(three):
    s = RS.run_summary(three).first()
    assert (s.total_tests, s.successful_tests, s.failed_tests) == (3, 2, 1)
    assert s.success_rate == pytest.approx(2 / 3)
    assert s.avg_latency == pytest.approx((150.5 + 200.0) / 2) and s.max_latency == 200.0
    assert s.avg_error_rate == pytest.approx(0.05)    # null error_rate is skipped


def test_validation_and_metadata(spark, three):
    raw = three.select("test_id", "test_type", "timestamp", "concurrent_users", "browser").unionByName(
        spark.createDataFrame([("x", None, None, 5, None)],
                              "test_id string, test_type string, timestamp timestamp, concurrent_users long, browser string"))
    valid, rej = RS.split_batch(raw)
    assert valid.count() == 3
    r = rej.first()
    assert r.test_id == "x" and r.reject_reason == "Missing required field: test_type"
    import json
    meta = json.loads(valid.where("test_id = 'api_test_1'").first().metadata)
    assert meta == {"concurrent_users": 10, "browser": None}     # nulls kept, identity fields left out


def test_rollup_request_stats(spark):
    stats = spark.createDataFrame([("r1", 10, 1, 100.0, 300.0, 10.0, 2.0), ("r1", 30, 2, 200.0, 900.0, 5.0, 4.0),
                                   ("r2", 0, 0, 50.0, 50.0, 50.0, 0.0)],
                                  "test_id string, request_count long, failure_count long, avg_response_time double, "
                                  "max_response_time double, min_response_time double, requests_per_sec double")
    out = {r.test_id: r for r in RS.rollup_request_stats(stats).collect()}
    assert out["r1"].total_requests == 40 and out["r1"].error_rate == pytest.approx(3 / 40)
    assert out["r1"].avg_response_time == 150.0 and out["r1"].max_response_time == 900.0
    assert out["r1"].min_response_time == 5.0 and out["r1"].requests_per_sec == 3.0
    assert out["r2"].error_rate == 0.0


def test_audit_scores(spark):
    text = "\n".join([
        "Audit report", "Performance score 0.9", "Accessibility Score: 0.8", "SEO SCORE 0.7",
        "Best Practices score abc", "Performance score 0.95", "Performance summary without s-c-o-r-e"])
    df = spark.createDataFrame([("t", text), ("empty", "")], "test_id string, text string")
    out = {r.test_id: r for r in RS.audit_scores(df).collect()}
    t = out["t"]
    assert t.performance_score == 0.95          # last counting line wins
    assert t.accessibility_score == 0.0         # token is "Score:" not "score"
    assert t.seo_score == 0.7 and t.best_practices_score == 0.0
    assert out["empty"].performance_score == 0.0


def test_union_results(spark, three):
    err = spark.createDataFrame([("e1", "api", "error", "boom")], "test_id string, test_type string, status string, error string")
    u = RS.union_results(three, err)
    assert u.count() == 4 and u.where(F.col("error") == "boom").first().avg_response_time is None
