"""Load-configuration operators: grid, search, risk, plans, folds."""

import pytest
from pyspark.sql import functions as F

from loadlens.operators import loadplan as LP


def test_config_grid(spark):
    g = LP.config_grid(spark)
    counts = {r.test_type: r["count"] for r in g.groupBy("test_type").count().collect()}
    assert counts == {"api": 105, "frontend": 18, "load": 5, "stress": 3}
    ids = {r.test_id for r in g.collect()}
    assert "api_10u_wifi__api_health" in ids and "frontend_chrome_wifi__" in ids
    assert "load_10u_1.0s" in ids and "stress_5000u_200.0s" in ids and len(ids) == 131


def test_breaking_point_is_lightest_load_in_reference_mode(spark):
    cand = LP.candidate_grid(spark).withColumn(
        "predicted_latency", 100 + 2 * F.col("concurrent_users") + 50 * F.col("spawn_rate"))
    assert cand.count() == 100 * 100 * 12
    scored = cand.withColumn("objective", LP.load_objective())
    bp = LP.breaking_point(LP.best_candidate(scored)).first()
    assert (bp.concurrent_users, bp.spawn_rate, bp.duration) == (10, 0.5, 300)
    assert not bp.is_breaking_point
    fb = LP.breaking_point(LP.first_breach(scored)).first()
    assert fb.is_breaking_point


def test_risk_config(spark):
    df = spark.createDataFrame([("r", 800, 25.0, 2400, 2, 2500.0)],
                               "test_id string, concurrent_users long, spawn_rate double, duration long, "
                               "network_condition_encoded int, predicted_latency double")
    r = LP.assess_risk(df).first()
    assert r.risk_score == 1.0 and r.risk_level == "critical" and len(r.recommendations) == 5
    a = LP.adjust_risk(df).first()
    assert (a.adjusted_users, a.adjusted_duration) == (560, 1920)
    assert a.adjusted_spawn_rate == pytest.approx(17.5)
    safe = spark.createDataFrame([("s", 10, 1.0, 60, 0, 100.0)], df.schema)
    s = LP.adjust_risk(safe).first()
    assert s.risk_level == "low" and s.recommendations == [LP.SAFE_TEXT] and s.adjusted_users == 13


def test_adaptive_plan_and_actions(spark):
    df = spark.createDataFrame([("r", 100, 5.0, 2500.0, 0.0), ("q", 100, 5.0, 100.0, 0.0)],
                               "test_id string, concurrent_users long, spawn_rate double, avg_response_time double, error_rate double")
    p = {(r.test_id, r.phase): r for r in LP.adaptive_plan(df).collect()}
    assert (p[("r", 1)].users, p[("r", 1)].spawn) == (50, 2.0) and p[("r", 2)].users == 70
    a = {r.test_id: r for r in LP.adaptation_actions(df).collect()}
    assert a["r"].action == "reduce_load" and a["r"].next_users == 80
    assert a["q"].action == "increase_load" and a["q"].next_users == 120


def test_timeseries_folds(spark):
    df = spark.range(100).withColumn("t", F.col("id") * 7 % 100)
    f = [tuple(r) for r in LP.timeseries_folds(df, ["t", "id"]).collect()]
    # n=100, test size 16: train ends 20, 36, 52, 68, 84
    assert [(r[1], r[2]) for r in f] == [(20, 16), (36, 16), (52, 16), (68, 16), (84, 16)]


def test_config_counts_and_first_rows(spark):
    from loadlens.operators import runs as RS
    counts = {r.test_type: r.configs for r in LP.config_counts(LP.config_grid(spark)).collect()}
    assert counts == {"api": 105, "frontend": 18, "load": 5, "stress": 3}
    first = [r.test_id for r in RS.first_rows(LP.config_grid(spark), 2, ["test_id"]).collect()]
    assert first == sorted(first) and len(first) == 2 and first[0].startswith("api_100u")
