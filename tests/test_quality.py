"""Evaluation, anomaly, drift and trend operators on hand-checked inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.operators import anomaly as AN
from loadlens.operators import drift as DR
from loadlens.operators import evaluate as EV
from loadlens.operators import trends as TR


def test_regression_metrics(spark):
    a = np.array([100.0, 200.0, 0.0, 400.0])
    p = np.array([110.0, 190.0, 5.0, 300.0])
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, p)], "actual double, predicted double")
    m = EV.regression_metrics(df).first()
    assert m.mae == pytest.approx(np.mean(np.abs(p - a)))
    assert m.rmse == pytest.approx(np.sqrt(np.mean((p - a) ** 2)))
    assert m.r2 == pytest.approx(1 - np.sum((p - a) ** 2) / np.sum((a - a.mean()) ** 2))
    nz = a != 0
    assert m.mape == pytest.approx(np.mean(np.abs((a[nz] - p[nz]) / a[nz])) * 100)


def test_classification_metrics_weighted(spark):
    y = [0, 0, 1, 1, 1, 2]
    yp = [0, 1, 1, 1, 0, 1]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, yp)], "actual double, predicted double")
    rep = {r.cls: r for r in EV.class_report(df).collect()}
    assert rep[2.0].precision == 0.0 and rep[2.0].recall == 0.0 and rep[2.0].support == 1
    # class 1: predicted 4 times, 2 right; present 3 times
    assert rep[1.0].precision == pytest.approx(2 / 4) and rep[1.0].recall == pytest.approx(2 / 3)
    m = EV.classification_metrics(df).first()
    assert m.accuracy == pytest.approx(3 / 6)
    # support-weighted: class0 p=.5 r=.5, class1 p=.5 r=2/3, class2 0
    f1_1 = 2 * 0.5 * (2 / 3) / (0.5 + 2 / 3)
    assert m.precision == pytest.approx((2 * 0.5 + 3 * 0.5) / 6)
    assert m.recall == pytest.approx(3 / 6)
    assert m.f1 == pytest.approx((2 * 0.5 + 3 * f1_1) / 6)


def test_metric_drift(spark):
    b = spark.createDataFrame([(10.0, 20.0, 0.5)], "mae double, rmse double, r2 double")
    c = spark.createDataFrame([(15.0, 18.0, 0.4)], "mae double, rmse double, r2 double")
    d = {r.metric: r for r in EV.metric_drift(b, c, ["mae", "rmse", "r2"]).collect()}
    assert d["mae"].drift == pytest.approx(0.5) and not d["mae"].improved
    assert d["rmse"].improved and not d["r2"].improved
    assert d["r2"].improved_metrics == 1 and d["r2"].model_degraded
    assert d["r2"].average_drift == pytest.approx((0.5 + 0.1 + 0.2) / 3) and d["r2"].significant_drift


def test_detect_finds_planted_outliers(spark):
    rng = np.random.default_rng(0)
    vals = rng.normal(500, 50, 400).tolist() + [5000.0, 6000.0, 7000.0]
    df = spark.createDataFrame([(f"r{i}", float(v)) for i, v in enumerate(vals)], "test_id string, lat double")
    scored = AN.detect(df, ["lat"])
    log = {r.test_id for r in AN.anomaly_log(scored).collect()}
    assert {"r400", "r401", "r402"} <= log
    al = AN.anomaly_alerts(AN.anomaly_rates(scored), alert_threshold=0.0).first()
    assert al.severity in ("medium", "high") and len(al.recommendations) == 4


def test_prediction_deviation(spark):
    pred = spark.createDataFrame([("x", "avg_response_time", 450.0), ("x", "error_rate", 0.015),
                                  ("x", "only_pred", 1.0)], "test_id string, metric string, predicted double")
    act = spark.createDataFrame([("x", "avg_response_time", 600.0), ("x", "error_rate", 0.025)],
                                "test_id string, metric string, actual double")
    dev = {r.metric: r for r in DR.prediction_deviation(pred, act).collect()}
    assert dev["avg_response_time"].deviation == pytest.approx(0.25) and dev["error_rate"].deviation == pytest.approx(0.4)
    s = DR.deviation_assessment(DR.prediction_deviation(pred, act)).first()
    assert s.anomaly_count == 2 and s.is_significant_drift


def test_data_drift_and_decisions(spark):
    rng = np.random.default_rng(1)
    base = spark.createDataFrame([(float(x), float(y)) for x, y in rng.normal(100, 10, (300, 2))], "a double, b double")
    cur = base.withColumn("a", F.col("a") * 2)
    prof = DR.profile_long(base)
    d = {r.column: r for r in DR.data_drift(cur, prof).collect()}
    assert d["a"].is_drifted and not d["b"].is_drifted and d["a"].significant_drift
    models = spark.createDataFrame([("m", True, 0.5, 50, None)],
                                   "model string, significant_drift boolean, drift_rate double, new_rows long, last_retrained timestamp")
    r = DR.retrain_decisions(models, "2024-01-01 00:00:00").first()
    assert r.should_retrain and r.reasons == ["Significant data drift detected", "Insufficient new data"]


def test_trend_against_polyfit(spark):
    import datetime as dt
    y = [5.0 + 0.5 * i + (i % 3) for i in range(30)]
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(f"r{i:02d}", t0 + dt.timedelta(hours=i), v) for i, v in enumerate(y)],
                               "test_id string, timestamp timestamp, m double")
    r = TR.metric_trends(df, ["m"]).first()
    slope, icpt = np.polyfit(np.arange(30), y, 1)
    assert r.slope == pytest.approx(slope) and r.intercept == pytest.approx(icpt)
    assert r.trend_direction == "Increasing" and r.trend_significance == "Significant"
    const = df.withColumn("m", F.lit(3.0))
    c = TR.metric_trends(const, ["m"]).first()
    assert c.trend_direction == "Stable" and c.r_squared is None
    o = TR.overall_trend(TR.metric_trends(df.withColumn("error_rate", F.col("m")), ["m", "error_rate"])).first()
    assert o.improving_metrics == "m" and o.degrading_metrics == "error_rate"
    assert o.overall_performance_direction == "Stable"


def test_classification_metrics_read_predictions_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (None, 1.0)], "actual double, p double")
    m = EV.classification_metrics(df.select("actual", counted.asNondeterministic()("p").alias("predicted"))).first()
    assert seen.value == 4 and m.accuracy == pytest.approx(2 / 3)
