"""Named baselines, logs as of a time, repeated ids, folds by key, packed files, newest runs."""

import datetime as dt
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.operators import baselines as BL
from loadlens.operators import drift as DR
from loadlens.operators import loadplan as LP
from loadlens.operators import logs
from loadlens.operators import models as MD
from loadlens.operators import ordering
from loadlens.sources import runstore as IO


def _dir():
    return tempfile.mkdtemp(dir="/tmp")


def test_latest_as_of(spark):
    d = _dir() + "/log"
    rows = [("a", dt.datetime(2024, 1, k), k) for k in range(1, 6)] + [(None, dt.datetime(2024, 1, 3), 9), ("b", dt.datetime(2024, 1, 5), 7)]
    df = spark.createDataFrame(rows, "name string, at timestamp, v int")
    for _ in range(2):
        logs.append(df, d, "one")                               # a repeated batch replaces itself
    logs.append(df.limit(0), d, "empty")
    log = logs.read(spark, d, df.schema)
    assert log.count() == len(rows)
    got = {r.name: r.v for r in logs.latest(log, ["name"], ["at", "v"], "2024-01-04 00:00:00").collect()}
    assert got == {"a": 4, None: 9}
    assert {r.name: r.v for r in logs.latest(log, ["name"], ["v"]).collect()} == {"a": 5, "b": 7, None: 9}


def test_baselines_as_of_unknown_and_unfinished(spark):
    d = _dir()
    assert not BL.has_any(spark, d)
    runs = spark.createDataFrame([("api", float(i), 2.0) for i in range(20)] + [(None, 5.0, float(i)) for i in range(4)], "kind string, x double, y double")
    one = DR.profile_long(runs.where("x < 10"), ["x", "y"], by=["kind"]).withColumnRenamed("kind", "baseline_name")
    two = DR.profile_long(runs, ["x", "y"], by=["kind"]).withColumnRenamed("kind", "baseline_name")
    BL.set_baselines(one, d, "2024-01-01 00:00:00")
    BL.set_baselines(two, d, "2024-02-01 00:00:00")
    two.select("baseline_name", *BL.PROFILE).write.parquet(f"{d}/profiles/version=crashed")   # no commit followed
    asked = spark.createDataFrame([("api", dt.datetime(2024, 1, 15)), ("api", dt.datetime(2024, 3, 1)), ("api", dt.datetime(2023, 1, 1)),
                                   ("nope", dt.datetime(2024, 3, 1))], "baseline_name string, as_of timestamp")
    rows = BL.profiles(BL.lookup(asked, d), d).collect()
    x = {(r.baseline_name, r.as_of.month, r.as_of.year): r for r in rows if r.column in ("x", None)}
    assert x["api", 1, 2024]["max"] == 9.0 and x["api", 3, 2024]["max"] == 19.0 and x["api", 3, 2024].error is None
    assert x["nope", 3, 2024].error == "Baseline 'nope' not found" and x["api", 1, 2023].error == "Baseline 'api' not found"
    assert len(rows) == 6 and BL.has_any(spark, d)
    checks = BL.check_drift(runs.withColumn("kind", F.coalesce("kind", F.lit("nope"))), ["x", "y"], d, ["kind"], F.col("kind"),
                            F.lit("2024-01-15 00:00:00"))
    for _ in range(2):
        BL.log_drift(checks, d, "c1")
    log = {r.baseline_name: r for r in BL.drift_log(spark, d).collect()}
    assert len(log) == 2 and log["nope"].total_features is None and log["nope"].error == "Baseline 'nope' not found"
    assert log["api"].total_features == 2 and log["api"].significant_drift


def test_drift_keeps_null_groups(spark):
    rows = [(None, float(i)) for i in range(10)] + [("a", float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, x double")
    out = DR.data_drift(df, DR.profile_long(df, ["x"], by=["g"]), by=["g"]).collect()
    assert {r.g for r in out} == {None, "a"} and all(r.drift_score == 0 for r in out)


def test_repeated_ids_are_paired_one_to_one(spark):
    """DR1: k rows of an id on both sides give k pairs, in the order of their values; rows in = rows out."""
    pred = [("hot", "m", float(i)) for i in range(50)] + [("one", "m", 1.0), (None, "m", 4.0), ("gone", "m", 1.0)]
    act = [("hot", "m", 10.0 * i) for i in range(50)] + [("one", "m", 2.0), (None, "m", 4.0), ("one", "other", 2.0)]
    p = spark.createDataFrame(pred, "test_id string, metric string, predicted double").repartition(4)
    a = spark.createDataFrame(act, "test_id string, metric string, actual double").repartition(3)
    rows = DR.prediction_deviation(p, a).collect()
    assert len(rows) == 52
    assert sorted((r.predicted, r.actual) for r in rows if r.test_id == "hot") == [(float(i), 10.0 * i) for i in range(50)]
    assert [(r.predicted, r.actual) for r in rows if r.test_id is None] == [(4.0, 4.0)]


@pytest.mark.parametrize("n", [0, 4, 23, 600])
def test_folds_by_key(spark, n):
    r = np.random.default_rng(1)
    t = r.permutation(n)
    df = spark.createDataFrame([(None if v == 0 else int(v) // 3, f"r{v:05d}", float(v)) for v in t.tolist()], "t long, id string, v double")
    size = n // 6
    got = [tuple(x) for x in LP.timeseries_folds(df, ["t", "id"]).collect()]
    starts = [n - (5 - i) * size for i in range(5)]
    assert got == ([(i, s, size, s, s + size - 1) for i, s in enumerate(starts)] if size else [])
    order = [x.v for x in df.orderBy("t", "id").collect()]
    for (train, test), s in zip(MD.time_folds(df, ["t", "id"]), starts):
        assert sorted(x.v for x in train.collect()) == sorted(order[:s])
        assert sorted(x.v for x in test.collect()) == sorted(order[s:s + size])
    ranks = [0, n // 2, n - 1] if n else []
    assert {k: v[1] for k, v in ordering.keys_at(df, ["t", "id"], ranks, 4).items()} == {
        k: df.orderBy("t", "id").collect()[k].id for k in ranks}


def test_search_shares_one_table_and_is_repeatable(spark):
    r = np.random.default_rng(0)
    x = r.random((200, 2))
    df = spark.createDataFrame([(i, float(a), float(b), float(3 * a + b), int(a > 0.5)) for i, (a, b) in enumerate(x)],
                               "id long, a double, b double, y double, c int")
    small = {"maxIter": (2, 4), "maxDepth": (2, 3), "stepSize": (0.1, 0.3), "featureSubsetStrategy": ["all", "sqrt"]}
    runs = [MD.hyper_search(df.repartition(p), ["a", "b"], target, "gbt", problem, trials=2, folds=2, parallelism=2, ranges=small, key=["id"])
            for p in (1, 3) for problem, target in (("regression", "y"), ("classification", "c"))]
    for (_, one), (_, two) in (runs[::2], runs[1::2]):
        assert [(t.trial, t.params) for t in one.orderBy("trial").collect()] == [(t.trial, t.params) for t in two.orderBy("trial").collect()]
        assert all(0 < t.score < 1.2 for t in one.union(two).collect())
    assert {k: type(v) for k, v in MD.trial_grid(small, 3)[2].items()} == {"maxIter": int, "maxDepth": int, "stepSize": float, "featureSubsetStrategy": str}
    assert MD.trial_grid(small, 2) == MD.trial_grid(small, 5)[:2] and MD.trial_grid(small, 2, 1) != MD.trial_grid(small, 2, 2)
    assert runs[0][0].transform(df).select("prediction").count() == 200


def test_files_hold_many_runs(spark):
    d = _dir()
    texts = [(f"run {i}/ü%", f"Performance score {i}\nnothing\n\nSEO score 0.{i}") for i in range(60)] + [("big", "x" * 5000 + "\nPerformance score 7"), ("none", "")]
    df = spark.createDataFrame(texts, "test_id string, text string")
    manifest = {r.test_id: r.file for r in IO.write_audit_reports(df, d + "/audit", 1000).collect()}
    assert len(manifest) == 62 and 4 <= len(set(manifest.values())) <= 8
    got = {r.test_id: r for r in IO.read_audit_files(spark, d + "/audit").collect()}
    assert len(got) == 62 and got["big"].performance_score == 7.0 and got["none"].seo_score == 0.0
    assert all(got[f"run {i}/ü%"].performance_score == i and got[f"run {i}/ü%"].seo_score == float(f"0.{i}") for i in range(60))
    stats = spark.createDataFrame([(f"t{i % 40}", 10, 1, 5.0, 9.0, 1.0, 2.0) for i in range(400)],
                                  "test_id string, request_count long, failure_count long, avg_response_time double, max_response_time double, "
                                  "min_response_time double, requests_per_sec double")
    files = IO.write_load_stats(stats, d + "/stats", 2000)
    assert files.count() == 40 and 2 <= files.select("file").distinct().count() <= 12
    back = IO.read_load_stats(spark, d + "/stats")
    assert back.count() == 400 and back.groupBy("test_id").count().where("count = 10").count() == 40


def test_newest_runs_leave_old_months_alone(spark):
    d = _dir() + "/runs"
    rows = [(f"r{m:02d}{k}", "api", dt.datetime(2024, m, 1 + k), "success" if k else "error") for m in range(1, 13) for k in range(4)]
    IO.store_runs(spark.createDataFrame(rows, "test_id string, test_type string, timestamp timestamp, status string"), d)
    got = IO.newest_runs(spark, d, 5, {"status": "success"})
    assert [r.test_id for r in got.collect()] == ["r123", "r122", "r121", "r113", "r112"]
    plan = got._jdf.queryExecution().toString()
    assert "month" in plan[plan.index("PartitionFilters"):] and "2024-11" in plan
    assert IO.newest_runs(spark, d, 1000, {"status": "success"}).count() == 36
    assert IO.newest_runs(spark, d, 3, {"status": "none"}).count() == 0
