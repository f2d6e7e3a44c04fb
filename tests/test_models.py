"""Model-based operators: properties (split disjoint, importances sum to 1, planted outliers)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.operators import clusters as CL
from loadlens.operators import detectors as DT
from loadlens.operators import features as FE
from loadlens.operators import models as MD


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(3)
    vals = rng.normal(100, 10, 1500).tolist() + [400.0, 500.0, -200.0]
    rows = [(f"r{i:05d}", "lat", float(v)) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "test_id string, column string, value double")


def test_lof_blocks_equal_single_block(spark, planted):
    dist = {r.test_id: r.lof for r in DT.local_outlier_factor(planted, block_rows=250).collect()}
    pdf = planted.toPandas().sort_values(["value", "test_id"], kind="stable").reset_index(drop=True)
    exp = DT._lof_block(pdf["value"].to_numpy(), 20)[0]
    got = np.array([dist[t] for t in pdf["test_id"]])
    assert np.allclose(got, exp)
    out = {r.test_id for r in DT.local_outlier_factor(planted, block_rows=250).where("lof_outlier").collect()}
    assert {"r01500", "r01501", "r01502"} <= out


def test_isolation_forest_finds_planted(spark, planted):
    s = DT.isolation_forest(planted).orderBy(F.col("iforest_score").desc()).limit(3).collect()
    assert {r.test_id for r in s} == {"r01500", "r01501", "r01502"}
    assert all(0 < r.iforest_score <= 1 for r in s)


def test_scenario_split_disjoint(spark, sf):
    from loadlens.sources.tables import order_runs
    r = order_runs(spark, sf)
    tr, te = MD.scenario_split(r)
    assert tr.join(te, "test_id").count() == 0
    n, a = r.count(), tr.count()
    assert a + te.count() == n and 0.7 < a / n < 0.9


def test_forest_importances_and_kmeans(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    y = 3 * x[:, 0] + 0.1 * rng.normal(size=400)
    df = spark.createDataFrame([(f"t{i}", *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))],
                               "test_id string, a double, b double, c double, y double")
    model, m = MD.train_regression(df, df, ["a", "b", "c"], "y", MD.RandomForestRegressor(numTrees=20, seed=1))
    imp = MD.feature_importances(model, ["a", "b", "c"]).collect()
    assert imp[0].feature == "a" and sum(r.importance for r in imp) == pytest.approx(1.0)
    assert m.where("split = 'test'").first().r2 > 0.8
    lab, km, feats = CL.cluster_runs(df, k=3)
    sizes = CL.cluster_sizes(lab).collect()
    assert sum(r.size for r in sizes) == 400 and sum(r.percentage for r in sizes) == pytest.approx(100)
    assert CL.center_spread(km, feats).count() == len(feats)


def test_cluster_types():
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    prof = spark.createDataFrame([(0, "avg_response_time", 100.0), (1, "avg_response_time", 900.0),
                                  (2, "avg_response_time", 3000.0), (3, "error_rate", 0.2)],
                                 "cluster int, metric string, mean double")
    t = {r.cluster: r.cluster_type for r in CL.cluster_types(prof).collect()}
    assert t == {0: "High Performance", 1: "Medium Performance", 2: "Low Performance", 3: "Unreliable"}


def test_hyper_search_small(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(120, 2))
    df = spark.createDataFrame([(float(a), float(b), float(2 * a + b)) for a, b in x], "a double, b double, y double")
    small = {"numTrees": (2, 5), "maxDepth": (2, 4), "featureSubsetStrategy": ["all"]}
    best, trials = MD.hyper_search(df, ["a", "b"], "y", "random_forest", trials=2, folds=2, parallelism=2, ranges=small)
    assert trials.count() == 2 and best is not None
    with pytest.raises(ValueError):
        MD.hyper_search(df, ["a", "b"], "y", "svm")


def test_registry_versions_and_summary(spark):
    import datetime as dt
    import tempfile
    reg = tempfile.mkdtemp(prefix="loadlens-reg-", dir="/tmp")
    rng = np.random.default_rng(11)
    rows = [(f"t{i}", float(a), float(b), float(2 * a - b)) for i, (a, b) in enumerate(rng.normal(size=(80, 2)))]
    df = spark.createDataFrame(rows, "test_id string, a double, b double, y double")
    small = MD.retrain_model(df.limit(10), "m", "y", reg)
    assert small == {"success": False, "error": "Insufficient data", "data_samples": 10}
    r1 = MD.retrain_model(df, "m", "y", reg, now=dt.datetime(2024, 1, 1, 9, 0, 0))
    r2 = MD.retrain_model(df, "m", "y", reg, now=dt.datetime(2024, 1, 2, 8, 0, 0))
    assert r1["success"] and r2["version"] == "20240102_080000"
    latest = MD.load_model(spark, reg, "m")
    assert latest.stages[-1].getNumTrees == 100
    cmp = MD.compare_versions(spark, reg, "m", ["20240101_090000", "20240102_080000", "missing"])
    assert cmp.count() == 2
    log = MD.registry(spark, reg).select(
        "model_name", F.to_timestamp("training_date").alias("timestamp"), F.col("cv_mean").alias("cv_score"))
    s = MD.retraining_summary(log, "2024-01-05 00:00:00").first()
    assert s.total_retrainings == 2 and s.models_retrained == 1 and s.recent_retrainings == 2
    assert s.retrainings_by_model == {"m": 2}


def test_explanations_and_extensions(spark):
    from loadlens import extensions as X
    imp = spark.createDataFrame([("concurrent_users", 0.5, 1), ("network_condition_encoded", 0.3, 2),
                                 ("duration", 0.2, 3)], "feature string, importance double, rank int")
    lines = [r.line for r in MD.explanation_summary(imp).orderBy("line_no").collect()]
    assert lines[0] == "'concurrent_users' is the most important feature (50.00%)"
    assert len(lines) == 5
    X.register_feature("double_a", lambda d: d.withColumn("a2", F.col("a") * 2))
    out = X.apply_custom_features(spark.createDataFrame([(1.0,)], "a double")).first()
    assert out.a2 == 2.0
    try:
        runs = spark.createDataFrame([("x", 1.0, 2)], "test_id string, a double, concurrent_users int")
        assert FE.engineer_features(runs).first().a2 == 2.0         # registered functions take effect after the built-in groups
        X.register_model("regression", "my_lr", lambda: MD.LinearRegression(regParam=0.1))
        assert "my_lr" in X.models_for("regression") and "random_forest" in X.models_for("regression")
        assert MD.model_menu("regression")["my_lr"]().getRegParam() == 0.1 and "my_lr" not in MD.model_menu("classification")
    finally:
        X.FEATURE_FUNCTIONS.clear()
        X.CUSTOM_MODELS["regression"].clear()


def test_recommendation_lines(spark):
    from loadlens.operators import loadplan as LP
    bp = spark.createDataFrame([(100, 5.0, 300, 800.0, 500.0)],
                               "concurrent_users long, spawn_rate double, duration long, predicted_latency double, "
                               "estimated_throughput double")
    lines = [r.line for r in LP.recommendation_lines(bp).orderBy("line_no").collect()]
    assert lines[0] == "Safe load: 80 users at 4.0 users/sec"
    assert lines[2] == "Expected breaking point: 100 users"
    rec = {r.kind: r for r in LP.load_recommendations(bp).collect()}
    assert rec["safe_load"].concurrent_users == 80 and rec["stress_test"].concurrent_users == 110


def test_scenario_membership(spark):
    runs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "test_id string, v int")
    train_ids = spark.createDataFrame([("a",), ("c",), ("c",)], "test_id string")
    tr = MD.scenario_membership(runs, train_ids)
    te = MD.scenario_membership(runs, train_ids, keep=False)
    assert sorted(r.v for r in tr.collect()) == [1, 2, 4] and [r.v for r in te.collect()] == [3]


def test_forest_scores_are_steps_of_the_walked_trees():
    rng = np.random.default_rng(5)
    trees = [DT._grow(rng.normal(size=256).round(2), rng, 8) for _ in range(30)]
    edges, scores = DT.score_steps(trees, 256)
    x = np.concatenate([rng.normal(size=500), edges, [np.inf, -np.inf, np.nan]])
    walked = 2.0 ** (-np.mean([DT._path_length(x, t) for t in trees], axis=0) / DT._c(np.array([256]))[0])
    assert np.allclose(scores[np.searchsorted(edges, x, "right")], walked, rtol=1e-12)


def test_forest_draws_are_the_smallest_hashes_of_each_tree(spark):
    drawn = DT.drawn_numbers(spark, 2000, n_trees=3, sample_size=16)
    h = spark.range(2000).select("id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("tree")).withColumn("h", F.xxhash64("id", "tree", F.lit(42)))
    kept = [r for r in h.collect() if r.h % 2 ** 31 < int(2.0 * 16 / 2000 * 2 ** 31)]
    want = {(r.id, r.tree) for t in range(3) for r in sorted((r for r in kept if r.tree == t), key=lambda r: (r.h, r.id))[:16]}
    assert {(r["_i"], r.tree) for r in drawn.collect()} == want


def test_a_fit_reads_bounded_files(spark, monkeypatch):
    from loadlens.operators import ordering as OR
    monkeypatch.setattr(OR, "ROWS_PER_FILE", 100)
    rows = MD.assembled(spark.range(1000).select("id", F.rand(1).alias("a"), F.rand(2).alias("y")).coalesce(1), ["a"], "y")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    with OR.task_per_file(spark):
        parts = rows.select("y").rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert max(parts) <= 100 and sum(parts) == 1000 and spark.conf.get("spark.sql.files.openCostInBytes") == cost
    assert MD.assembled(rows, ["a"], "y") is rows


def test_searches_share_their_rows(spark):
    df = spark.range(300).select("id", (F.rand(7) * 10).alias("a"), F.rand(8).alias("b")).withColumn("y", F.col("a") * 3).withColumn("z", (F.col("a") > 5).cast("int"))
    small = {"numTrees": (3, 5), "maxDepth": (2, 3), "minInstancesPerNode": (1, 5), "featureSubsetStrategy": ["all"]}
    table = MD.search_rows(df, ["a", "b"], ["y", "z"], 2, ["id"])
    for target, problem in (("y", "regression"), ("z", "classification")):
        _, trials = MD.hyper_search(table, ["a", "b"], target, "random_forest", problem, 1, 2, ranges=small)
        assert trials.first().score > 0


def test_clusters_are_fitted_on_bounded_files(spark, monkeypatch):
    from loadlens.operators import clusters as CL
    from loadlens.operators import ordering as OR
    monkeypatch.setattr(OR, "ROWS_PER_FILE", 100)
    seen = []

    class Spy(CL.KMeans):
        def fit(self, rows):
            seen.extend(rows.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect())
            return super().fit(rows)

    monkeypatch.setattr(CL, "KMeans", Spy)
    df = spark.range(1000).select(F.col("id").cast("string").alias("test_id"), F.rand(1).alias("a"), F.rand(2).alias("b")).coalesce(1)
    labelled, model, feats = CL.cluster_runs(df, k=3)
    assert max(seen) <= 100 and sum(seen) == 1000
    assert sum(r.size for r in CL.cluster_sizes(labelled).collect()) == 1000 and feats == ["a", "b"]


@pytest.mark.parametrize("name", ["cluster_profile", "report_json"])
def test_queries_with_clusters_fit_on_bounded_files(spark, monkeypatch, tmp_path, name):
    import __spark_entry__ as E
    from pyspark.ml.base import Estimator

    from loadlens.operators import ordering as OR
    i = F.col("id")
    spark.range(300).select(
        i.alias("o_orderkey"), (i % 97).alias("o_custkey"), F.element_at(F.array(*map(F.lit, "FOP")), (i % 3 + 1).cast("int")).alias("o_orderstatus"),
        (F.rand(1) * 1000).alias("o_totalprice"), F.timestamp_seconds(i * 86400).alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(900).select(
        (i % 300).alias("l_orderkey"), (1 + i % 50).cast("double").alias("l_quantity"), (F.rand(2) * 90000).alias("l_extendedprice"),
        (i % 11 / 100).alias("l_discount"), (i % 9 / 100).alias("l_tax"), F.lit("R").alias("l_returnflag")).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(OR, "ROWS_PER_FILE", 100, raising=False)
    seen, fit = [], Estimator.fit

    def spy(self, rows, *params):
        seen.append(rows.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect())
        return fit(self, rows, *params)

    monkeypatch.setattr(Estimator, "fit", spy)
    E.queries()[name](spark, str(tmp_path))
    assert max(map(max, seen)) <= 100 and {sum(s) for s in seen} == {300}
