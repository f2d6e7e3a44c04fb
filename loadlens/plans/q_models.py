"""MLlib and model-based detector queries (rows-only checks: results depend on seeds)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import clusters as CL
from loadlens.operators import detectors as DT
from loadlens.operators import features as FE
from loadlens.operators import models as MD
from loadlens.operators import targets as TG
from loadlens.operators.filters import frame_problem
from loadlens.plans.catalog import register
from loadlens.plans.q_profile import KEY3
from loadlens.sources.tables import order_runs

# the four configuration features a load model sees
LOAD_FEATURES = ["concurrent_users", "spawn_rate", "duration", "network_condition_encoded"]
# target-derived columns kept out of the features (D11 leak guard)
LEAK = ["latency_target", "latency_log", "response_time_p95", "response_time_p99", "avg_response_time",
        "throughput_target", "failure_target", "reliability_target", "performance_target", "anomaly_target",
        "network_performance_impact", "performance_efficiency", "response_time_spread", "error_rate_normalized",
        "reliability_score", "success_rate", "failure_ratio", "total_failures", "error_rate"]


def _engineered(spark, sf):
    r = order_runs(spark, sf)
    return TG.create_targets(FE.engineer_features(r))


def _frame(spark, sf, target):
    """The target's framed rows, assembled and stored once, and the names of their features."""
    fr, feats = frame_problem(_engineered(spark, sf), target, exclude=[c for c in LEAK if c != target])
    return MD.assembled(fr, feats, target, ["test_id"]), feats


@register("group_split", views=["order_runs"], sql="""
SELECT CASE WHEN ('0x' || substr(md5(test_id || ':42'), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS side,
  count(*) AS "rows", count(DISTINCT test_id) AS scenarios
FROM order_runs GROUP BY 1""")
def group_split(spark, sf):
    """M2: scenario split; one row per side with its size and distinct scenarios."""
    tr, te = MD.scenario_split(order_runs(spark, sf))
    return (tr.select(F.lit("train").alias("side"), "test_id")
              .unionByName(te.select(F.lit("test").alias("side"), "test_id"))
              .groupBy("side").agg(F.count("*").alias("rows"), F.countDistinct("test_id").alias("scenarios")))


@register("train_regression")
def train_regression(spark, sf):
    """M1 + M3 + M4: forest regression of latency on engineered features."""
    fr, feats = _frame(spark, sf, "latency_target")
    tr, te = MD.scenario_split(fr)
    _, metrics = MD.train_regression(tr, te, feats, "latency_target")
    return metrics


@register("train_classification")
def train_classification(spark, sf):
    """M1 + M3 + M5: forest classification of the performance target."""
    fr, feats = _frame(spark, sf, "performance_target")
    tr, te = MD.scenario_split(fr)
    _, metrics = MD.train_classification(tr, te, feats, "performance_target")
    return metrics


@register("baseline_models")
def baseline_models(spark, sf):
    """M3: every menu model (forest, boosted trees, linear) on the same split, compared."""
    fr, feats = _frame(spark, sf, "latency_target")
    tr, te = MD.scenario_split(fr)
    out = None
    for name, make in MD.model_menu("regression").items():
        _, m = MD.train_regression(tr, te, feats, "latency_target", make())
        m = m.where(F.col("split") == "test").withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out


@register("cross_validate")
def cross_validate(spark, sf):
    """M6: 5-fold time-series cross-validation of the latency forest."""
    fr, feats = _frame(spark, sf, "latency_target")
    fr = MD.fit_rows(fr.join(order_runs(spark, sf).select("test_id", "timestamp"), "test_id"))
    return MD.cross_validate(fr, feats, "latency_target", ["timestamp", "test_id"], "regression")


@register("importances")
def importances(spark, sf):
    """Ranked feature importances of the latency forest."""
    fr, feats = _frame(spark, sf, "latency_target")
    model, _ = MD.train_regression(fr, fr.limit(0), feats, "latency_target")
    return MD.feature_importances(model, feats)


def _clusters(spark, sf):
    r = order_runs(spark, sf)
    return CL.cluster_runs(r, k=3, seed=42)


@register("kmeans_clusters")
def kmeans_clusters(spark, sf):
    """CL1: k-means (k=3) of standardised run metrics; size and share per cluster."""
    labelled, _, _ = _clusters(spark, sf)
    return CL.cluster_sizes(labelled)


@register("cluster_profile")
def cluster_profile(spark, sf):
    """A6 + A7 + CL2: per-cluster characteristics, performance profile and type."""
    labelled, model, feats = _clusters(spark, sf)
    prof = CL.performance_profile(labelled)
    types = CL.cluster_types(prof)
    ch = CL.cluster_characteristics(labelled, feats)
    return ch.join(types, "cluster", "left")


@register("cluster_spread")
def cluster_spread(spark, sf):
    """CL3: spread of every feature across the cluster centres."""
    _, model, feats = _clusters(spark, sf)
    return CL.center_spread(model, feats)


@register("isolation_forest")
def isolation_forest(spark, sf):
    """AN2a: isolation-forest score and outlier flag per run and key metric."""
    r = order_runs(spark, sf)
    long = DT.long_values(r, KEY3, ["test_id"]).where(F.col("value").isNotNull())
    return DT.isolation_forest(long)


def _unpivoted(src, extra=""):
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in KEY3)
    return (f"(SELECT * FROM (UNPIVOT (SELECT test_id{extra}, {sel} FROM {src}) ON {', '.join(KEY3)} "
            f"INTO NAME \"column\" VALUE value) WHERE value IS NOT NULL)")


# Densities of the training values: neighbours are the 20 nearest of the 20 positions on either side, the lower position first.
LOF_SQL = f"""
t AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS i FROM {{source}}),
around AS (SELECT "column" AS c, i, value, list({{{{'j': i, 'v': value}}}}) OVER (PARTITION BY "column" ORDER BY i ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING) AS l FROM t),
near AS MATERIALIZED (SELECT c, i, o.j AS j, abs(o.v - value) AS d FROM (SELECT c, i, value, unnest(l) AS o FROM around) WHERE o.j <> i
  QUALIFY row_number() OVER (PARTITION BY c, i ORDER BY abs(o.v - value), o.j) <= 20),
kd AS MATERIALIZED (SELECT c, i, max(d) AS kdist FROM near GROUP BY ALL),
dens AS MATERIALIZED (SELECT n.c, n.i, 1 / (avg(greatest(k.kdist, n.d)) + 1e-10) AS lrd
  FROM near n JOIN kd k ON k.c = n.c AND k.i = n.j GROUP BY ALL),
around_lrd AS MATERIALIZED (SELECT n.c, n.i, avg(o.lrd) AS lrd FROM near n JOIN dens o ON o.c = n.c AND o.i = n.j GROUP BY ALL),
lofs AS MATERIALIZED (SELECT a.c, a.i, a.lrd / s.lrd AS lof FROM around_lrd a JOIN dens s ON s.c = a.c AND s.i = a.i),
lofcut AS (SELECT c, quantile_cont(lof, 0.9) * (1 + 1e-9) AS cut FROM lofs GROUP BY ALL)"""


@register("lof_1d", views=["order_runs"], rnd=["value", "log_lof"], sql=f"""
WITH {LOF_SQL.format(source=_unpivoted('order_runs'))}
SELECT test_id, "column", value, ln(lof) AS log_lof, lof > cut AS lof_outlier
FROM t JOIN lofs l ON l.c = t."column" AND l.i = t.i JOIN lofcut q ON q.c = t."column" """)
def lof_1d(spark, sf):
    """AN2b: exact one-dimensional local outlier factor (k=20) per run and key metric, as its logarithm."""
    r = order_runs(spark, sf)
    long = DT.long_values(r, KEY3, ["test_id"]).where(F.col("value").isNotNull())
    return DT.local_outlier_factor(long).select("test_id", "column", "value", F.ln("lof").alias("log_lof"), "lof_outlier")


@register("anomaly_score_new", views=["baseline_runs", "current_runs"], rnd=["value", "log_lof", "distance"], sql=f"""
WITH {LOF_SQL.format(source=_unpivoted('baseline_runs'))},
th AS (SELECT "column" AS c, avg(value) + 3 * stddev_pop(value) AS z3,
    quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS low,
    quantile_cont(value, 0.5) AS m FROM t GROUP BY 1),
sc AS (SELECT "column" AS c, 1.4826 * coalesce(nullif(quantile_cont(abs(value - m), 0.5), 0), 1) AS s
  FROM t JOIN th ON th.c = t."column" GROUP BY 1),
rcut AS (SELECT "column" AS c, quantile_cont(abs(value - m) / s, 0.9) AS q
  FROM t JOIN th ON th.c = t."column" JOIN sc ON sc.c = t."column" GROUP BY 1),
new AS (SELECT * FROM {_unpivoted('current_runs')}),
place AS (SELECT "column", value, place_no FROM (SELECT "column", value, fresh, sum(1 - fresh) OVER (
      PARTITION BY "column" ORDER BY value, fresh DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS place_no
    FROM (SELECT DISTINCT "column", value, 1 AS fresh FROM new UNION ALL SELECT "column", value, 0 FROM t)) WHERE fresh = 1),
nnear AS MATERIALIZED (SELECT p."column" AS c, p.value AS x, b.i AS j, abs(b.value - p.value) AS d
  FROM (SELECT "column", value, place_no + o AS near_no FROM place, (SELECT unnest(range(-20, 20)) AS o)) p
  JOIN t b ON b."column" = p."column" AND b.i = p.near_no
  QUALIFY row_number() OVER (PARTITION BY p."column", p.value ORDER BY abs(b.value - p.value), b.i) <= 20),
ofs AS MATERIALIZED (SELECT k.c, k.i, k.kdist, o.lrd FROM kd k JOIN dens o ON o.c = k.c AND o.i = k.i),
nlof AS MATERIALIZED (SELECT n.c, n.x, avg(o.lrd) * (avg(greatest(o.kdist, n.d)) + 1e-10) AS lof
  FROM nnear n JOIN ofs o ON o.c = n.c AND o.i = n.j GROUP BY ALL)
SELECT test_id, "column", value, ln(lof) AS log_lof, CAST(NOT lof > cut AS INTEGER) AS v_lof, abs(value - m) / s AS distance,
  CAST(NOT abs(value - m) / s > q AS INTEGER) AS v_envelope, value > z3 AS threshold_exceeded, true AS vote_holds
FROM new JOIN nlof l ON l.c = new."column" AND l.x = new.value JOIN lofcut lc ON lc.c = new."column"
JOIN th ON th.c = new."column" JOIN sc ON sc.c = new."column" JOIN rcut ON rcut.c = new."column" """)
def anomaly_score_new(spark, sf):
    """AN2 + AN3: detectors fitted on the baseline runs, kept, and applied to the current runs.

    ``vote_holds`` checks the ensemble's verdict against the three votes and the statistical rule.
    """
    from loadlens.operators import kept
    from loadlens.session import scratch_path
    from loadlens.sources.tables import baseline_runs, current_runs
    folder = kept.fit(baseline_runs(spark, sf), KEY3, scratch_path(spark, "detectors"))
    scored = kept.score(current_runs(spark, sf), folder)
    votes = F.col("v_forest") + F.col("v_lof") + F.col("v_envelope")
    return scored.select(
        "test_id", "column", "value", F.ln("lof").alias("log_lof"), "v_lof", "distance", "v_envelope", "threshold_exceeded",
        ((F.abs(F.col("model_consensus") - votes / 3) < 1e-12)
         & (F.col("is_anomaly") == ((votes < 2) | F.col("statistical")))).alias("vote_holds"))


@register("load_model_search")
def load_model_search(spark, sf):
    """D4 + LC2-LC5: a 4-feature latency model scores a generated candidate grid; best row."""
    from loadlens.operators import loadplan as LP
    r = order_runs(spark, sf)
    st = FE.fit_feature_stats(r.select("network_condition"))
    d = FE.category_codes(r, "network_condition", "network_condition_encoded", st.codes["network_condition"])
    model, _ = MD.train_regression(d, d.limit(0), LOAD_FEATURES, "avg_response_time",
                                   MD.RandomForestRegressor(numTrees=50, seed=MD.SEED))
    cand = FE.category_codes(LP.candidate_grid(spark).withColumn("network_condition", F.lit("wifi")), "network_condition",
                             "network_condition_encoded", st.codes["network_condition"]).drop("network_condition")
    scored = model.transform(cand).withColumnRenamed("prediction", "predicted_latency")
    scored = scored.drop("features").withColumn("objective", LP.load_objective())
    return LP.breaking_point(LP.best_candidate(scored))
