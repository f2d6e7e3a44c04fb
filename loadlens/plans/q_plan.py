"""Trend and load-configuration queries over the run table."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import features as FE
from loadlens.operators import loadplan as LP
from loadlens.operators import trends as TR
from loadlens.plans.catalog import register
from loadlens.plans.q_profile import KEY3
from loadlens.sources.tables import order_runs

TREND_SQL = f"""
u AS (SELECT * FROM (UNPIVOT (SELECT test_id, ts, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in KEY3)} FROM order_runs)
      ON {', '.join(KEY3)} INTO NAME metric VALUE value) WHERE value IS NOT NULL AND NOT isnan(value)),
x AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY ts, test_id) - 1 AS x FROM u),
g AS (SELECT metric, count(*) AS n, regr_slope(value, x) AS slope, regr_intercept(value, x) AS intercept,
        CASE WHEN var_pop(value) = 0 THEN NULL ELSE regr_r2(value, x) END AS r_squared,
        stddev_pop(value) AS sdp, avg(value) AS mean_value, stddev_samp(value) AS std_value,
        min(ts) AS s, max(ts) AS e FROM x GROUP BY metric HAVING count(*) > 10),
t AS (SELECT metric, n, slope, intercept, r_squared,
        CASE WHEN sdp = 0 OR abs(slope) < 0.01 * sdp THEN 'Stable' WHEN slope > 0 THEN 'Increasing' ELSE 'Decreasing' END AS trend_direction,
        CASE WHEN coalesce(r_squared > 0.3, false) THEN 'Significant' ELSE 'Weak' END AS trend_significance,
        mean_value, std_value,
        CASE WHEN mean_value <> 0 THEN slope * n / mean_value * 100 ELSE 0.0 END AS change_percentage,
        strftime(s, '%Y-%m-%d %H:%M:%S') AS "start", strftime(e, '%Y-%m-%d %H:%M:%S') AS "end",
        CAST(date_diff('day', CAST(s AS DATE), CAST(e AS DATE)) AS INTEGER) AS duration_days FROM g)"""
TREND_RND = ["slope", "intercept", "r_squared", "mean_value", "std_value", "change_percentage"]


@register("trend_metrics", views=["order_runs"], rnd=TREND_RND, sql=f"WITH {TREND_SQL}\nSELECT * FROM t")
def trend_metrics(spark, sf):
    """TR1 + TR2: per metric linear trend over time-ordered runs."""
    t = TR.metric_trends(order_runs(spark, sf), KEY3)
    return t.withColumns({"start": F.date_format("start", "yyyy-MM-dd HH:mm:ss"),
                          "end": F.date_format("end", "yyyy-MM-dd HH:mm:ss")})


@register("trend_overall", views=["order_runs"], sql=f"""
WITH {TREND_SQL},
c AS (SELECT *, CASE WHEN trend_direction = 'Increasing' THEN
                       CASE WHEN lower(metric) LIKE '%latency%' OR lower(metric) LIKE '%error%' THEN 'degrading' ELSE 'improving' END
                     WHEN trend_direction = 'Decreasing' THEN
                       CASE WHEN lower(metric) LIKE '%latency%' OR lower(metric) LIKE '%error%' THEN 'improving' ELSE 'degrading' END
                     ELSE 'stable' END AS cls FROM t)
SELECT coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (WHERE cls = 'improving'), '') AS improving_metrics,
  coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (WHERE cls = 'degrading'), '') AS degrading_metrics,
  coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (WHERE cls = 'stable'), '') AS stable_metrics,
  coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (WHERE trend_significance = 'Significant'), '') AS significant_trends,
  CASE WHEN count(*) FILTER (WHERE cls = 'improving') > count(*) FILTER (WHERE cls = 'degrading') THEN 'Improving'
       WHEN count(*) FILTER (WHERE cls = 'degrading') > count(*) FILTER (WHERE cls = 'improving') THEN 'Degrading'
       ELSE 'Stable' END AS overall_performance_direction FROM c""")
def trend_overall(spark, sf):
    """TR3: improving/degrading/stable metrics and the majority direction."""
    return TR.overall_trend(TR.metric_trends(order_runs(spark, sf), KEY3))


def _candidates(spark, sf):
    """Observed runs as candidates; their measured latency stands for the prediction."""
    r = order_runs(spark, sf)
    return r.select("test_id", "timestamp", "test_type", "concurrent_users", "spawn_rate", "duration",
                    "network_condition", F.col("avg_response_time").alias("predicted_latency"),
                    "avg_response_time", "error_rate")


OBJ_SQL = """avg_response_time + greatest(0, avg_response_time - 2000.0) * 10
  + greatest(0, greatest(0, concurrent_users * spawn_rate / 1000.0 - 0.5) * 0.1 - 0.05) * 1000"""
ERR_SQL = "greatest(0, concurrent_users * spawn_rate / 1000.0 - 0.5) * 0.1"
BP_RND = ["predicted_latency", "estimated_throughput", "estimated_error_rate", "objective_value"]


def _bp_sql(order, where="TRUE", obj=OBJ_SQL):
    return f"""
WITH s AS (SELECT *, {obj} AS objective FROM order_runs WHERE {where}),
b AS (SELECT * FROM s ORDER BY {order} LIMIT 1)
SELECT CAST(concurrent_users AS BIGINT) AS concurrent_users, round(spawn_rate, 2) AS spawn_rate, CAST(duration AS BIGINT) AS duration,
  round(avg_response_time, 2) AS predicted_latency, round(concurrent_users * spawn_rate, 2) AS estimated_throughput,
  round({ERR_SQL}, 4) AS estimated_error_rate, round(objective, 2) AS objective_value,
  avg_response_time > 2000.0 OR {ERR_SQL} > 0.05 AS is_breaking_point FROM b"""


@register("load_search", views=["order_runs"], rnd=BP_RND,
          sql=_bp_sql("objective, concurrent_users, spawn_rate, duration, test_id"))
def load_search(spark, sf):
    """LC3 + LC5 (mode reference): argmin of the load objective over all runs."""
    c = _candidates(spark, sf).withColumn("objective", LP.load_objective())
    best = LP.best_candidate(c, tie_break=("concurrent_users", "spawn_rate", "duration", "test_id"))
    return LP.breaking_point(best)


@register("load_first_breach", views=["order_runs"], rnd=BP_RND,
          sql=_bp_sql("concurrent_users * spawn_rate, concurrent_users, spawn_rate, duration, test_id",
                      where=f"avg_response_time > 2000.0 OR {ERR_SQL} > 0.05"))
def load_first_breach(spark, sf):
    """LC5 (mode first_breach): lightest run load that breaks a limit."""
    c = _candidates(spark, sf).withColumn("objective", LP.load_objective())
    best = LP.first_breach(c, tie_break=["test_id"])
    return LP.breaking_point(best)


TGT_OBJ = """avg_response_time + greatest(0, avg_response_time - 1000) * 10
  + greatest(0, 100 - concurrent_users * spawn_rate) * 5
  + greatest(0, greatest(0, concurrent_users * spawn_rate / 1000.0 - 0.5) * 0.1 - 0.01) * 1000"""


@register("target_search", views=["order_runs"], rnd=["predicted_latency", "predicted_throughput", "predicted_error_rate", "objective"], sql=f"""
WITH s AS (SELECT *, {TGT_OBJ} AS objective FROM order_runs)
SELECT test_id, CAST(concurrent_users AS BIGINT) AS concurrent_users, spawn_rate, CAST(duration AS BIGINT) AS duration,
  round(avg_response_time, 2) AS predicted_latency, round(concurrent_users * spawn_rate, 2) AS predicted_throughput,
  round({ERR_SQL}, 4) AS predicted_error_rate, objective,
  avg_response_time <= 1000 AND concurrent_users * spawn_rate >= 100 AND {ERR_SQL} <= 0.01 AS meets_targets
FROM s ORDER BY objective, concurrent_users, spawn_rate, duration, test_id LIMIT 1""")
def target_search(spark, sf):
    """LC4: best run for latency < 1000 ms, throughput > 100/s, error < 1 %."""
    c = _candidates(spark, sf).withColumn("objective", LP.target_objective())
    b = LP.best_candidate(c, tie_break=("concurrent_users", "spawn_rate", "duration", "test_id"))
    return b.select("test_id", "concurrent_users", "spawn_rate", "duration", F.round("predicted_latency", 2).alias("predicted_latency"),
                    F.round(F.col("concurrent_users") * F.col("spawn_rate"), 2).alias("predicted_throughput"),
                    F.round(LP.estimated_error_rate(), 4).alias("predicted_error_rate"), "objective",
                    LP.meets_targets().alias("meets_targets"))


@register("load_recommendations", views=["order_runs"], rnd=["spawn_rate", "expected_latency", "expected_throughput"], sql=f"""
WITH bp AS ({_bp_sql('objective, concurrent_users, spawn_rate, duration, test_id')})
SELECT 'safe_load' AS kind, CAST(trunc(concurrent_users * 0.8E0) AS BIGINT) AS concurrent_users, round(spawn_rate * 0.8E0, 2) AS spawn_rate,
  duration, round(predicted_latency * 0.7E0, 2) AS expected_latency, round(estimated_throughput * 0.8E0, 2) AS expected_throughput FROM bp
UNION ALL
SELECT 'stress_test', CAST(trunc(concurrent_users * 1.1E0) AS BIGINT), round(spawn_rate * 1.1E0, 2), duration,
  round(predicted_latency * 1.2E0, 2), round(estimated_throughput * 1.1E0, 2) FROM bp""")
def load_recommendations(spark, sf):
    """LC6: safe and stress loads around the found point."""
    return LP.load_recommendations(load_search(spark, sf))


def _risk_input(spark, sf):
    c = _candidates(spark, sf)
    st = FE.fit_feature_stats(c.select("network_condition"))
    return FE.category_codes(c, "network_condition", "network_condition_encoded", st.codes["network_condition"])


RISK_CTE = """
codes AS (SELECT network_condition AS v, row_number() OVER (ORDER BY network_condition) - 1 AS code
          FROM (SELECT DISTINCT network_condition FROM order_runs WHERE network_condition IS NOT NULL)),
r AS (SELECT o.*, coalesce(code, -1) AS net_code FROM order_runs o LEFT JOIN codes ON network_condition = v)"""


def _flags(u="concurrent_users", s="spawn_rate", d="duration"):
    return [f"coalesce({u} > 500, false)", f"coalesce({s} > 20, false)", f"coalesce({d} > 1800, false)",
            "coalesce(net_code > 1, false)", "coalesce(avg_response_time > 2000.0, false)"]


RISK_TEXTS = list(LP.RISK_TEXT.values())


def _score(fl):
    return "(" + " + ".join(f"CAST({f} AS INTEGER)" for f in fl) + ") / 5.0"


def _level(sc):
    return (f"CASE WHEN {sc} >= 0.8 THEN 'critical' WHEN {sc} >= 0.6 THEN 'high' WHEN {sc} >= 0.4 THEN 'medium' "
            f"ELSE 'low' END")


def _recs(fl):
    parts = ", ".join(f"CASE WHEN {f} THEN '{t}' END" for f, t in zip(fl, RISK_TEXTS))
    return f"coalesce(nullif(concat_ws('; ', {parts}), ''), '{LP.SAFE_TEXT}')"


@register("risk_assess", views=["order_runs"], rnd=["risk_score"], sql=f"""
WITH {RISK_CTE}
SELECT test_id, {_score(_flags())} AS risk_score, {_level(_score(_flags()))} AS risk_level,
  {_recs(_flags())} AS recommendations FROM r""")
def risk_assess(spark, sf):
    """LC7: risk score, level and recommendations of every run's configuration."""
    a = LP.assess_risk(_risk_input(spark, sf))
    return a.select("test_id", "risk_score", "risk_level", F.array_join("recommendations", "; ").alias("recommendations"))


_ADJ = f"""
a AS (SELECT *, {_level(_score(_flags()))} AS lvl, {_flags()[0]} AS fu, {_flags()[1]} AS fs, {_flags()[2]} AS fd FROM r),
b AS (SELECT *, lvl <> 'medium' AS adjustments_needed,
  CASE WHEN lvl <> 'medium' AND lvl IN ('critical', 'high') AND fu THEN CAST(trunc(concurrent_users * 0.7E0) AS BIGINT)
       WHEN lvl <> 'medium' AND lvl = 'low' THEN CAST(trunc(concurrent_users * 1.3E0) AS BIGINT)
       ELSE concurrent_users END AS adjusted_users,
  CASE WHEN lvl <> 'medium' AND lvl IN ('critical', 'high') AND fs THEN spawn_rate * 0.7E0
       WHEN lvl <> 'medium' AND lvl = 'low' THEN spawn_rate * 1.2E0 ELSE spawn_rate END AS adjusted_spawn_rate,
  CASE WHEN lvl <> 'medium' AND lvl IN ('critical', 'high') AND fd THEN CAST(trunc(duration * 0.8E0) AS BIGINT)
       ELSE duration END AS adjusted_duration FROM a)"""


@register("risk_adjust", views=["order_runs"], rnd=["adjusted_spawn_rate", "adjusted_risk_score"], sql=f"""
WITH {RISK_CTE}, {_ADJ}
SELECT test_id, lvl AS risk_level, adjustments_needed, adjusted_users, adjusted_spawn_rate, adjusted_duration,
  {_score(_flags('adjusted_users', 'adjusted_spawn_rate', 'adjusted_duration'))} AS adjusted_risk_score,
  {_level(_score(_flags('adjusted_users', 'adjusted_spawn_rate', 'adjusted_duration')))} AS adjusted_risk_level FROM b""")
def risk_adjust(spark, sf):
    """LC8: adjust each configuration toward medium risk and reassess."""
    a = LP.adjust_risk(_risk_input(spark, sf))
    return a.select("test_id", "risk_level", "adjustments_needed", "adjusted_users", "adjusted_spawn_rate",
                    "adjusted_duration", "adjusted_risk_score", "adjusted_risk_level")


@register("adaptive_plan", views=["order_runs"], rnd=["spawn", "success_threshold"], sql="""
SELECT test_id, 1 AS phase, 'Baseline' AS name, least(concurrent_users, 50) AS users, least(spawn_rate, 2.0E0) AS spawn,
  300 AS phase_duration, 0.8E0 AS success_threshold FROM order_runs
UNION ALL
SELECT test_id, 2, 'Progressive Load', CAST(trunc(concurrent_users * 0.7E0) AS BIGINT), spawn_rate * 0.8E0, 600, 0.7E0 FROM order_runs
UNION ALL
SELECT test_id, 3, 'Target Load', concurrent_users, spawn_rate, 900, 0.6E0 FROM order_runs""")
def adaptive_plan(spark, sf):
    """LC9: three-phase adaptive test plan per run configuration."""
    return LP.adaptive_plan(order_runs(spark, sf))


@register("adaptation_actions", views=["order_runs"], rnd=["next_spawn_rate"], sql="""
SELECT test_id,
  CASE WHEN avg_response_time > 2000 THEN 'reduce_load' WHEN error_rate > 0.05 THEN 'reduce_load'
       WHEN avg_response_time < 500 AND error_rate < 0.01 THEN 'increase_load' ELSE 'hold' END AS action,
  CAST(trunc(concurrent_users * CASE WHEN avg_response_time > 2000 THEN 0.8E0 WHEN error_rate > 0.05 THEN 0.7E0
       WHEN avg_response_time < 500 AND error_rate < 0.01 THEN 1.2E0 ELSE 1.0E0 END) AS BIGINT) AS next_users,
  spawn_rate * CASE WHEN avg_response_time > 2000 THEN 0.8E0 WHEN error_rate > 0.05 THEN 0.7E0
       WHEN avg_response_time < 500 AND error_rate < 0.01 THEN 1.1E0 ELSE 1.0E0 END AS next_spawn_rate
FROM order_runs""")
def adaptation_actions(spark, sf):
    """LC10: adaptation rule and next load for every observed run."""
    return LP.adaptation_actions(order_runs(spark, sf)).select("test_id", "action", "next_users", "next_spawn_rate")


@register("best_so_far", views=["order_runs"], rnd=["objective", "best_so_far"], sql=f"""
SELECT test_id, {OBJ_SQL} AS objective,
  min({OBJ_SQL}) OVER (PARTITION BY test_type ORDER BY ts, test_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_so_far
FROM order_runs""")
def best_so_far(spark, sf):
    """Best objective so far per test type, in time order."""
    c = _candidates(spark, sf).withColumn("objective", LP.load_objective())
    out = LP.best_so_far(c.select("test_id", "test_type", "timestamp", "objective"), "objective",
                         ["timestamp", "test_id"], ["test_type"])
    return out.select("test_id", "objective", "best_so_far")


@register("timeseries_folds", views=["order_runs"], sql="""
WITH x AS (SELECT row_number() OVER (ORDER BY ts, test_id) - 1 AS i, count(*) OVER () AS n FROM order_runs),
p AS (SELECT any_value(n) AS n, any_value(n) // 6 AS t FROM x),
f AS (SELECT fold, n - (5 - fold) * t AS e, t FROM p, range(5) r(fold))
SELECT CAST(fold AS INTEGER) AS fold, (SELECT count(*) FROM x WHERE i < e) AS train_rows,
  (SELECT count(*) FROM x WHERE i >= e AND i < e + t) AS test_rows, e AS test_start, e + t - 1 AS test_end FROM f""")
def timeseries_folds(spark, sf):
    """Expanding-window time-series folds (5 splits) over runs in time order."""
    return LP.timeseries_folds(order_runs(spark, sf), ["timestamp", "test_id"])
