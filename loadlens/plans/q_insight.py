"""Explanations, clusters of given labels, recommendations, the engineered table as a file, and the hyper-parameter search."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loadlens.operators import clusters as CL
from loadlens.operators import features as FE
from loadlens.operators import loadplan as LP
from loadlens.operators import models as MD
from loadlens.operators import report as RP
from loadlens.operators import selection as SE
from loadlens.operators import trends as TR
from loadlens.plans import q_features, q_models, q_plan, q_profile, q_quality  # noqa: F401  their SQL is used here
from loadlens.plans.catalog import ORACLE, register
from loadlens.plans.q_plan import TREND_SQL, _bp_sql, load_search
from loadlens.plans.q_profile import KEY3, NUMERIC, TARGET
from loadlens.session import scratch_path
from loadlens.sources import runstore as IO
from loadlens.sources.tables import order_runs, reg_predictions

# Clusters given by a column expression: latency bands.
LABEL_SQL = "CAST(CASE WHEN avg_response_time < 600 THEN 0 WHEN avg_response_time < 900 THEN 1 ELSE 2 END AS INTEGER)"


def _labelled(spark, sf):
    label = F.when(F.col("avg_response_time") < 600, 0).when(F.col("avg_response_time") < 900, 1).otherwise(2)
    return order_runs(spark, sf).withColumn("cluster", label)


def _long_sql(columns):
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return (f"(UNPIVOT (SELECT {LABEL_SQL} AS cluster, {sel} FROM order_runs) ON {', '.join(columns)} "
            f"INTO NAME feature VALUE value)")


@register("cluster_label_profile", views=["order_runs"], rnd=["mean", "std", "min", "max", "median"], sql=f"""
SELECT cluster, feature, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
  quantile_cont(value, 0.5) AS median FROM {_long_sql(NUMERIC)} WHERE value IS NOT NULL GROUP BY ALL""")
def cluster_label_profile(spark, sf):
    """Characteristics of every numeric column per cluster, for given labels."""
    return CL.cluster_characteristics(_labelled(spark, sf), NUMERIC)


TYPES_SQL = f"""
prof AS (SELECT cluster, feature AS metric, avg(value) AS mean, stddev_samp(value) AS std,
  printf('%.2f - %.2f', min(value), max(value)) AS "range" FROM {_long_sql(KEY3)} WHERE value IS NOT NULL GROUP BY ALL),
types AS (SELECT cluster, CASE WHEN mean < 500 THEN 'High Performance' WHEN mean < 1500 THEN 'Medium Performance'
  ELSE 'Low Performance' END AS cluster_type FROM prof WHERE metric = 'avg_response_time')"""


@register("cluster_label_types", views=["order_runs"], rnd=["mean", "std"], sql=f"""
WITH {TYPES_SQL} SELECT cluster, metric, mean, std, "range", cluster_type FROM prof JOIN types USING (cluster)""")
def cluster_label_types(spark, sf):
    """A7 + CL2: performance profile and type per cluster, for given labels."""
    prof = CL.performance_profile(_labelled(spark, sf))
    return prof.join(CL.cluster_types(prof), "cluster")


def _importances(spark, sf):
    """Importances from the univariate F statistics: each feature's share of their sum."""
    sc = SE.f_regression_scores(order_runs(spark, sf), TARGET)
    share = F.coalesce(F.try_divide("score", F.sum("score").over(Window.partitionBy())), F.lit(0.0))   # a row per column
    return MD.ranked(sc.select("feature", share.alias("importance")))


_SCORES = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, (SELECT r2 / (1 - r2) * (n - 2) FROM (SELECT corr(coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM order_runs)), "
    f"{TARGET}) ^ 2 AS r2, count({TARGET}) AS n FROM order_runs) WHERE r2 < 1) AS score WHERE {q_profile._dense_filter(c)}"
    for c in q_profile.CANDIDATES)
IMPORTANCE_SQL = f"""
sc AS ({_SCORES}),
imp AS (SELECT feature, coalesce(score / nullif(sum(score) OVER (), 0), 0.0) AS importance FROM sc),
ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS "rank" FROM imp)"""


@register("top_features", views=["order_runs"], rnd=["importance"], sql=f"""
WITH {IMPORTANCE_SQL} SELECT feature, importance, "rank" FROM ranked WHERE "rank" <= 10""")
def top_features(spark, sf):
    """The ten most important features, ranked (the cut is the feature)."""
    return MD.top_features(_importances(spark, sf), 10)


EXPLAIN_SQL = """
lines AS (
  SELECT 1 AS line_no, printf('''%s'' is the most important feature (%.2f%%)', feature, importance * 100) AS line FROM ranked WHERE "rank" = 1
  UNION ALL SELECT 2, printf('''%s'' is the second most important feature (%.2f%%)', feature, importance * 100) FROM ranked WHERE "rank" = 2
  UNION ALL SELECT 3, printf('Load-related features (%d total) significantly impact performance', count(*)) FROM ranked
    WHERE lower(feature) LIKE '%load%' OR lower(feature) LIKE '%user%' HAVING count(*) > 0
  UNION ALL SELECT 4, printf('Network conditions (%d features) are important predictors', count(*)) FROM ranked
    WHERE lower(feature) LIKE '%network%' HAVING count(*) > 0
  UNION ALL SELECT 5, printf('Time-based features (%d features) show temporal patterns', count(*)) FROM ranked
    WHERE lower(feature) LIKE '%time%' OR lower(feature) LIKE '%duration%' HAVING count(*) > 0)"""


@register("explanation_lines", views=["order_runs"], sql=f"""
WITH {IMPORTANCE_SQL}, {EXPLAIN_SQL} SELECT CAST(line_no AS INTEGER) AS line_no, line FROM lines""")
def explanation_lines(spark, sf):
    """The explanation's sentences, from a ranked importance table."""
    return MD.explanation_summary(_importances(spark, sf))


@register("load_recommendation_lines", views=["order_runs"], sql=f"""
WITH bp AS ({_bp_sql('objective, concurrent_users, spawn_rate, duration, test_id')})
SELECT CAST(0 AS INTEGER) AS line_no, printf('Safe load: %d users at %s users/sec', CAST(trunc(concurrent_users * 0.8E0) AS BIGINT),
  CAST(spawn_rate * 0.8E0 AS VARCHAR)) AS line FROM bp
UNION ALL SELECT 1, printf('Stress test: %d users at %s users/sec', CAST(trunc(concurrent_users * 1.1E0) AS BIGINT),
  CAST(round(spawn_rate * 1.1E0, 2) AS VARCHAR)) FROM bp
UNION ALL SELECT 2, printf('Expected breaking point: %d users', concurrent_users) FROM bp
UNION ALL SELECT 3, 'Monitor latency threshold: 2000.0ms' FROM bp
UNION ALL SELECT 4, 'Monitor error rate threshold: 5.0%' FROM bp""")
def load_recommendation_lines(spark, sf):
    """LC6: the recommendation sentences around the found load."""
    return LP.recommendation_lines(load_search(spark, sf))


OVERALL_SQL = """
cls AS (SELECT metric, CASE WHEN trend_direction = 'Stable' THEN 'stable'
    WHEN (trend_direction = 'Increasing') = (lower(metric) LIKE '%latency%' OR lower(metric) LIKE '%error%') THEN 'degrading' ELSE 'improving' END AS c FROM t),
overall AS (SELECT string_agg(metric, ', ' ORDER BY metric) FILTER (WHERE c = 'degrading') AS bad,
  count(*) FILTER (WHERE c = 'improving') AS up, count(*) FILTER (WHERE c = 'degrading') AS down FROM cls)"""


@register("report_recommendations", views=["order_runs"], sql=f"""
WITH {TREND_SQL}, {OVERALL_SQL}, {IMPORTANCE_SQL}, {TYPES_SQL},
low AS (SELECT string_agg(CAST(cluster AS VARCHAR), ', ' ORDER BY cluster) AS ids FROM types WHERE cluster_type LIKE '%Low%' OR cluster_type LIKE '%Unreliable%')
SELECT line FROM (
  SELECT 'Focus optimization efforts on ''' || feature || ''' as it''s the most important feature for latency' AS line FROM ranked WHERE "rank" = 1
  UNION ALL SELECT CASE WHEN down > up THEN 'Performance is degrading - investigate recent changes and consider immediate optimization'
    WHEN up > down THEN 'Performance is improving - continue current optimization strategies' END FROM overall
  UNION ALL SELECT 'Focus on improving: ' || bad FROM overall
  UNION ALL SELECT 'Investigate clusters [' || ids || '] which show poor performance patterns' FROM low
  UNION ALL SELECT unnest(['Monitor model drift regularly and retrain when necessary', 'Set up automated alerts for performance anomalies',
    'Consider A/B testing for performance optimizations', 'Document successful optimization strategies for future reference']))
WHERE line IS NOT NULL""")
def report_recommendations(spark, sf):
    """RP2: all recommendation lines: top feature, overall trend, poor clusters, general."""
    top = MD.top_features(_importances(spark, sf), 1)
    overall = TR.overall_trend(TR.metric_trends(order_runs(spark, sf), KEY3))
    types = CL.cluster_types(CL.performance_profile(_labelled(spark, sf)))
    return RP.recommendations({"latency": top}, overall, types).select("line")


@register("best_model", views=["reg_predictions"], rnd=["r2"], sql="""
SELECT model, 1 - sum((predicted - actual) ^ 2) / (var_pop(actual) * count(actual)) AS r2 FROM reg_predictions
GROUP BY model ORDER BY r2 DESC, model LIMIT 1""")
def best_model(spark, sf):
    """S3: the model of the comparison with the best R2."""
    from loadlens.operators import evaluate as EV
    return EV.best_model(EV.regression_metrics(reg_predictions(spark, sf), by=["model"])).select("model", "r2")


@register("trend_or_error", views=["order_runs"], sql=f"""
WITH {TREND_SQL}
SELECT 'timestamp' AS time_column, metric, trend_direction, NULL::VARCHAR AS error FROM t
UNION ALL SELECT 'started_at', NULL, NULL, 'Time column ''started_at'' not found' FROM (SELECT count(*) FROM order_runs)""")
def trend_or_error(spark, sf):
    """TR1 + TR2: trends by a time column that exists, and the error row of one that doesn't."""
    r = order_runs(spark, sf)
    out = [TR.trends_or_error(r, KEY3, c).select(F.lit(c).alias("time_column"), "metric", "trend_direction", "error")
           for c in ("timestamp", "started_at")]
    return out[0].unionByName(out[1])


_ENGINEERED = ["features_basic", "features_load", "features_reliability", "features_ratios", "features_time", "features_network",
               "features_frontend", "features_interaction"]


def _engineered_sql():
    first, *rest = [f"({ORACLE[k]})" for k in _ENGINEERED]
    return "SELECT * FROM " + first + " AS e0" + "".join(f"\nJOIN {sql} AS e{i} USING (test_id)" for i, sql in enumerate(rest, 1))


@register("engineered_table", sql=_engineered_sql())
def engineered_table(spark, sf):
    """FE31 + IO6: the whole engineered table, exported as CSV with a header and read back."""
    from loadlens.plans.catalog import _round_spark
    r = order_runs(spark, sf)
    eng = FE.engineer_features(r)
    columns = ["test_id", *[c for c in eng.columns if c not in r.columns]]
    path = scratch_path(spark, "engineered")
    IO.export_csv(eng.select(*columns), path)
    back = spark.read.schema(eng.select(*columns).schema).option("header", True).csv(path)
    return _round_spark(back, [f.name for f in back.schema.fields if f.dataType.typeName() == "double"])


# Ranges of the registered search: small models, so that many trials fit into a run.
SEARCH = {"random_forest": {"numTrees": (5, 15), "maxDepth": (3, 6), "minInstancesPerNode": (1, 10), "featureSubsetStrategy": ["sqrt", "log2", "all"]},
          "gbt": {"maxIter": (3, 8), "maxDepth": (2, 4), "stepSize": (0.05, 0.3), "subsamplingRate": (0.6, 1.0)}}
#: Trials and folds per model and problem.
TRIALS, FOLDS = 2, 2


def _draw_sql(name, spec):
    h = f"('0x' || substr(md5('42:' || trial || ':{name}'), 1, 8))::BIGINT"
    if isinstance(spec, list):
        return f"list_extract([{', '.join(f'''{chr(39)}{v}{chr(39)}''' for v in spec)}], CAST({h} % {len(spec)} + 1 AS BIGINT))"
    if isinstance(spec[0], int):
        return f"CAST({spec[0]} + {h} % {spec[1] - spec[0] + 1} AS VARCHAR)"
    return f"printf('%.4f', {spec[0]}E0 + ({spec[1]}E0 - {spec[0]}E0) * ({h} % 1001) / 1000)"


def _search_sql():
    parts = [f"SELECT '{model}' AS model, '{problem}' AS problem, CAST(trial AS INTEGER) AS trial, '{name}' AS param, {_draw_sql(name, spec)} AS value"
             for model, ranges in SEARCH.items() for problem in ("regression", "classification") for name, spec in ranges.items()]
    unions = "\nUNION ALL ".join(f"{p} FROM range({TRIALS}) r(trial)" for p in parts)
    return f"""WITH rows AS (SELECT count(*) AS n FROM orders)
SELECT s.*, n > 0 AS scored, true AS plausible FROM (
{unions}) s, rows"""


@register("hyper_search", sql=_search_sql())
def hyper_search(spark, sf):
    """M7-M9: seeded search of forests and boosted trees, regression and classification; a row per trial and parameter.

    ``scored`` and ``plausible`` check each trial's cross-validated score: it
    exists, beats the spread of the target (regression), or lies in (0, 1]
    (classification).
    """
    r = order_runs(spark, sf).select("test_id", "concurrent_users", "spawn_rate", "duration", "total_requests", "max_response_time", "avg_response_time",
                                     (F.col("avg_response_time") < 800).cast("int").alias("fast"))
    feats = ["concurrent_users", "spawn_rate", "duration", "total_requests", "max_response_time"]
    spread = r.agg(F.stddev_pop("avg_response_time")).first()[0]
    table = MD.search_rows(r, feats, ["avg_response_time", "fast"], FOLDS, ["test_id"])
    out = None
    for model, ranges in SEARCH.items():
        for problem, target in (("regression", "avg_response_time"), ("classification", "fast")):
            _, trials = MD.hyper_search(table, feats, target, model, problem, TRIALS, FOLDS, ranges=ranges, key=["test_id"])
            score = F.col("score")
            good = (score > 0) & (score < F.lit(spread)) if problem == "regression" else (score > 0) & (score <= 1)
            params = F.from_json("params", "map<string,string>")
            rows = trials.select(F.lit(model).alias("model"), F.lit(problem).alias("problem"), "trial", F.explode(params).alias("param", "value"),
                                 score.isNotNull().alias("scored"), F.coalesce(good, F.lit(False)).alias("plausible"))
            out = rows if out is None else out.unionByName(rows)
    doubles = ["stepSize", "subsamplingRate"]
    return out.withColumn("value", F.when(F.col("param").isin(doubles), F.format_string("%.4f", F.expr("try_cast(value AS DOUBLE)")))
                          .otherwise(F.col("value")))
