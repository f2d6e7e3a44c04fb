"""Evaluation, anomaly and drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import anomaly as AN
from loadlens.operators import drift as DR
from loadlens.operators import evaluate as EV
from loadlens.plans.catalog import register
from loadlens.plans.q_profile import KEY3, NUMERIC
from loadlens.sources.tables import (baseline_runs, class_predictions, current_runs, order_runs,
                                     reg_predictions, table)

AS_OF = "2001-08-01 12:00:00"
REG = ["mae", "rmse", "r2", "mape"]
REG_SQL = """avg(abs(predicted - actual)) AS mae, sqrt(avg((predicted - actual) ^ 2)) AS rmse,
  1 - sum((predicted - actual) ^ 2) / nullif(var_pop(actual) * count(actual), 0) AS r2,
  avg(abs((actual - predicted) / nullif(actual, 0))) * 100 AS mape"""


@register("regression_metrics", views=["reg_predictions"], rnd=REG, sql=f"""
SELECT {REG_SQL} FROM reg_predictions WHERE model = 'a'""")
def regression_metrics(spark, sf):
    """MAE/RMSE/R2/MAPE of model a over every line item."""
    p = reg_predictions(spark, sf).where(F.col("model") == "a")
    return EV.regression_metrics(p)


@register("model_comparison", views=["reg_predictions"], rnd=REG, sql=f"""
SELECT model, {REG_SQL} FROM reg_predictions GROUP BY model""")
def model_comparison(spark, sf):
    """Regression metrics per model of the prediction log."""
    return EV.regression_metrics(reg_predictions(spark, sf), by=["model"])


CLS_SQL = """
cm AS (SELECT actual, predicted, count(*) AS n FROM class_predictions GROUP BY ALL),
cls AS (SELECT actual AS cls FROM cm UNION SELECT predicted FROM cm),
per AS (SELECT cls, coalesce((SELECT sum(n) FROM cm WHERE actual = cls), 0) AS support,
               coalesce((SELECT sum(n) FROM cm WHERE predicted = cls), 0) AS pred_n,
               coalesce((SELECT sum(n) FROM cm WHERE actual = cls AND predicted = cls), 0) AS tp FROM cls),
rep AS (SELECT cls, CAST(support AS BIGINT) AS support, coalesce(tp / nullif(pred_n, 0), 0) AS "precision",
               coalesce(tp / nullif(support, 0), 0) AS recall FROM per),
rep2 AS (SELECT *, coalesce(2 * "precision" * recall / nullif("precision" + recall, 0), 0) AS f1 FROM rep)"""


@register("class_report", views=["class_predictions"], rnd=["precision", "recall", "f1"], sql=f"""
WITH {CLS_SQL}
SELECT cls, "precision", recall, f1, support FROM rep2""")
def class_report(spark, sf):
    """Per-class precision/recall/F1/support (labels: quality vs toxic)."""
    return EV.class_report(class_predictions(spark, sf))


@register("classification_metrics", views=["class_predictions"], rnd=["accuracy", "precision", "recall", "f1"], sql=f"""
WITH {CLS_SQL}
SELECT (SELECT avg(CAST(actual = predicted AS DOUBLE)) FROM class_predictions) AS accuracy,
  sum("precision" * support) / sum(support) AS "precision", sum(recall * support) / sum(support) AS recall,
  sum(f1 * support) / sum(support) AS f1 FROM rep2""")
def classification_metrics(spark, sf):
    """Accuracy and weighted precision/recall/F1."""
    return EV.classification_metrics(class_predictions(spark, sf))


@register("model_perf_drift", views=["reg_predictions"], rnd=["baseline", "current", "drift", "average_drift"], sql="""
WITH m AS (
  SELECT l_shipdate >= TIMESTAMP '1998-01-01' AS is_cur, avg(abs(predicted - actual)) AS mae,
    sqrt(avg((predicted - actual) ^ 2)) AS rmse,
    1 - sum((predicted - actual) ^ 2) / nullif(var_pop(actual) * count(actual), 0) AS r2
  FROM reg_predictions WHERE model = 'a' GROUP BY 1),
l AS (UNPIVOT m ON mae, rmse, r2 INTO NAME metric VALUE v),
j AS (SELECT b.metric, b.v AS baseline, c.v AS current FROM l b JOIN l c ON b.metric = c.metric AND NOT b.is_cur AND c.is_cur),
d AS (SELECT *, CASE WHEN baseline <> 0 THEN abs(current - baseline) / abs(baseline) ELSE abs(current - baseline) END AS drift,
        coalesce(CASE WHEN metric IN ('accuracy', 'precision', 'recall', 'f1', 'r2') THEN current > baseline
                      ELSE current < baseline END, false) AS improved FROM j)
SELECT *, avg(drift) OVER () AS average_drift, count(*) FILTER (WHERE improved) OVER () AS improved_metrics,
  count(*) OVER () AS total_metrics, avg(drift) OVER () > 0.2 AS significant_drift,
  count(*) FILTER (WHERE improved) OVER () < count(*) OVER () / 2 AS model_degraded FROM d""")
def model_perf_drift(spark, sf):
    """E5: model a's metrics before 1998 vs from 1998 on."""
    p = reg_predictions(spark, sf).where(F.col("model") == "a")
    cut = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")
    base = EV.regression_metrics(p.where(~cut))
    cur = EV.regression_metrics(p.where(cut))
    return EV.metric_drift(base, cur, ["mae", "rmse", "r2"])


def _unpivot3(src="order_runs"):
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in KEY3)
    return (f"(UNPIVOT (SELECT test_id, ts, {sel} FROM {src}) ON {', '.join(KEY3)} "
            f"INTO NAME \"column\" VALUE value)")


TH_SQL = f"""
u AS (SELECT * FROM {_unpivot3()} WHERE value IS NOT NULL),
th AS (SELECT "column" AS c, avg(value) AS mean, stddev_pop(value) AS sd,
        avg(value) + 3 * stddev_pop(value) AS z3,
        quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS up,
        quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS low
       FROM u GROUP BY 1),
med AS (SELECT "column" AS c, quantile_cont(value, 0.5) AS m FROM u GROUP BY 1),
mad AS (SELECT u."column" AS c, 1.4826 * coalesce(nullif(quantile_cont(abs(value - m), 0.5), 0), 1) AS s
        FROM u JOIN med ON u."column" = med.c GROUP BY 1),
dist AS (SELECT u.*, abs(value - m) / s AS d FROM u JOIN med ON u."column" = med.c JOIN mad ON u."column" = mad.c),
cut AS (SELECT "column" AS c, quantile_cont(d, 0.9) AS q FROM dist GROUP BY 1),
sc AS (SELECT dist.*, d > q AS robust_outlier, value > z3 AS threshold_exceeded,
         value > z3 OR value < low AS statistical,
         (CAST(NOT (d > q) AS INTEGER) + CAST(value >= low AND value <= up AS INTEGER)
          + CAST(coalesce(abs(value - mean) <= 3 * sd, true) AS INTEGER)) / 3.0 AS model_consensus
       FROM dist JOIN cut ON dist."column" = cut.c JOIN th ON dist."column" = th.c),
sc2 AS (SELECT *, model_consensus < 0.5 OR statistical AS is_anomaly FROM sc)"""


@register("stat_anomalies", views=["order_runs"], rnd=["value"], sql=f"""
WITH {TH_SQL}
SELECT test_id, "column", value, threshold_exceeded FROM sc2 WHERE statistical""")
def stat_anomalies(spark, sf):
    """AN1: values above mean+3sd or below Q1-1.5IQR."""
    r = order_runs(spark, sf)
    th = AN.thresholds(r, KEY3)
    s = AN.statistical_flags(AN.metric_values(r, KEY3), th)
    return s.where("statistical").select("test_id", "column", "value", "threshold_exceeded")


@register("robust_distance", views=["order_runs"], rnd=["value", "distance"], sql=f"""
WITH {TH_SQL}
SELECT test_id, "column", value, d AS distance, robust_outlier FROM sc2""")
def robust_distance(spark, sf):
    """AN2c: 1-D robust envelope distance and outlier flag (contamination 0.1)."""
    r = order_runs(spark, sf)
    fit = AN.fit_robust(r, KEY3)
    return AN.robust_distance(AN.metric_values(r, KEY3), fit).select(
        "test_id", "column", "value", "distance", "robust_outlier")


@register("anomaly_vote", views=["order_runs"], rnd=["value", "model_consensus"], sql=f"""
WITH {TH_SQL}
SELECT test_id, "column", value, threshold_exceeded, model_consensus FROM sc2 WHERE is_anomaly""")
def anomaly_vote(spark, sf):
    """AN3 + AN4: ensemble vote OR statistical rule; the anomaly log records."""
    scored = AN.detect(order_runs(spark, sf), KEY3)
    return AN.anomaly_log(scored)


@register("anomaly_ensemble")
def anomaly_ensemble(spark, sf):
    """AN2 + AN3: forest, LOF and envelope vote on every run's key metrics."""
    scored = AN.ensemble(order_runs(spark, sf), KEY3)
    return scored.select("test_id", "column", "value", "v_forest", "v_lof", "v_envelope", "model_consensus",
                         "threshold_exceeded", "is_anomaly")


@register("anomaly_summary", views=["order_runs"], rnd=["average_model_consensus"], sql=f"""
WITH {TH_SQL},
per AS (SELECT "column", count(*) AS anomalies,
          count(*) FILTER (WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR) AS r,
          count(*) FILTER (WHERE threshold_exceeded) AS v, sum(model_consensus) AS c FROM sc2 WHERE is_anomaly GROUP BY 1)
SELECT "column", anomalies, CAST(sum(anomalies) OVER () AS BIGINT) AS total_anomalies,
  CAST(sum(r) OVER () AS BIGINT) AS recent_anomalies, CAST(sum(v) OVER () AS BIGINT) AS threshold_violations, sum(c) OVER () / sum(anomalies) OVER () AS average_model_consensus FROM per""")
def anomaly_summary(spark, sf):
    """Anomaly log summary (per column, totals, last 24 h before as-of)."""
    r = order_runs(spark, sf)
    scored = AN.detect(r.select("test_id", "timestamp", *KEY3), KEY3, carry=["timestamp"])
    log = AN.anomaly_log(scored, time_col="timestamp")
    return AN.anomaly_summary(log, as_of=AS_OF)


@register("anomaly_alerts", views=["order_runs"], rnd=["anomaly_rate"], sql=f"""
WITH {TH_SQL},
rt AS (SELECT "column", count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
         count(*) FILTER (WHERE is_anomaly) / count(*) AS anomaly_rate FROM sc2 GROUP BY 1)
SELECT "column", anomaly_rate, anomaly_count, CASE WHEN anomaly_rate > 0.2 THEN 'high' ELSE 'medium' END AS severity,
  'Review recent system changes|Check for infrastructure issues|Consider model retraining|Monitor system resources' AS recommendations
FROM rt WHERE anomaly_rate > 0.1""")
def anomaly_alerts(spark, sf):
    """AN5: alerts for columns whose anomaly rate exceeds 10 %."""
    scored = AN.detect(order_runs(spark, sf), KEY3)
    al = AN.anomaly_alerts(AN.anomaly_rates(scored))
    return al.select("column", "anomaly_rate", "anomaly_count", "severity",
                     F.array_join("recommendations", "|").alias("recommendations"))


PRED_SQL = """
pred AS (SELECT concat('test_', CAST(l_orderkey AS VARCHAR)) AS test_id, 'avg_response_time' AS metric,
           avg(2100 * l_quantity) / 50 AS predicted FROM lineitem GROUP BY l_orderkey
         UNION ALL
         SELECT concat('test_', CAST(l_orderkey AS VARCHAR)), 'error_rate', 0.02E0 FROM lineitem GROUP BY l_orderkey),
act AS (UNPIVOT (SELECT test_id, avg_response_time, error_rate FROM order_runs) ON avg_response_time, error_rate
        INTO NAME metric VALUE actual)"""


@register("prediction_deviation", views=["order_runs"], rnd=["average_deviation"], sql=f"""
WITH {PRED_SQL},
dev AS (SELECT p.test_id, p.metric, CASE WHEN actual <> 0 THEN abs(predicted - actual) / actual
               ELSE abs(predicted - actual) END AS deviation FROM pred p JOIN act a ON p.test_id = a.test_id AND p.metric = a.metric)
SELECT test_id, avg(deviation) AS average_deviation, count(*) FILTER (WHERE deviation > 0.2) AS anomaly_count,
  avg(deviation) > 0.2 OR count(*) FILTER (WHERE deviation > 0.2) > 0 AS is_significant_drift
FROM dev GROUP BY test_id""")
def prediction_deviation(spark, sf):
    """DR1 + J5: predicted vs actual run metrics, per-run assessment."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    tid = F.concat(F.lit("test_"), F.col("l_orderkey").cast("string"))
    lat = li.groupBy("l_orderkey").agg((F.avg(2100 * F.col("l_quantity")) / 50).alias("p"))
    pred = lat.select(tid.alias("test_id"), F.explode(F.array(
        F.struct(F.lit("avg_response_time").alias("metric"), F.col("p").alias("predicted")),
        F.struct(F.lit("error_rate").alias("metric"), F.lit(0.02).alias("predicted")))).alias("s")).select(
        "test_id", "s.metric", "s.predicted")
    act = order_runs(spark, sf).select("test_id", "avg_response_time", "error_rate").unpivot(
        ["test_id"], ["avg_response_time", "error_rate"], "metric", "actual")
    return DR.deviation_assessment(DR.prediction_deviation(pred, act))


@register("drift_mean_shift", views=["baseline_runs", "current_runs"], rnd=["recent_mean", "baseline_mean", "drift", "average_drift"], sql=f"""
WITH r AS (UNPIVOT (SELECT {', '.join(f'avg({c}) AS {c}' for c in NUMERIC)} FROM current_runs) ON {', '.join(NUMERIC)} INTO NAME "column" VALUE recent_mean),
b AS (UNPIVOT (SELECT {', '.join(f'avg({c}) AS {c}' for c in NUMERIC)} FROM baseline_runs) ON {', '.join(NUMERIC)} INTO NAME "column" VALUE baseline_mean),
j AS (SELECT r."column", recent_mean, baseline_mean,
        CASE WHEN baseline_mean <> 0 THEN abs(recent_mean - baseline_mean) / abs(baseline_mean)
             ELSE abs(recent_mean - baseline_mean) END AS drift FROM r JOIN b ON r."column" = b."column")
SELECT *, drift > 0.3 AS is_drifted, avg(drift) OVER () AS average_drift,
  count(*) FILTER (WHERE drift > 0.3) OVER () AS drifted_features, count(*) OVER () AS total_features,
  count(*) FILTER (WHERE drift > 0.3) OVER () > count(*) OVER () * 0.3 OR avg(drift) OVER () > 0.3 AS model_needs_retraining
FROM j""")
def drift_mean_shift(spark, sf):
    """DR2: mean shift of every numeric column, current vs baseline runs."""
    return DR.mean_shift(current_runs(spark, sf), baseline_runs(spark, sf))


def _profile_sql(src, by=""):
    sel = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)
    g = f"{by}, " if by else ""
    return f"""(SELECT {g}"column", avg(value) AS mean, stddev_samp(value) AS std, quantile_cont(value, 0.25) AS q25,
  quantile_cont(value, 0.75) AS q75 FROM (UNPIVOT (SELECT {g}{sel} FROM {src}) ON {', '.join(NUMERIC)}
  INTO NAME "column" VALUE value) GROUP BY ALL)"""


def _drift_sql(by=""):
    g = f"c.{by}, " if by else ""
    on = f" AND c.{by} = b.{by}" if by else ""
    part = f"PARTITION BY {by}" if by else ""
    shift = " + ".join(f"abs(c.{m} - b.{m}) / (abs(b.{m}) + 1e-8)" for m in ("mean", "std", "q25", "q75"))
    return f"""
WITH c AS {_profile_sql('current_runs', by)}, b AS {_profile_sql('baseline_runs', by)},
j AS (SELECT {g}c."column", ({shift}) / 4.0 AS drift_score FROM c JOIN b ON c."column" = b."column"{on}),
k AS (SELECT *, drift_score > 0.3 AS is_drifted, count(*) OVER ({part}) AS total_features,
        count(*) FILTER (WHERE drift_score > 0.3) OVER ({part}) AS drifted_count,
        avg(drift_score) OVER ({part}) AS average_drift FROM j)
SELECT *, drifted_count / total_features AS drift_rate,
  drifted_count > total_features * 0.3 OR average_drift > 0.3 AS significant_drift FROM k"""


@register("drift_data", views=["baseline_runs", "current_runs"], rnd=["drift_score", "average_drift", "drift_rate"], sql=_drift_sql())
def drift_data(spark, sf):
    """DR3 + DR4: profile drift (mean, std, q25, q75) of current vs baseline runs."""
    base = DR.profile_long(baseline_runs(spark, sf), NUMERIC)
    d = DR.data_drift(current_runs(spark, sf).select(*NUMERIC), base)
    return d.select("column", "drift_score", "is_drifted", "total_features", "drifted_count", "average_drift",
                    "drift_rate", "significant_drift")


def _grouped_drift(spark, sf):
    base = DR.profile_long(baseline_runs(spark, sf).select("test_type", *NUMERIC), NUMERIC, by=["test_type"])
    return DR.data_drift(current_runs(spark, sf).select("test_type", *NUMERIC), base, by=["test_type"])


@register("drift_summary", views=["baseline_runs", "current_runs"], rnd=["average_drift_rate"], sql=f"""
WITH d AS ({_drift_sql('test_type')}),
log AS (SELECT test_type, any_value(drift_rate) AS drift_rate, any_value(significant_drift) AS significant_drift,
          (SELECT max(ts) FROM current_runs c WHERE c.test_type = d.test_type) AS checked_at FROM d GROUP BY test_type)
SELECT count(*) AS total_drift_checks, count(*) FILTER (WHERE significant_drift) AS significant_drift_events,
  count(*) FILTER (WHERE checked_at > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY) AS recent_drift_checks,
  avg(drift_rate) AS average_drift_rate, string_agg('baseline_' || test_type, ',' ORDER BY test_type) AS baselines_used FROM log""")
def drift_summary(spark, sf):
    """Drift log (one check per test type, when its last run came in) summarised."""
    last = current_runs(spark, sf).groupBy("test_type").agg(F.max("timestamp").alias("last_run"))
    log = DR.drift_checks(_grouped_drift(spark, sf), ["test_type"], F.concat(F.lit("baseline_"), F.col("test_type")), AS_OF)
    log = log.join(last, "test_type", "left").withColumn("checked_at", F.col("last_run"))
    return DR.drift_summary(log, AS_OF)


@register("retrain_decision", views=["baseline_runs", "current_runs"], rnd=["drift_rate"], sql=f"""
WITH d AS ({_drift_sql('test_type')}),
g AS (SELECT test_type, any_value(drift_rate) AS drift_rate, any_value(significant_drift) AS significant_drift
      FROM d GROUP BY test_type),
m AS (SELECT g.*, (SELECT count(*) FROM current_runs c WHERE c.test_type = g.test_type) AS new_rows,
        (SELECT max(ts) FROM baseline_runs b WHERE b.test_type = g.test_type) AS last_retrained FROM g),
x AS (SELECT *, new_rows >= 100 AS sufficient_data,
        coalesce(TIMESTAMP '{AS_OF}' - last_retrained > INTERVAL 30 DAY, false) AS old FROM m)
SELECT test_type AS model, significant_drift OR drift_rate > 0.5 OR old AS should_retrain,
  coalesce(nullif(concat_ws(' | ',
    CASE WHEN significant_drift THEN 'Significant data drift detected' END,
    CASE WHEN drift_rate > 0.5 THEN 'High drift rate (>50%)' END,
    CASE WHEN NOT sufficient_data THEN 'Insufficient new data' END,
    CASE WHEN old THEN 'More than 30 days since last retraining' END), ''), 'No retraining criteria met') AS reasons,
  significant_drift, drift_rate, sufficient_data,
  CAST(date_diff('day', CAST(last_retrained AS DATE), CAST(TIMESTAMP '{AS_OF}' AS DATE)) AS INTEGER) AS days_since_retraining
FROM x""")
def retrain_decision(spark, sf):
    """DR6: per model (one per test type) retraining decision and reasons."""
    d = _grouped_drift(spark, sf)
    g = d.groupBy("test_type").agg(F.first("drift_rate").alias("drift_rate"),
                                   F.first("significant_drift").alias("significant_drift"))
    n = current_runs(spark, sf).groupBy("test_type").agg(F.count("*").alias("new_rows"))
    last = baseline_runs(spark, sf).groupBy("test_type").agg(F.max("timestamp").alias("last_retrained"))
    models = g.join(n, "test_type", "left").join(last, "test_type", "left").withColumnRenamed("test_type", "model")
    models = models.withColumn("new_rows", F.coalesce("new_rows", F.lit(0)))
    dec = DR.retrain_decisions(models, AS_OF)
    return dec.select("model", "should_retrain", F.array_join("reasons", " | ").alias("reasons"),
                      "significant_drift", "drift_rate", "sufficient_data", "days_since_retraining")


@register("retrain_trigger", views=["baseline_runs", "current_runs"], sql=f"""
WITH r AS (SELECT {', '.join(f'avg({c}) AS {c}' for c in NUMERIC)} FROM current_runs),
b AS (SELECT {', '.join(f'avg({c}) AS {c}' for c in NUMERIC)} FROM baseline_runs),
d AS (SELECT {', '.join(f"CASE WHEN b.{c} <> 0 THEN abs(r.{c} - b.{c}) / abs(b.{c}) ELSE abs(r.{c} - b.{c}) END AS {c}" for c in NUMERIC)} FROM r, b),
u AS (UNPIVOT d ON {', '.join(NUMERIC)} INTO NAME "column" VALUE drift),
flag AS (SELECT count(*) FILTER (WHERE drift > 0.3) > count(*) * 0.3 OR avg(drift) > 0.3 AS f FROM u),
th AS (SELECT avg(avg_response_time) + 3 * stddev_pop(avg_response_time) AS z3,
         quantile_cont(avg_response_time, 0.25) - 1.5 * (quantile_cont(avg_response_time, 0.75)
           - quantile_cont(avg_response_time, 0.25)) AS low FROM current_runs),
an AS (SELECT count(*) AS n FROM current_runs, th
       WHERE (avg_response_time > z3 OR avg_response_time < low) AND ts > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR),
t AS (SELECT (SELECT f FROM flag) AS model_drift_detected, (SELECT count(*) FROM current_runs) >= 100 AS sufficient_new_data,
  TIMESTAMP '{AS_OF}' - (SELECT max(ts) FROM baseline_runs) > INTERVAL 7 DAY AS significant_time_passed,
  (SELECT n FROM an) > 10 AS high_anomaly_rate)
SELECT *, model_drift_detected OR sufficient_new_data OR significant_time_passed OR high_anomaly_rate AS should_retrain FROM t""")
def retrain_trigger(spark, sf):
    """DR5: retraining trigger from drift, data volume, time and recent anomalies."""
    cur, base = current_runs(spark, sf), baseline_runs(spark, sf)
    flag = DR.mean_shift(cur, base, columns=NUMERIC).select("model_needs_retraining").first()[0]
    th = AN.thresholds(cur, ["avg_response_time"])
    s = AN.statistical_flags(AN.metric_values(cur, ["avg_response_time"], carry=["timestamp"]), th)
    last = base.agg(F.max("timestamp").cast("string")).first()[0]
    return DR.retrain_trigger(cur, bool(flag), s.where("statistical"), AS_OF, last_update=last)


@register("class_balance", views=["order_runs"], sql="""
SELECT CAST(coalesce(avg_response_time < 1000, false) AS INTEGER) AS performance_target, count(*) AS runs
FROM order_runs WHERE avg_response_time IS NOT NULL GROUP BY 1""")
def class_balance(spark, sf):
    """Class balance of the classification target (rows with a target)."""
    from loadlens.operators import targets as TG
    from loadlens.operators.filters import require_target
    t = require_target(TG.create_targets(order_runs(spark, sf), wanted=["performance_target"]), "avg_response_time")
    return t.groupBy("performance_target").agg(F.count("*").alias("runs"))
