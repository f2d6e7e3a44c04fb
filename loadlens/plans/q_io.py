"""Streaming, sink/source round trips, reports and the improvement cycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import drift as DR
from loadlens.operators import features as FE
from loadlens.operators import models as MD
from loadlens.operators import report as RP
from loadlens.operators import runs as RS
from loadlens.operators.ordering import stored
from loadlens.operators.quantiles import quantile_rows
from loadlens.plans.catalog import register
from loadlens.plans.q_profile import NUMERIC
from loadlens.plans.q_runs import AS_OF, _raw_batch
from loadlens.schema import LOAD_STATS_SCHEMA
from loadlens.session import scratch_path
from loadlens.sources import runstore as IO
from loadlens.sources.tables import baseline_runs, current_runs, order_configs, order_runs, request_stats, table
from loadlens.streaming import jobs as ST


@register("stream_rollup", rnd=["avg_response_time", "max_response_time", "min_response_time", "requests_per_sec"], sql="""
SELECT date_trunc('hour', ts) AS window_start, count(*) AS total_requests,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS total_failures,
  avg(value) AS avg_response_time, max(value) AS max_response_time, min(value) AS min_response_time,
  count(*) / 3600.0E0 AS requests_per_sec
FROM events GROUP BY date_trunc('hour', ts)
HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_rollup(spark, sf):
    """ST2: hourly rollup of the event stream (watermark 1 h, availableNow); closed windows."""
    out, ck = scratch_path(spark, "stream_rollup"), scratch_path(spark, "stream_rollup_ck")
    q = ST.run_to_table(ST.hourly_rollup(ST.event_stream(spark, f"{sf}/events.parquet")), out, ck)
    q.awaitTermination()
    return spark.read.parquet(out).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "total_requests", "total_failures",
        "avg_response_time", "max_response_time", "min_response_time", "requests_per_sec")


def _event_thresholds(spark, sf):
    """AN1 thresholds per event type: one grouped aggregate and one grouped exact-quantile fit."""
    ev = table(spark, sf, "events").select("event_type", "value").where(F.col("value").isNotNull())
    mom = ev.groupBy("event_type").agg((F.avg("value") + 3 * F.stddev_pop("value")).alias("z_score_3"))
    q1, q3 = (F.max(F.when(F.col("p") == p, F.col("value"))) for p in (0.25, 0.75))
    low = quantile_rows(ev, ["event_type"], "value", [0.25, 0.75]).groupBy("event_type").agg((q1 - 1.5 * (q3 - q1)).alias("iqr_lower"))
    return mom.join(low, "event_type")


@register("stream_anomalies", rnd=["value"], sql="""
WITH th AS (SELECT event_type AS et, avg(value) + 3 * stddev_pop(value) AS z3,
              quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS low
            FROM events WHERE value IS NOT NULL GROUP BY event_type)
SELECT event_id, event_type, value, value > z3 AS threshold_exceeded
FROM events JOIN th ON event_type = et WHERE value > z3 OR value < low""")
def stream_anomalies(spark, sf):
    """ST3: event stream scored against thresholds fitted on the stored events (AN1)."""
    tab = _event_thresholds(spark, sf)
    out, ck = scratch_path(spark, "stream_anom"), scratch_path(spark, "stream_anom_ck")
    q = ST.run_to_table(ST.live_anomalies(ST.event_stream(spark, f"{sf}/events.parquet"), tab), out, ck)
    q.awaitTermination()
    return spark.read.parquet(out).select("event_id", "event_type", "value", "threshold_exceeded")


@register("stream_alerts", rnd=["anomaly_rate"], sql="""
WITH th AS (SELECT event_type AS et, avg(value) + 3 * stddev_pop(value) AS z3,
              quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS low
            FROM events WHERE value IS NOT NULL GROUP BY event_type),
r AS (SELECT date_trunc('hour', ts) AS window_start, event_type AS "column", count(*) FILTER (WHERE value > z3 OR value < low) AS anomaly_count,
  count(*) AS events FROM events LEFT JOIN th ON event_type = et GROUP BY date_trunc('hour', ts), event_type
  HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR)
SELECT window_start, "column", anomaly_count, anomaly_count / events AS anomaly_rate,
  CASE WHEN anomaly_count / events > 0.2 THEN 'high' ELSE 'medium' END AS severity,
  printf('High anomaly rate detected in %s: %.2f%%', "column", anomaly_count / events * 100) AS message
FROM r WHERE anomaly_count / events > 0.1""")
def stream_alerts(spark, sf):
    """ST3 + AN5: live alerts per hour of event time and event type, thresholds read anew per micro-batch; closed windows."""
    from loadlens.operators import anomaly as ANM
    folder = scratch_path(spark, "stream_alerts")
    _event_thresholds(spark, sf).write.parquet(f"{folder}/thresholds")
    events = ST.event_stream(spark, f"{sf}/events.parquet")
    ST.flag_batches(events, f"{folder}/thresholds", f"{folder}/flagged", f"{folder}/ck1").awaitTermination()
    ST.alert_windows(f"{folder}/flagged", f"{folder}/rates", f"{folder}/ck2", spark).awaitTermination()
    return ANM.anomaly_alerts(spark.read.parquet(f"{folder}/rates"), by=["window_start"]).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "column", "anomaly_count", "anomaly_rate", "severity", "message")


@register("stream_ingest", sql="""
SELECT concat('order_', CAST(o_orderkey AS VARCHAR)) AS test_id, CAST(o_orderdate AS DATE) AS date
FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def stream_ingest(spark, sf):
    """ST1 + IO3: raw run files ingested by a file stream; valid rows land in the run table."""
    raw = scratch_path(spark, "raw_runs")
    _raw_batch(spark, sf).write.json(raw)
    table_dir, rej, ck = (scratch_path(spark, "ingested"), scratch_path(spark, "rejects"),
                          scratch_path(spark, "ingest_ck"))
    q = ST.ingest_runs(spark, raw, _raw_batch(spark, sf).schema, table_dir, rej, ck)
    q.awaitTermination()
    return IO.read_runs(spark, table_dir).select("test_id", "date")


@register("load_stats_csv", views=["request_stats"], rnd=["avg_response_time", "max_response_time", "min_response_time", "requests_per_sec", "error_rate"], sql="""
SELECT test_id, CAST(sum(request_count) AS BIGINT) AS total_requests, CAST(sum(failure_count) AS BIGINT) AS total_failures,
  avg(avg_response_time) AS avg_response_time, max(max_response_time) AS max_response_time,
  min(min_response_time) AS min_response_time, avg(requests_per_sec) AS requests_per_sec,
  CASE WHEN sum(request_count) > 0 THEN sum(failure_count) / sum(request_count) ELSE 0.0 END AS error_rate,
  'success' AS status
FROM request_stats GROUP BY test_id""")
def load_stats_csv(spark, sf):
    """IO8 + A1: statistics CSV files of some 64 KB, many runs each, read back and rolled up."""
    path = scratch_path(spark, "load_stats")
    st = request_stats(spark, sf).select("test_id", *[f.name for f in LOAD_STATS_SCHEMA.fields])
    IO.write_load_stats(st, path, 64 << 10)
    return RS.rollup_request_stats(IO.read_load_stats(spark, path))


@register("runs_csv_export", views=["order_runs"], sql="""
SELECT test_id, test_type, concurrent_users, avg_response_time FROM order_runs WHERE status = 'success'""")
def runs_csv_export(spark, sf):
    """IO5/IO6: filtered runs exported as CSV with header, read back with a schema."""
    path = scratch_path(spark, "runs_csv")
    cols = "test_id string, test_type string, concurrent_users long, avg_response_time double"
    r = RS.filter_runs(order_runs(spark, sf), {"status": "success"})
    IO.export_csv(r.select("test_id", "test_type", "concurrent_users", "avg_response_time"), path)
    return spark.read.schema(cols).option("header", True).csv(path)


@register("config_json_roundtrip", views=["order_runs", "order_configs"], sql="""
SELECT r.test_id, r.test_type, CAST(len(c.api_endpoints) AS INTEGER) AS endpoints, c.payload_size
FROM order_runs r JOIN order_configs c ON r.test_id = c.test_id""")
def config_json_roundtrip(spark, sf):
    """IO7: configuration records saved as JSON and loaded with the enum-domain check."""
    r = order_runs(spark, sf)
    cfg = r.select("test_id", "test_type", "concurrent_users", "spawn_rate", "duration", "network_condition",
                   "browser").join(order_configs(spark, sf), "test_id")
    path = scratch_path(spark, "configs")
    IO.save_configs(cfg, path)
    valid, invalid = IO.load_configs(spark, path)
    return valid.select("test_id", "test_type", F.size("api_endpoints").alias("endpoints"), "payload_size")


@register("run_store_retention", views=["order_runs"], sql=f"""
SELECT CAST(year(ts) AS INTEGER) AS year, count(*) AS runs FROM order_runs
WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1095 DAY GROUP BY 1""")
def run_store_retention(spark, sf):
    """IO2/IO3 + IO11 + F5: store runs by date, snapshot, apply retention, read back."""
    table_dir = scratch_path(spark, "run_store")
    IO.store_runs(order_runs(spark, sf), table_dir)
    IO.snapshot(IO.read_runs(spark, table_dir), table_dir)
    IO.apply_retention(spark, table_dir, 1095, AS_OF)
    return IO.read_runs(spark, table_dir).groupBy(F.year("timestamp").alias("year")).agg(F.count("*").alias("runs"))


@register("run_store_mixed_batches", views=["order_runs"], sql="""
SELECT test_type, count(*) AS runs, CASE WHEN test_type = 'frontend' THEN 0 ELSE count(concurrent_users) END AS with_users,
  CASE WHEN test_type = 'frontend' THEN 0 ELSE count(*) END AS with_note, CAST(0 AS BIGINT) AS replayed
FROM order_runs GROUP BY test_type""")
def run_store_mixed_batches(spark, sf):
    """IO2/IO3: batches with other columns meet in the fixed schema; a replayed batch replaces itself."""
    table_dir = scratch_path(spark, "mixed_batches")
    r = order_runs(spark, sf)
    front, rest = r.where("test_type = 'frontend'").drop("concurrent_users"), r.where("test_type <> 'frontend'")
    for _ in range(2):
        IO.store_runs(front, table_dir, batch="front")
        IO.store_runs(rest.withColumn("note", F.lit("kept in the metadata")), table_dir, batch="rest")
    runs = IO.read_runs(spark, table_dir)
    return runs.groupBy("test_type").agg(
        F.count("*").alias("runs"), F.count("concurrent_users").alias("with_users"),
        F.count(F.get_json_object("metadata", "$.note")).alias("with_note"),
        (F.count("*") - F.count_distinct("test_id")).alias("replayed"))


def _model_insights(spark, sf):
    """X1 of the latency forest (a small one): ranked importances, and the explanation's sentences."""
    from loadlens.plans import q_models as QM
    r = order_runs(spark, sf).select(*[c for c in QM.LOAD_FEATURES if c != "network_condition_encoded"], "total_requests", "avg_response_time")
    feats = [c for c in r.columns if c != "avg_response_time"]
    r = MD.assembled(r, feats, "avg_response_time")
    model, metrics = MD.train_regression(r, r, feats, "avg_response_time", MD.RandomForestRegressor(numTrees=10, maxDepth=4, seed=MD.SEED))
    imp = MD.ranked(MD.feature_importances(model, feats).select("feature", "importance"))
    return MD.top_features(imp, 10), MD.explanation_summary(imp), metrics.where("split = 'test'").drop("split")


def _report_parts(spark, sf, insights=None):
    """Every part of the comprehensive report (RP1): data, models, trends, clusters, recommendations."""
    from loadlens.operators import clusters as CL
    from loadlens.operators import profile as PR
    from loadlens.operators import trends as TR
    r = order_runs(spark, sf)
    tr = stored(TR.metric_trends(r), "report-trends")
    overall = TR.overall_trend(tr)
    lab, _, feats = CL.cluster_runs(r, k=3)
    lab = stored(lab, "report-clusters")
    prof = stored(CL.performance_profile(lab), "report-profiles")
    types = CL.cluster_types(prof)
    top, lines, _ = insights or _model_insights(spark, sf)
    return {
        "data_summary": PR.data_summary(r),
        "missing_data": FE.feature_summary(r).select("column", "missing_values"),
        "model_insights": top.withColumn("model_name", F.lit("latency")),
        "explanation_summary": lines,
        "trends": tr.withColumns({"start": F.col("start").cast("string"), "end": F.col("end").cast("string")}),
        "overall_trends": overall,
        "clusters": CL.cluster_sizes(lab).join(types, "cluster"),
        "cluster_characteristics": CL.cluster_characteristics(lab, feats),
        "cluster_profiles": prof,
        "recommendations": RP.recommendations({"latency": top}, overall, types)}


@register("report_json", views=["order_runs"], sql="""
SELECT 'Load test report' AS title, 3 AS metrics_summarised, CAST(19 + 1 AS INTEGER) AS columns_counted,
  (SELECT count(*) FROM (UNPIVOT (SELECT count(avg_response_time) AS a, count(requests_per_sec) AS b, count(error_rate) AS c FROM order_runs)
     ON a, b, c INTO NAME m VALUE n) WHERE n > 10) AS trends, true AS has_clusters, true AS has_explanation, true AS ends_with_general_lines,
  (SELECT count(*) FROM order_runs) AS total_records""")
def report_json(spark, sf):
    """RP1 + RP2 + IO10: the comprehensive report as one JSON record, exported and read back; one row that checks its parts."""
    path = scratch_path(spark, "report")
    IO.export_report(RP.assemble_report("Load test report", _report_parts(spark, sf), generated_at=AS_OF), path)
    text = spark.read.json(path)
    kept = text.select(F.from_json("report", REPORT).alias("r"))
    lines = F.sort_array("r.recommendations")["line"]
    general = F.array(*[F.lit(t) for t in RP.GENERAL_RECOMMENDATIONS])
    return kept.select(
        "r.title", F.size("r.data_summary").alias("metrics_summarised"), F.size("r.missing_data").alias("columns_counted"),
        F.size("r.trends").cast("long").alias("trends"),
        ((F.size("r.clusters") == 3) & (F.size("r.cluster_profiles") > 0) & (F.size("r.cluster_characteristics") > 0)).alias("has_clusters"),
        ((F.size("r.model_insights") > 0) & (F.size("r.explanation_summary") >= 2)
         & F.sort_array("r.recommendations")["line"][0].startswith("Focus optimization efforts on '")).alias("has_explanation"),
        (F.slice(lines, -4, 4) == general).alias("ends_with_general_lines"),
        F.get("r.data_summary", F.lit(0))["total_records"].alias("total_records"))


# The parts of a report that are read back.
REPORT = ("title string, data_summary array<struct<total_records:bigint>>, missing_data array<struct<column:string>>, "
          "trends array<struct<metric:string>>, clusters array<struct<cluster:int>>, cluster_profiles array<struct<cluster:int>>, "
          "cluster_characteristics array<struct<cluster:int>>, model_insights array<struct<feature:string>>, "
          "explanation_summary array<struct<line:string>>, recommendations array<struct<line_no:int,line:string>>")


@register("retrain_cycle", views=["baseline_runs", "current_runs"], rnd=["average_data_samples_per_cycle"], sql="""
SELECT 3 AS total_cycles, 1 AS total_retrainings, 3 AS recent_cycles, (SELECT 2 * (SELECT count(*) FROM current_runs) + count(*) FROM baseline_runs) / 3
  AS average_data_samples_per_cycle, 1 AS models_improved, 1 AS registered_versions, 1 AS errors FROM (SELECT 1)""")
def retrain_cycle(spark, sf):
    """DR7 + M10 + IO12 + A11: three cycles: the first sets the baseline, the second finds drift and retrains, the third asks for an unknown baseline."""
    folder, reg = scratch_path(spark, "improvement"), scratch_path(spark, "registry")
    cols = ["concurrent_users", "avg_response_time"]
    base, cur = baseline_runs(spark, sf).select("test_id", *cols), current_runs(spark, sf).select("test_id", *cols)
    models = {"latency_model": "avg_response_time", "no_target": "missing_column"}
    RP.improvement_cycle(base, folder, models, reg, "2001-07-30 12:00:00")
    RP.improvement_cycle(cur, folder, models, reg, "2001-07-31 12:00:00")
    RP.improvement_cycle(cur, folder, models, reg, AS_OF, baseline="unknown")
    log = RP.cycle_log(spark, folder)
    versions = MD.registry(spark, reg).agg(F.count("*").cast("int").alias("registered_versions"))
    out = MD.improvement_summary(log, AS_OF).select(*[F.col(c).cast("int").alias(c) for c in ("total_cycles", "total_retrainings", "recent_cycles", "models_improved")],
                                                    "average_data_samples_per_cycle")
    errors = log.where("error = 'Baseline ''unknown'' not found'").agg(F.count("*").cast("int").alias("errors"))
    return out.unionByName(versions, allowMissingColumns=True).unionByName(errors, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("total_cycles", "total_retrainings", "recent_cycles", "models_improved", "average_data_samples_per_cycle",
                                      "registered_versions", "errors")])


@register("workflow_report")
def workflow_report(spark, sf):
    """RP3: one-row workflow report as JSON: a summary per phase, key insights, recommendations and next steps."""
    from loadlens.operators import anomaly as ANM
    from loadlens.operators import loadplan as LP
    from loadlens.operators import targets as TG
    from loadlens.plans.q_profile import KEY3
    r = order_runs(spark, sf)
    insights = _model_insights(spark, sf)                       # one fit serves both phases
    parts = _report_parts(spark, sf, insights)
    derived = TG.target_columns(r) + FE.feature_names(r)
    log = ANM.anomaly_log(ANM.detect(r, KEY3))
    base = DR.profile_long(baseline_runs(spark, sf), NUMERIC)
    drift = DR.data_drift(current_runs(spark, sf).select(*NUMERIC), base)
    cand = r.select("test_id", "concurrent_users", "spawn_rate", "duration",
                    F.col("avg_response_time").alias("predicted_latency"))
    bp = LP.breaking_point(LP.best_candidate(cand.withColumn("objective", LP.load_objective()),
                                             tie_break=("concurrent_users", "spawn_rate", "duration", "test_id")))
    counts = r.agg(F.count("*").alias("runs"), F.count_if(F.col("status") == "success").alias("successful_runs"))
    phases = {
        "data_collection": counts,
        "feature_engineering": spark.createDataFrame([(len(derived), len(derived) + len(r.columns))],
                                                     "derived_features int, total_columns int"),
        "models": insights[2].withColumn("model_name", F.lit("latency")),
        "anomalies": log.agg(F.count("*").alias("anomalies_detected"),
                             F.count_if("threshold_exceeded").alias("threshold_violations")),
        "drift": drift.agg(F.first("significant_drift").alias("significant_drift"),
                           F.first("drift_rate").alias("drift_rate")),
        "load_search": bp,
        "top_features": parts["model_insights"],
        "performance_trends": parts["overall_trends"],
        "cluster_types": parts["clusters"],
        "recommendations": parts["recommendations"],
        "next_steps": spark.createDataFrame(list(enumerate(RP.NEXT_STEPS)), "line_no int, line string"),
    }
    return RP.assemble_report("Workflow report", phases, generated_at=AS_OF)
