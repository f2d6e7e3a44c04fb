"""Named baselines, drift log, and the state of append-only logs as of a time."""

from __future__ import annotations

from pyspark.sql import functions as F

from loadlens.operators import baselines as BL
from loadlens.operators import drift as DR
from loadlens.operators import logs
from loadlens.operators import models as MD
from loadlens.plans.catalog import register
from loadlens.plans.q_profile import NUMERIC
from loadlens.plans.q_quality import _profile_sql
from loadlens.session import scratch_path
from loadlens.sources.tables import baseline_runs, current_runs, table

AS_OF = "1998-01-01 00:00:00"
_SHIFT = " + ".join(f"abs(c.{m} - b.{m}) / (abs(b.{m}) + 1e-8)" for m in ("mean", "std", "q25", "q75"))


def _set_two(spark, sf, folder):
    """Baselines of the test types api and frontend: a first version from the runs before 1997, a second from all baseline runs."""
    runs = baseline_runs(spark, sf).where("test_type <> 'load'").select("test_type", "timestamp", *NUMERIC)
    early = runs.where(F.col("timestamp") < F.lit("1997-01-01").cast("timestamp"))
    for frame, created in ((early, "1997-01-01 00:00:00"), (runs, "1999-01-01 00:00:00")):
        profile = DR.profile_long(frame.select("test_type", *NUMERIC), NUMERIC, by=["test_type"])
        BL.set_baselines(profile.withColumnRenamed("test_type", "baseline_name"), folder, created)
    half = DR.profile_long(runs.select("test_type", *NUMERIC), NUMERIC[:1], by=["test_type"])
    half.withColumnRenamed("test_type", "baseline_name").select("baseline_name", *BL.PROFILE).write.parquet(
        f"{folder}/profiles/version=unfinished")                # no commit record: must never be read


@register("baseline_lookup", views=["baseline_runs"], rnd=["mean", "std", "q25", "q75"], sql=f"""
WITH early AS (SELECT * FROM baseline_runs WHERE ts < TIMESTAMP '1997-01-01'),
v AS (SELECT TIMESTAMP '1997-01-01' AS created, * FROM {_profile_sql('early', 'test_type')}
  UNION ALL SELECT TIMESTAMP '1999-01-01', * FROM {_profile_sql('baseline_runs', 'test_type')}),
ask AS (SELECT n AS baseline_name, t AS moment FROM (VALUES ('api'), ('frontend'), ('load')) a(n),
  (VALUES (TIMESTAMP '1996-06-01'), (TIMESTAMP '1998-01-01'), (TIMESTAMP '2001-01-01')) b(t)),
hit AS (SELECT baseline_name, moment, (SELECT max(created) FROM v WHERE test_type = baseline_name AND baseline_name <> 'load' AND created <= moment) AS created FROM ask)
SELECT baseline_name, strftime(moment, '%Y-%m-%d') AS as_of, v."column", mean, std, q25, q75,
  CASE WHEN hit.created IS NULL THEN 'Baseline ''' || baseline_name || ''' not found' END AS error
FROM hit LEFT JOIN v ON v.test_type = baseline_name AND v.created = hit.created""")
def baseline_lookup(spark, sf):
    """DR3: named baselines, two versions each; what three points in time see, with an error row for a name without any."""
    folder = scratch_path(spark, "baselines")
    _set_two(spark, sf, folder)
    times = F.explode(F.array(*[F.lit(t).cast("timestamp") for t in ("1996-06-01", "1998-01-01", "2001-01-01")]))
    asked = baseline_runs(spark, sf).select(F.col("test_type").alias("baseline_name")).distinct().withColumn("as_of", times)
    rows = BL.profiles(BL.lookup(asked, folder), folder)
    return rows.select("baseline_name", F.date_format("as_of", "yyyy-MM-dd").alias("as_of"), "column", "mean", "std", "q25", "q75", "error")


@register("drift_log", views=["baseline_runs", "current_runs"], rnd=["drift_rate", "average_drift"], sql=f"""
WITH cur AS (SELECT *, test_type || '|' || year(ts) AS cycle FROM current_runs),
c AS {_profile_sql('cur', 'cycle')}, b AS {_profile_sql('baseline_runs', 'test_type')},
j AS (SELECT c.cycle, c."column", ({_SHIFT}) / 4.0 AS score FROM c JOIN b ON b."column" = c."column"
  AND b.test_type = split_part(c.cycle, '|', 1) WHERE b.test_type <> 'load'),
k AS (SELECT cycle, count(*) AS total_features, count(*) FILTER (WHERE score > 0.3) AS drifted_count, avg(score) AS average_drift
  FROM j GROUP BY cycle),
ask AS (SELECT DISTINCT cycle FROM cur)
SELECT split_part(cycle, '|', 1) AS baseline_name, split_part(cycle, '|', 2) AS year, total_features, drifted_count,
  drifted_count / total_features AS drift_rate, average_drift,
  drifted_count > total_features * 0.3 OR average_drift > 0.3 AS significant_drift,
  CASE WHEN total_features IS NULL THEN 'Baseline ''' || split_part(cycle, '|', 1) || ''' not found' END AS error
FROM ask LEFT JOIN k USING (cycle)""")
def drift_log(spark, sf):
    """DR4 + DR7: yearly drift cycles against named baselines, appended to a log; a repeated cycle replaces itself."""
    folder = scratch_path(spark, "drift-cycles")
    _set_two(spark, sf, folder)
    runs = current_runs(spark, sf).withColumn("year", F.year("timestamp")).select("test_type", "year", *NUMERIC)
    checks = BL.check_drift(runs, NUMERIC, folder, ["test_type", "year"], F.col("test_type"),
                            F.make_timestamp(F.col("year") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    for _ in range(2):
        BL.log_drift(checks, folder, "all-years")
    log = BL.drift_log(spark, folder)
    return log.select("baseline_name", (F.year("checked_at") - 1).cast("string").alias("year"), "total_features", "drifted_count",
                      "drift_rate", "average_drift", "significant_drift", "error")


def _registry_log(spark, sf):
    """Training records of five models, one per order, kept as a log in two batches; versions repeat."""
    o = table(spark, sf, "orders")
    at = F.col("o_orderdate").cast("timestamp")
    rows = o.select(
        F.concat(F.lit("model_"), (F.col("o_custkey") % 5).cast("string")).alias("model_name"),
        F.concat(F.date_format(at, "yyyyMM"), F.lit("_"), (F.col("o_orderkey") % 3).cast("string")).alias("version"),
        at.alias("timestamp"), F.col("o_orderkey").alias("record"), F.floor("o_totalprice").cast("long").alias("data_samples"),
        ((F.col("o_orderkey") % 100) / 100.0).alias("cv_score"),
        F.to_json(F.struct((F.col("o_totalprice") / 1000).alias("rmse"), ((F.col("o_orderkey") % 97) / 97.0).alias("r2"))).alias("metrics"),
        "o_orderstatus")
    folder = scratch_path(spark, "registry-log")
    fields = rows.drop("o_orderstatus").schema
    logs.append(rows.where("o_orderstatus = 'F'").drop("o_orderstatus"), folder, "closed")
    logs.append(rows.where("o_orderstatus <> 'F'").drop("o_orderstatus"), folder, "open")
    logs.append(rows.where("o_orderstatus = 'F'").drop("o_orderstatus"), folder, "closed")
    return logs.read(spark, folder, fields)


_REGISTRY_SQL = """registry AS (SELECT concat('model_', CAST(o_custkey % 5 AS VARCHAR)) AS model_name,
  strftime(o_orderdate, '%Y%m') || '_' || CAST(o_orderkey % 3 AS VARCHAR) AS version, o_orderdate AS moment, o_orderkey AS record,
  CAST(floor(o_totalprice) AS BIGINT) AS data_samples, (o_orderkey % 100) / 100.0 AS cv_score, o_totalprice / 1000 AS rmse,
  (o_orderkey % 97) / 97.0 AS r2 FROM orders)"""


@register("version_compare", rnd=["cv_score", "rmse", "r2"], sql=f"""
WITH {_REGISTRY_SQL}
SELECT version, strftime(moment, '%Y-%m-%d') AS training_date, data_samples, cv_score, rmse, r2 FROM registry
WHERE model_name = 'model_1' AND version IN ('199501_0', '199612_1', '199707_2', '200001_0') AND moment <= TIMESTAMP '{AS_OF}'
QUALIFY row_number() OVER (PARTITION BY version ORDER BY moment DESC, record DESC) = 1""")
def version_compare(spark, sf):
    """The listed versions of a model side by side, as of a time; versions that don't exist then are left out."""
    log = _registry_log(spark, sf)
    rows = MD.versions_as_of(log, "model_1", ["199501_0", "199612_1", "199707_2", "200001_0", "none"], AS_OF)
    metrics = F.from_json("metrics", "rmse double, r2 double")
    return rows.select("version", F.date_format("timestamp", "yyyy-MM-dd").alias("training_date"), "data_samples", "cv_score",
                       metrics["rmse"].alias("rmse"), metrics["r2"].alias("r2"))


@register("version_latest", sql=f"""
WITH {_REGISTRY_SQL}
SELECT model_name, version, record FROM registry WHERE moment <= TIMESTAMP '{AS_OF}'
QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY version DESC, moment DESC, record DESC) = 1""")
def version_latest(spark, sf):
    """The latest version of each model by its full name, as of a time."""
    log = _registry_log(spark, sf).where(F.col("timestamp") <= F.lit(AS_OF).cast("timestamp"))
    return logs.latest(log, ["model_name"], ["version", "timestamp", "record"]).select("model_name", "version", "record")


@register("retraining_summary", rnd=["average_cv_score"], sql=f"""
WITH {_REGISTRY_SQL},
seen AS (SELECT * FROM registry WHERE moment <= TIMESTAMP '{AS_OF}'),
per AS (SELECT model_name, count(*) AS n FROM seen GROUP BY 1)
SELECT count(*) AS total_retrainings, count(DISTINCT model_name) AS models_retrained,
  count(*) FILTER (WHERE moment > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY) AS recent_retrainings, avg(cv_score) AS average_cv_score,
  (SELECT string_agg(model_name || '=' || CAST(n AS VARCHAR), ',' ORDER BY model_name) FROM per) AS retrainings_by_model FROM seen""")
def retraining_summary(spark, sf):
    """A10: the retraining log summarised as of a time."""
    log = _registry_log(spark, sf).where(F.col("timestamp") <= F.lit(AS_OF).cast("timestamp"))
    by = F.array_sort(F.transform(F.map_entries("retrainings_by_model"),
                                  lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    return MD.retraining_summary(log, AS_OF).withColumn("retrainings_by_model", F.array_join(by, ","))


@register("improvement_summary", rnd=["average_data_samples_per_cycle"], sql=f"""
WITH cycles AS (SELECT o_orderkey AS k, o_orderdate AS moment, CAST(floor(o_totalprice) AS BIGINT) AS data_samples,
  o_custkey % 3 AS a, o_orderkey % 4 AS b, o_custkey % 7 AS m FROM orders WHERE o_orderdate <= TIMESTAMP '{AS_OF}'),
acts AS (SELECT 'latency_' || CAST(m AS VARCHAR) AS model, a = 0 AS done FROM cycles UNION ALL SELECT 'errors', b = 1 FROM cycles)
SELECT count(*) AS total_cycles, (SELECT count(*) FILTER (WHERE done) FROM acts) AS total_retrainings,
  count(*) FILTER (WHERE moment > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY) AS recent_cycles,
  avg(data_samples) AS average_data_samples_per_cycle,
  (SELECT count(DISTINCT model) FILTER (WHERE done) FROM acts) AS models_improved FROM cycles""")
def improvement_summary(spark, sf):
    """The log of improvement cycles (a map of model to action each) summarised as of a time."""
    o = table(spark, sf, "orders")
    acts = F.array(F.lit("retrained"), F.lit("retraining_failed"), F.lit("no_action_needed"))
    rows = o.select(
        F.col("o_orderdate").cast("timestamp").alias("timestamp"), F.floor("o_totalprice").cast("long").alias("data_samples"),
        F.create_map(F.concat(F.lit("latency_"), (F.col("o_custkey") % 7).cast("string")),
                     F.element_at(acts, (F.col("o_custkey") % 3 + 1).cast("int")),
                     F.lit("errors"), F.when(F.col("o_orderkey") % 4 == 1, "retrained").otherwise("no_action_needed")).alias("improvements"))
    folder = scratch_path(spark, "cycle-log")
    logs.append(rows, folder, "all")
    log = logs.read(spark, folder, rows.schema)
    return MD.improvement_summary(log.where(F.col("timestamp") <= F.lit(AS_OF).cast("timestamp")), AS_OF)
