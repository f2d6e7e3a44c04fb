"""Reports (RP1-RP3) and the continuous-improvement cycle (DR7).

Each report part is a small DataFrame produced by the operators; the
report is one nested row (``struct`` / ``collect_list`` over those small
tables only) serialised with ``to_json`` (IO10).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The general recommendation lines of a report.
GENERAL_RECOMMENDATIONS = [
    "Monitor model drift regularly and retrain when necessary",
    "Set up automated alerts for performance anomalies",
    "Consider A/B testing for performance optimizations",
    "Document successful optimization strategies for future reference",
]


# The recommendation lines that depend on the results.
TOP_FEATURE = "Focus optimization efforts on '%s' as it's the most important feature for %s"
DEGRADING = "Performance is degrading - investigate recent changes and consider immediate optimization"
IMPROVING = "Performance is improving - continue current optimization strategies"
FOCUS = "Focus on improving: %s"
CLUSTERS = "Investigate clusters [%s] which show poor performance patterns"

# The next steps of a workflow report.
NEXT_STEPS = [
    "Monitor system performance and model drift",
    "Run regular continuous improvement cycles",
    "Implement automated alerts for anomalies",
    "Scale testing based on load recommendations",
]


def recommendations(top_features: Mapping[str, DataFrame | str], overall: DataFrame | None,
                    cluster_types: DataFrame | None) -> DataFrame:
    """RP2: recommendation lines, numbered in order.

    ``top_features`` maps a model's name to its most important feature (a name,
    or ranked importances); ``overall`` is the TR3 row; ``cluster_types`` the CL2 table.
    """
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    parts = []

    def add(lines: DataFrame):
        parts.append(lines.select((F.lit(100 * len(parts)) + F.col("at")).cast("int").alias("_no"), "line"))
    for model, top in top_features.items():
        if isinstance(top, DataFrame):
            add(top.where("rank = 1").select(F.lit(0).alias("at"), F.format_string(TOP_FEATURE, "feature", F.lit(model)).alias("line")))
        elif top:
            add(spark.createDataFrame([(0, TOP_FEATURE % (top, model))], "at int, line string"))
    if overall is not None:
        d = F.col("overall_performance_direction")
        bad = F.array_join(F.split("degrading_metrics", ","), ", ")
        lines = F.array(F.when(d == "Degrading", F.lit(DEGRADING)).when(d == "Improving", F.lit(IMPROVING)),
                        F.when(F.col("degrading_metrics") != "", F.format_string(FOCUS, bad)))
        add(overall.select(F.posexplode(F.filter(lines, lambda x: x.isNotNull())).alias("at", "line")))
    if cluster_types is not None:
        low = cluster_types.where(F.col("cluster_type").contains("Low") | F.col("cluster_type").contains("Unreliable"))
        ids = low.agg(F.array_sort(F.collect_list("cluster")).alias("ids")).where(F.size("ids") > 0)
        add(ids.select(F.lit(0).alias("at"), F.format_string(CLUSTERS, F.array_join("ids", ", ")).alias("line")))
    add(spark.createDataFrame(list(enumerate(GENERAL_RECOMMENDATIONS)), "at int, line string"))
    out = reduce(DataFrame.unionByName, parts)
    from pyspark.sql import Window
    return out.select((F.row_number().over(Window.partitionBy().orderBy("_no")) - 1).cast("int").alias("line_no"), "line")   # a few lines


def nested(df: DataFrame, name: str) -> DataFrame:
    """A small table as one row holding an array of structs (bounded by the table)."""
    return df.agg(F.collect_list(F.struct(*df.columns)).alias(name))


def assemble_report(title: str, parts: Mapping[str, DataFrame], generated_at: str | None = None) -> DataFrame:
    """RP1/RP3: one row with ``report`` = JSON of every part (each a small table)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    ts = generated_at or _dt.datetime.now().isoformat()
    rows = [nested(df, k) for k, df in parts.items()]
    out = spark.createDataFrame([(title, ts)], "title string, timestamp string")
    for r in rows:
        out = out.unionByName(r, allowMissingColumns=True)
    cols = ["title", "timestamp", *parts]
    one = out.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
    return one.select(F.to_json(F.struct(*cols)).alias("report"))


CYCLE_LOG = ("timestamp timestamp, data_samples long, improvements map<string,string>, significant_drift boolean, drift_rate double, "
             "baseline_name string, error string")


def improvement_cycle(new_data: DataFrame, folder: str, models: Mapping[str, str], registry_dir: str, as_of: str,
                      last_retrained: Mapping[str, str] | None = None, threshold: float = 0.3, baseline: str = "initial") -> DataFrame:
    """DR7: drift against a named baseline -> decision per (model, target) -> retraining -> appended cycle log.

    Baselines and the log live under ``folder``.  Where no baseline was ever
    set, the new data become the baseline ``initial`` first; an unknown name
    beside others is logged as an error and no model is touched.  ``models``
    maps a model's name to its own target column (D9); the loop is over a
    handful of models, each step a Spark job.  A cycle repeated for the same
    time replaces its log record.  Returns the cycle's record.
    """
    from loadlens.operators import baselines as BL
    from loadlens.operators import drift as DR
    from loadlens.operators import logs
    from loadlens.operators import models as MD
    from loadlens.schema import numeric_columns
    spark = new_data.sparkSession
    columns = numeric_columns(new_data)
    if not BL.has_any(spark, folder):
        profile = DR.profile_long(new_data.select(*columns), columns).withColumn("baseline_name", F.lit("initial"))
        BL.set_baselines(profile, folder, as_of)
        baseline = "initial"
    named = new_data.select(*columns).withColumn("_baseline", F.lit(baseline))
    checks = BL.check_drift(named, columns, folder, ["_baseline"], F.col("_baseline"), F.lit(as_of), threshold)
    s = checks.first()
    n = new_data.count()
    improvements = {}
    if s is not None and s["error"] is None:
        rows = [(m, bool(s["significant_drift"]), float(s["drift_rate"] or 0.0), n,
                 (_dt.datetime.fromisoformat(last_retrained[m]) if last_retrained and m in last_retrained else None))
                for m in models]
        dec = DR.retrain_decisions(spark.createDataFrame(
            rows, "model string, significant_drift boolean, drift_rate double, new_rows long, last_retrained timestamp"),
            as_of)
        for r in dec.collect():
            if models[r.model] not in new_data.columns:
                continue                                        # a model without its target column is left out
            if r.should_retrain:
                res = MD.retrain_model(new_data, r.model, models[r.model], registry_dir)
                improvements[r.model] = "retrained" if res["success"] else "retraining_failed"
            else:
                improvements[r.model] = "no_action_needed"
    record = spark.createDataFrame(
        [(_dt.datetime.fromisoformat(as_of), n, improvements, bool(s and s["significant_drift"]), float((s and s["drift_rate"]) or 0.0),
          baseline, s["error"] if s else None)], CYCLE_LOG)
    logs.append(record, f"{folder}/cycles", "cycle-" + "".join(c for c in as_of if c.isdigit()))
    return record


def cycle_log(spark, folder: str) -> DataFrame:
    """All logged improvement cycles."""
    from loadlens.operators import logs
    return logs.read(spark, f"{folder}/cycles", CYCLE_LOG)
