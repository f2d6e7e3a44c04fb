"""Model evaluation over prediction tables.

A prediction table has ``actual`` and ``predicted`` columns (plus an
optional model key).  Every metric is an algebraic aggregate, so a model
with a third of all rows is still combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.columns import div
from loadlens.operators.ordering import stored

# Metrics where a larger value is better.
HIGHER_IS_BETTER = ["accuracy", "precision", "recall", "f1", "r2"]


def regression_metrics(df: DataFrame, by: Sequence[str] = (), actual: str = "actual",
                       predicted: str = "predicted") -> DataFrame:
    """MAE, RMSE, R^2 and MAPE (%) per group.

    MAPE skips rows whose actual value is 0 (the reference divides by 0).
    """
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    err = p - a
    g = df.groupBy(*by) if by else df.groupBy()
    out = g.agg(F.avg(F.abs(err)).alias("mae"),
                F.sqrt(F.avg(err * err)).alias("rmse"),
                F.sum(err * err).alias("_sse"),
                (F.var_pop(a) * F.count(a)).alias("_sst"),
                (F.avg(F.abs(div(a - p, a))) * 100).alias("mape"))
    return out.withColumn("r2", 1 - div("_sse", "_sst")).drop("_sse", "_sst")


def best_model(comparison: DataFrame) -> DataFrame:
    """S3: the row of the model with the greatest R^2 (ties by name)."""
    best = comparison.where(F.col("r2").isNotNull() & ~F.isnan("r2")).agg(
        F.min_by(F.struct(*comparison.columns), F.struct((-F.col("r2")).alias("r"), "model")).alias("b"))
    return best.where("b is not null").select("b.*")


def confusion(df: DataFrame, by: Sequence[str] = (), actual: str = "actual",
              predicted: str = "predicted") -> DataFrame:
    """Confusion counts (by..., actual, predicted, n)."""
    return df.groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n"))


def class_report(df: DataFrame, by: Sequence[str] = (), actual: str = "actual",
                 predicted: str = "predicted") -> DataFrame:
    """Per-class precision, recall, F1, support.

    Classes are the union of actual and predicted labels; a class never
    predicted has precision 0, never present has recall 0 (support 0).
    """
    return _class_rows(confusion(df, by, actual, predicted), list(by))


def _class_rows(cm: DataFrame, by: list) -> DataFrame:
    sup = cm.groupBy(*by, F.col("actual").alias("cls")).agg(F.sum("n").alias("support"))
    prd = cm.groupBy(*by, F.col("predicted").alias("cls")).agg(F.sum("n").alias("pred_n"))
    tp = cm.where(F.col("actual") == F.col("predicted")).select(*by, F.col("actual").alias("cls"), F.col("n").alias("tp"))
    keys = [*by, "cls"]
    j = sup.join(prd, keys, "full").join(tp, keys, "left")
    j = j.select(*keys, F.coalesce("support", F.lit(0)).alias("support"),
                 F.coalesce("pred_n", F.lit(0)).alias("pred_n"), F.coalesce("tp", F.lit(0)).alias("tp"))
    prec = F.coalesce(div("tp", "pred_n"), F.lit(0.0))
    rec = F.coalesce(div("tp", "support"), F.lit(0.0))
    j = j.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return j.withColumn("f1", f1).select(*keys, "precision", "recall", "f1", "support")


def classification_metrics(df: DataFrame, by: Sequence[str] = (), actual: str = "actual",
                           predicted: str = "predicted") -> DataFrame:
    """Accuracy and support-weighted precision/recall/F1 (E2); the predictions are counted once, the rest follows from the counts."""
    by = list(by)
    cm = stored(confusion(df, by, actual, predicted), "confusion")
    rep = _class_rows(cm, by)
    w = rep.groupBy(*by).agg(
        F.sum("support").alias("_n"),
        F.sum(F.col("precision") * F.col("support")).alias("_p"),
        F.sum(F.col("recall") * F.col("support")).alias("_r"),
        F.sum(F.col("f1") * F.col("support")).alias("_f"))
    hit = F.col("actual") == F.col("predicted")
    known = F.sum(F.when(hit.isNotNull(), F.col("n")))
    acc = cm.groupBy(*by).agg((F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)) / known).alias("accuracy"))
    if by:
        out = acc.join(w, by, "inner")
    else:
        out = acc.unionByName(w, allowMissingColumns=True).agg(
            *[F.max(c).alias(c) for c in ("accuracy", "_n", "_p", "_r", "_f")])
    return out.select(*by, "accuracy", div("_p", "_n").alias("precision"), div("_r", "_n").alias("recall"),
                      div("_f", "_n").alias("f1"))


def metric_drift(baseline: DataFrame, current: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Model-performance drift (E5) between two one-row metric tables.

    Per metric: relative change (absolute when the baseline is 0) and an
    ``improved`` flag; overall: significant when the mean drift > 0.2,
    degraded when fewer than half of the metrics improved.
    """
    def long(df, name):
        return df.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v"))
                                             for m in metrics])).alias("s")).select("s.metric", F.col("s.v").alias(name))
    b, c = long(baseline, "baseline"), long(current, "current")
    j = b.join(c, "metric")
    drift = F.when(F.col("baseline") != 0, F.abs(F.col("current") - F.col("baseline")) / F.abs(F.col("baseline"))) \
             .otherwise(F.abs(F.col("current") - F.col("baseline")))
    better = F.when(F.col("metric").isin(HIGHER_IS_BETTER), F.col("current") > F.col("baseline")) \
              .otherwise(F.col("current") < F.col("baseline"))
    j = j.withColumn("drift", drift).withColumn("improved", F.coalesce(better, F.lit(False)))
    from pyspark.sql import Window
    w = Window.partitionBy()  # bounded: one row per metric
    return (j.withColumn("average_drift", F.avg("drift").over(w))
             .withColumn("improved_metrics", F.count_if("improved").over(w))
             .withColumn("total_metrics", F.count("*").over(w))
             .withColumn("significant_drift", F.col("average_drift") > 0.2)
             .withColumn("model_degraded", F.col("improved_metrics") < F.col("total_metrics") / 2))
