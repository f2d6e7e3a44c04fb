"""Clustering of runs and cluster profiles (CL1-CL3, A6, A7).

k-means runs on mean-imputed, standardised numeric columns (MLlib
``KMeans``); cluster profiles are ``groupBy(cluster)`` aggregates over the
*raw* values (the reference labels z-scores, defect D11), with exact
per-cluster medians from the distributed quantile helper.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.operators.filters import mean_impute
from loadlens.operators.ordering import fit_rows, join_keys, task_per_file
from loadlens.operators.quantiles import long_values, quantile_rows
from loadlens.operators.scaling import apply_scaler, fit_scaler
from loadlens.schema import numeric_columns

# Columns never clustered, and the metrics of a performance profile.
CLUSTER_EXCLUDE = ["test_id", "timestamp", "id"]
PROFILE_METRICS = ["avg_response_time", "requests_per_sec", "error_rate", "latency_target", "throughput_target"]


def cluster_runs(df: DataFrame, k: int = 3, seed: int = 42, exclude: Sequence[str] = ()):
    """CL1: (labelled frame with ``cluster``, KMeansModel, feature names)."""
    feats = numeric_columns(df, exclude=[*CLUSTER_EXCLUDE, *exclude])
    if len(feats) < 2:
        raise ValueError("Insufficient features for clustering")
    x = mean_impute(df, feats)
    stats = fit_scaler(x, "standard", feats)
    z = apply_scaler(x.select(*[F.col(c).alias(f"_z_{c}") for c in feats], *df.columns),
                     stats.withColumn("column", F.concat(F.lit("_z_"), "column")))
    vec = VectorAssembler(inputCols=[f"_z_{c}" for c in feats], outputCol="_features").transform(z)
    rows = fit_rows(vec.select("_features"))
    with task_per_file(df.sparkSession):
        model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(rows)
    labelled = model.transform(vec).drop("_features", *[f"_z_{c}" for c in feats])
    return labelled, model, feats


def cluster_sizes(labelled: DataFrame) -> DataFrame:
    """Size and percentage per cluster."""
    from pyspark.sql import Window
    g = labelled.groupBy("cluster").agg(F.count("*").alias("size"))
    return g.withColumn("percentage", F.col("size") / F.sum("size").over(Window.partitionBy()) * 100)


def cluster_characteristics(labelled: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per (cluster, feature) mean, sample std, min, max, median (nulls dropped)."""
    lv = long_values(labelled, features, ["cluster"]).where(F.col("value").isNotNull())
    mom = lv.groupBy("cluster", "column").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                                              F.min("value").alias("min"), F.max("value").alias("max"))
    med = quantile_rows(lv, ["cluster", "column"], "value", [0.5]).select("cluster", "column", F.col("value").alias("median"))
    return join_keys(mom, med, ["cluster", "column"], "left").withColumnRenamed("column", "feature")


def performance_profile(labelled: DataFrame) -> DataFrame:
    """Per cluster and metric mean, sample std and the "min - max" range text."""
    metrics = [m for m in PROFILE_METRICS if m in labelled.columns]
    lv = long_values(labelled, metrics, ["cluster"]).where(F.col("value").isNotNull())
    return lv.groupBy("cluster", F.col("column").alias("metric")).agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.format_string("%.2f - %.2f", F.min("value"), F.max("value")).alias("range"))


def cluster_types(profile: DataFrame) -> DataFrame:
    """CL2: latency class (<500 High, <1500 Medium, else Low), else reliability class."""
    lat = profile.where(F.col("metric") == "avg_response_time").select("cluster", F.col("mean").alias("lat"))
    err = profile.where(F.col("metric") == "error_rate").select("cluster", F.col("mean").alias("err"))
    ids = profile.select("cluster").distinct()
    j = ids.join(lat, "cluster", "left").join(err, "cluster", "left")
    t = (F.when(F.col("lat").isNotNull(),
                F.when(F.col("lat") < 500, "High Performance").when(F.col("lat") < 1500, "Medium Performance")
                 .otherwise("Low Performance"))
          .when(F.col("err").isNotNull(),
                F.when(F.col("err") < 0.01, "Reliable").when(F.col("err") < 0.05, "Moderate Reliability")
                 .otherwise("Unreliable"))
          .otherwise(F.concat(F.lit("Cluster "), F.col("cluster").cast("string"))))
    return j.select("cluster", t.alias("cluster_type"))


def center_spread(model, features: Sequence[str]) -> DataFrame:
    """CL3: population std of each feature across the cluster centres."""
    import statistics
    from pyspark.sql import SparkSession
    centers = model.clusterCenters()
    rows = [(f, float(statistics.pstdev([c[i] for c in centers]))) for i, f in enumerate(features)]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, spread double")
