"""Named, versioned baselines of column profiles (DR3, DR4, DR7).

``set_baselines`` writes the profiles of any number of baselines as one new
version, and after that a commit record per baseline; readers follow commit
records only, so a version that was half written is never seen and setting a
baseline again never changes an earlier one.  ``lookup`` answers any number of
requests ``(baseline_name, as_of)`` at once: the last version committed at that
time, or an error row for a name that has none.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.operators import drift as DR
from loadlens.operators import logs
from loadlens.operators.ordering import join_keys, stored

PROFILE = ["column", "mean", "std", "min", "max", "count", "q25", "median", "q75"]
COMMITS = "baseline_name string, created_at timestamp, version string, columns long"
DRIFT_LOG = ("baseline_name string, checked_at timestamp, total_features long, drifted_count long, drift_rate double, "
             "average_drift double, significant_drift boolean, error string")
# Fixed value: the message for a name without a baseline.
NOT_FOUND = "Baseline '%s' not found"


def set_baselines(profiles: DataFrame, folder: str, created_at: str, version: str | None = None) -> str:
    """Store profile rows (``baseline_name`` and the profile columns) as a new version and commit it."""
    version = version or uuid.uuid4().hex
    path = f"{folder}/profiles/version={version}"
    profiles.select("baseline_name", *PROFILE).write.parquet(path)
    written = profiles.sparkSession.read.parquet(path)
    commit = written.groupBy("baseline_name").agg(F.count("*").alias("columns")).select(
        "baseline_name", F.lit(created_at).cast("timestamp").alias("created_at"), F.lit(version).alias("version"), "columns")
    logs.append(commit, f"{folder}/commits", version)
    return version


def has_any(spark: SparkSession, folder: str) -> bool:
    """Whether any baseline was committed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/commits")
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return there and bool(logs.read(spark, f"{folder}/commits", COMMITS).head(1))


def lookup(requests: DataFrame, folder: str) -> DataFrame:
    """``requests`` (with ``baseline_name`` and ``as_of``) with the version then valid, or an ``error``."""
    spark = requests.sparkSession
    commits = logs.read(spark, f"{folder}/commits", COMMITS).select(
        F.col("baseline_name").alias("_name"), "created_at", "version")
    asked = requests.select("baseline_name", "as_of").distinct()
    valid = asked.join(commits, (F.col("baseline_name") == F.col("_name")) & (F.col("created_at") <= F.col("as_of")))
    last = logs.latest(valid.drop("_name"), ["baseline_name", "as_of"], ["created_at", "version"])
    found = join_keys(requests, stored(last, "baseline-versions"), ["baseline_name", "as_of"], "left")
    return found.withColumn("error", F.when(F.col("version").isNull(), F.format_string(
        NOT_FOUND, F.coalesce(F.col("baseline_name"), F.lit("null")))))


def profiles(found: DataFrame, folder: str) -> DataFrame:
    """Profile rows of the versions that :func:`lookup` found; a request with an error keeps one row without a column."""
    versions = found.sparkSession.read.parquet(f"{folder}/profiles").select("baseline_name", "version", *PROFILE)
    return join_keys(found, versions, ["baseline_name", "version"], "left")


def check_drift(current: DataFrame, columns: Sequence[str], folder: str, by: Sequence[str], name: Column, as_of: Column,
                threshold: float = 0.3) -> DataFrame:
    """DR4 against named baselines: a log record per group of ``by``; an unknown name gives a record with its error."""
    by = list(by)
    asked = stored(current.select(*by).distinct().withColumns({"baseline_name": name, "as_of": as_of.cast("timestamp")}), "drift-requests")
    found = stored(lookup(asked, folder), "drift-baselines")
    base = profiles(found.where("error is null").select(*by, "baseline_name", "version"), folder)
    drift = DR.data_drift(current.select(*by, *columns), base.select(*by, *PROFILE), threshold, by)
    one = drift.groupBy(*by).agg(*[F.first(c).alias(c) for c in ("total_features", "drifted_count", "drift_rate", "average_drift",
                                                                  "significant_drift")])
    return join_keys(found.withColumnRenamed("as_of", "checked_at"), one, by, "left")


def log_drift(checks: DataFrame, folder: str, cycle: str) -> None:
    """Append a cycle's drift records; a repeated cycle replaces its own."""
    fields = [f.split()[0] for f in DRIFT_LOG.split(", ")]
    logs.append(checks.select(*fields), f"{folder}/drift_log", cycle)


def drift_log(spark: SparkSession, folder: str) -> DataFrame:
    return logs.read(spark, f"{folder}/drift_log", DRIFT_LOG)
