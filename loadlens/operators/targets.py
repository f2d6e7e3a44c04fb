"""Training targets (TG1-TG4)."""

from __future__ import annotations

from collections.abc import Sequence


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.functions.columns import flag
from loadlens.operators.quantiles import quantile_row

# Target thresholds.
FAILURE_ERROR_RATE = 0.05
RELIABLE_ERROR_RATE = 0.01
FAST_LATENCY_MS = 1000


def create_targets(df: DataFrame, approx: bool = False, wanted: Sequence[str] | None = None) -> DataFrame:
    """Regression and classification targets; missing inputs give 0 flags.

    Only the ``wanted`` ones are made if given; ``anomaly_target`` alone needs a fit.
    """
    cols = set(df.columns)
    new = {}
    if "avg_response_time" in cols:
        new["latency_target"] = F.col("avg_response_time")
        new["latency_log"] = F.log1p("avg_response_time")
    if "requests_per_sec" in cols:
        new["throughput_target"] = F.col("requests_per_sec")
    if "error_rate" in cols:
        new["failure_target"] = flag(F.col("error_rate") > FAILURE_ERROR_RATE)
        new["reliability_target"] = flag(F.col("error_rate") < RELIABLE_ERROR_RATE)
    if "avg_response_time" in cols:
        new["performance_target"] = flag(F.col("avg_response_time") < FAST_LATENCY_MS)
    if "avg_response_time" in cols and (wanted is None or "anomaly_target" in wanted):
        q = quantile_row(df, "avg_response_time", [0.25, 0.75], approx=approx)
        if q[0.25] is None:
            new["anomaly_target"] = F.lit(0)
        else:
            upper = q[0.75] + 1.5 * (q[0.75] - q[0.25])
            new["anomaly_target"] = flag(F.col("avg_response_time") > F.lit(upper))
    new = {k: v for k, v in new.items() if wanted is None or k in wanted}
    return df.withColumns(new) if new else df


def target_columns(df: DataFrame) -> list[str]:
    """The columns that :func:`create_targets` adds, by the schema alone."""
    has = set(df.columns)
    names = {"avg_response_time": ["latency_target", "latency_log"], "requests_per_sec": ["throughput_target"],
             "error_rate": ["failure_target", "reliability_target"]}
    flags = ["performance_target", "anomaly_target"] if "avg_response_time" in has else []
    return [t for c, targets in names.items() if c in has for t in targets] + flags
