"""Run-store operators: filters, recency, retention, validation, rollups.

F1-F5 (filters), IO3/IO4 (validation, metadata packing), A1 (request-stat
rollup), A2 (run summary), U2 (success/error union), SF1 (audit scores).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.schema import METADATA_EXCLUDED, REQUIRED_FIELDS


def filter_runs(df: DataFrame, filters: Mapping | None = None) -> DataFrame:
    """Conjunctive equality / IN-list filter (F1, F2).

    A list or tuple value is an IN list (empty list -> no rows); a NULL value
    never matches, as with SQL ``= ?``.  Predicates push down to parquet.
    """
    if not filters:
        return df
    cond: Column | None = None
    for k, v in filters.items():
        if isinstance(v, (list, tuple)):
            e = F.col(k).isin(list(v)) if v else F.lit(False)
        elif v is None:
            e = F.lit(False)
        else:
            e = F.col(k) == F.lit(v)
        cond = e if cond is None else cond & e
    return df.where(cond)


def get_results(df: DataFrame, filters: Mapping | None = None, limit: int | None = None,
                time_col: str = "timestamp", tie_break: str = "test_id") -> DataFrame:
    """Filtered runs, newest first; ``limit`` 0/None = all (F3 top-N)."""
    out = filter_runs(df, filters).orderBy(F.col(time_col).desc(), F.col(tie_break).desc())
    return out.limit(int(limit)) if limit else out


def recent_runs(df: DataFrame, hours: float, as_of, time_col: str = "timestamp") -> DataFrame:
    """Runs of the last ``hours`` before ``as_of`` (inclusive, F4)."""
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600))
    return df.where(F.col(time_col) >= cutoff)


def retention_split(df: DataFrame, days: int, as_of, time_col: str = "timestamp"):
    """(kept, deleted) frames for a retention of ``days``.

    Rows strictly older than ``as_of - days`` are deleted.  On a date
    partitioned table the kept frame is written back with dynamic
    partition overwrite, so only touched partitions are rewritten.
    """
    cutoff = F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(int(days)))
    old = F.col(time_col) < cutoff
    return df.where(~old | F.col(time_col).isNull()), df.where(old)


def validity(df: DataFrame) -> Column:
    """True when every required field is present (IO3)."""
    cond = None
    for c in REQUIRED_FIELDS:
        e = F.col(c).isNotNull() if c in df.columns else F.lit(False)
        cond = e if cond is None else cond & e
    return cond


def reject_reason(df: DataFrame) -> Column:
    """First missing required field, as text; NULL for a valid row."""
    expr = None
    for c in REQUIRED_FIELDS:
        cond = F.col(c).isNull() if c in df.columns else F.lit(True)
        msg = F.lit(f"Missing required field: {c}")
        expr = F.when(cond, msg) if expr is None else expr.when(cond, msg)
    return expr


def pack_metadata(df: DataFrame, out: str = "metadata") -> DataFrame:
    """JSON of every non-identity field, nulls kept (IO4)."""
    fields = [c for c in df.columns if c not in METADATA_EXCLUDED and c != out]
    return df.withColumn(out, F.to_json(F.struct(*[F.col(c) for c in fields]),
                                        {"ignoreNullFields": "false"}))


def split_batch(df: DataFrame):
    """(valid with metadata, rejects with reason) for a raw batch (IO3)."""
    valid = pack_metadata(df.where(validity(df)))
    rejects = df.where(~validity(df)).withColumn("reject_reason", reject_reason(df))
    return valid, rejects


def rollup_request_stats(stats: DataFrame, key: str = "test_id") -> DataFrame:
    """Run metrics from load-generator statistics rows (A1).

    Sums of requests/failures, mean of the per-row averages (as the
    reference does), max of max, min of min, mean throughput; error rate is
    failures/requests, 0 when there were no requests.  Partial aggregation
    runs map-side, so a hot run key only moves one row per task.
    """
    g = stats.groupBy(key).agg(
        F.sum("request_count").cast("bigint").alias("total_requests"),
        F.sum("failure_count").cast("bigint").alias("total_failures"),
        F.avg("avg_response_time").alias("avg_response_time"),
        F.max("max_response_time").alias("max_response_time"),
        F.min("min_response_time").alias("min_response_time"),
        F.avg("requests_per_sec").alias("requests_per_sec"))
    return g.withColumn("error_rate", F.when(F.col("total_requests") > 0,
                                             F.col("total_failures") / F.col("total_requests"))
                        .otherwise(F.lit(0.0))).withColumn("status", F.lit("success"))


def run_summary(df: DataFrame) -> DataFrame:
    """One-pass test summary (A2): counts and success-only latency metrics."""
    ok = F.col("status") == "success"
    g = df.agg(
        F.count("*").alias("total_tests"),
        F.count_if(ok).alias("successful_tests"),
        F.count_if(F.col("status") == "error").alias("failed_tests"),
        F.avg(F.when(ok, F.col("avg_response_time"))).alias("avg_latency"),
        F.max(F.when(ok, F.col("avg_response_time"))).alias("max_latency"),
        F.min(F.when(ok, F.col("avg_response_time"))).alias("min_latency"),
        F.avg(F.when(ok, F.col("error_rate"))).alias("avg_error_rate"),
        F.avg(F.when(ok, F.col("requests_per_sec"))).alias("avg_throughput"))
    return g.withColumn("success_rate", F.when(F.col("total_tests") > 0,
                                               F.col("successful_tests") / F.col("total_tests"))
                        .otherwise(F.lit(0.0)))


def union_results(success: DataFrame, errors: DataFrame) -> DataFrame:
    """Success rows and error rows with different columns."""
    return success.unionByName(errors, allowMissingColumns=True)


# Audit categories, checked in this order on each line.
AUDIT_CATEGORIES = [("Performance", "performance"), ("Accessibility", "accessibility"),
                    ("Best Practices", "best_practices"), ("SEO", "seo")]


def audit_scores(reports: DataFrame, key: str = "test_id", text: str = "text") -> DataFrame:
    """Scores from page-audit text reports (SF1), one row per report.

    A line counts for the first category whose name it contains
    (case-sensitive) when it also contains "score" in any case; its value
    is the token after the token equal to "score" (any case); a missing or
    unparsable token gives 0.0; the last counting line wins; a category
    without a line gives 0.0.
    """
    lines = reports.select(key, F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"))
    has_score = F.lower("line").contains("score")
    cat = None
    for name, short in AUDIT_CATEGORIES:
        cond = F.col("line").contains(name) & has_score
        cat = F.when(cond, F.lit(short)) if cat is None else cat.when(cond, F.lit(short))
    toks = F.split(F.regexp_replace("line", r"^\s+|\s+$", ""), r"\s+")
    idx = F.array_position(F.transform(toks, lambda t: F.lower(t)), "score")
    val = F.when(idx > 0, F.try_element_at(toks, (idx + 1).cast("int")))
    score = F.coalesce(F.expr("try_cast(_tok AS DOUBLE)"), F.lit(0.0))
    scored = (lines.withColumn("cat", cat).where(F.col("cat").isNotNull())
                   .withColumn("_tok", val).withColumn("score", score))
    last = scored.groupBy(key, "cat").agg(F.max_by("score", "pos").alias("score"))
    wide = last.groupBy(key).pivot("cat", [s for _, s in AUDIT_CATEGORIES]).agg(F.first("score"))
    base = reports.select(key)
    out = base.join(wide, key, "left")
    return out.select(key, *[F.coalesce(F.col(s), F.lit(0.0)).alias(f"{s}_score")
                             for _, s in AUDIT_CATEGORIES])


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows by a total order (deterministic sample for explanations)."""
    return df.orderBy(*[F.col(c) for c in order]).limit(int(n))
