"""Derived run features (FE1-FE32).

All features are Column expressions added with one ``withColumns`` per
group, so the whole set is a single codegen'd projection.  A feature group
is emitted only when its input columns exist (schema check, no job).  The
few features that need a table-wide value (min/max users, min throughput,
category codes, the users rank) are *fitted* first: one aggregate job whose
results are inlined as literals, and a stored table of codes per category
column that is joined by value.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.extensions import apply_custom_features
from loadlens.functions.columns import cut, div, mean_of, sample_std_of
from loadlens.operators.ordering import ROWS_PER_RANGE, average_rank_pct, join_keys, running, stored
from loadlens.schema import BASE_FEATURES, SCORE_COLUMNS

# Bin edges and labels of the categorical features.
LOAD_BINS = ([0, 50, 100, 200, 500, float("inf")], ["light", "medium", "high", "very_high", "extreme"])
ERROR_BINS = ([0, 0.01, 0.05, 0.1, 0.2, 1.0], ["excellent", "good", "acceptable", "poor", "critical"])
DURATION_BINS = ([0, 300, 600, 1200, float("inf")], ["short", "medium", "long", "very_long"])
SCORE_BINS = ([0, 0.5, 0.7, 0.9, 1.0], ["poor", "needs_improvement", "good", "excellent"])
PAYLOAD_BINS = ([0, 1, 10, 100, 1000, float("inf")], ["tiny", "small", "medium", "large", "huge"])
# Nominal link speed in Mbps per network condition.
NETWORK_SPEED_MBPS = {"wifi": 50.0, "4g": 20.0, "3g": 3.0, "slow_3g": 1.5}


def _has(df: DataFrame, *cols: str) -> bool:
    names = set(df.columns)
    return all(c in names for c in cols)


@dataclass
class FeatureStats:
    """Fitted table-wide constants used by the G features."""
    min_users: float | None = None
    max_users: float | None = None
    min_rps: float | None = None
    payload_any: bool = False
    codes: dict = field(default_factory=dict)   # column -> stored table (_cv, _code)


def fit_feature_stats(df: DataFrame) -> FeatureStats:
    st = FeatureStats()
    aggs = []
    if _has(df, "concurrent_users"):
        aggs += [F.min("concurrent_users").alias("min_users"), F.max("concurrent_users").alias("max_users")]
    if _has(df, "requests_per_sec", "concurrent_users"):
        aggs.append(F.min("requests_per_sec").alias("min_rps"))
    if _has(df, "payload_size"):
        aggs.append((F.count("payload_size") > 0).alias("payload_any"))
    if aggs:
        r = df.agg(*aggs).first().asDict()
        st.min_users, st.max_users = r.get("min_users"), r.get("max_users")
        st.min_rps = r.get("min_rps")
        st.payload_any = bool(r.get("payload_any", False))
    named = [c for c in ("network_condition", "browser") if _has(df, c)]
    if named:
        values = df.select(*[F.col(c).cast("string").alias(c) for c in named]).unpivot([], named, "column", "_cv").where("_cv is not null")
        values = stored(values.distinct(), "categories")
        ranges = values.count() // ROWS_PER_RANGE + 1
        codes = running(values, ["_cv"], ["column"], {"_code": ("count", "_cv")}, ranges)   # both columns in one numbering
        codes = codes.select("column", "_cv", (F.col("_code") - 1).cast("int").alias("_code"))
        st.codes = {c: codes.where(F.col("column") == c).drop("column") for c in named}
    return st


def category_codes(df: DataFrame, column: str, out: str, codes: DataFrame | None) -> DataFrame:
    """Lexicographic category code from 0; NULL (or unseen) -> -1."""
    if codes is None:
        return df.withColumn(out, F.lit(-1))
    joined = join_keys(df.withColumn("_cv", F.col(column).cast("string")), codes, ["_cv"], "left")
    return joined.withColumn(out, F.coalesce(F.col("_code"), F.lit(-1))).drop("_cv", "_code")


def basic_features(df: DataFrame) -> DataFrame:
    """FE1-FE4: latency approximations, throughput per user, load intensity."""
    new = {}
    if _has(df, "avg_response_time"):
        new["response_time_p95"] = F.col("avg_response_time") * 1.5
        new["response_time_p99"] = F.col("avg_response_time") * 2.0
        if _has(df, "max_response_time", "min_response_time"):
            new["response_time_variance"] = F.col("max_response_time") - F.col("min_response_time")
    if _has(df, "requests_per_sec", "concurrent_users"):
        new["throughput_per_user"] = div("requests_per_sec", "concurrent_users")
        if _has(df, "spawn_rate"):
            new["user_efficiency"] = div(new["throughput_per_user"], "spawn_rate")
    if _has(df, "concurrent_users", "duration", "spawn_rate"):
        new["load_intensity"] = div(F.col("concurrent_users") * F.col("spawn_rate"), "duration")
    return df.withColumns(new) if new else df


def load_features(df: DataFrame, st: FeatureStats, rank: bool = True) -> DataFrame:
    """FE5-FE8: peak ratio, users percentile, spawn efficiency, load category."""
    if not _has(df, "concurrent_users"):
        return df
    new: dict[str, Column] = {}
    mu = st.min_users
    new["peak_load_ratio"] = (F.col("concurrent_users") / F.lit(float(mu))
                              if mu is not None and mu > 0 else F.lit(1.0))
    if _has(df, "spawn_rate", "duration"):
        new["spawn_efficiency"] = div("concurrent_users", F.col("spawn_rate") * F.col("duration"))
    new["load_category"] = cut("concurrent_users", *LOAD_BINS)
    out = df.withColumns(new)
    if rank:
        out = average_rank_pct(out, "concurrent_users", "load_progression")
    return out


def reliability_features(df: DataFrame) -> DataFrame:
    """FE9-FE11: error percentage, reliability score, success/failure ratio, severity."""
    new = {}
    if _has(df, "error_rate"):
        new["error_rate_normalized"] = F.col("error_rate") * 100
        new["reliability_score"] = 100 - F.col("error_rate") * 100
    if _has(df, "total_requests", "total_failures"):
        new["success_rate"] = div(F.col("total_requests") - F.col("total_failures"), "total_requests")
        new["failure_ratio"] = div("total_failures", "total_requests")
    if _has(df, "error_rate"):
        new["error_severity"] = cut("error_rate", *ERROR_BINS)
    return df.withColumns(new) if new else df


def ratio_features(df: DataFrame, st: FeatureStats) -> DataFrame:
    """FE12-FE14: latency consistency/spread, throughput ratio, efficiency."""
    new = {}
    if _has(df, "avg_response_time", "max_response_time", "min_response_time"):
        new["response_time_consistency"] = div("min_response_time", "max_response_time")
        new["response_time_spread"] = div("max_response_time", "avg_response_time")
    if _has(df, "requests_per_sec", "concurrent_users"):
        mr = st.min_rps
        new["throughput_ratio"] = (F.col("requests_per_sec") / F.lit(float(mr))
                                   if mr is not None and mr > 0 else F.lit(1.0))
    if _has(df, "avg_response_time", "requests_per_sec"):
        new["performance_efficiency"] = div("requests_per_sec", "avg_response_time")
    return df.withColumns(new) if new else df


def time_features(df: DataFrame) -> DataFrame:
    """FE15-FE19: calendar features, epoch seconds, duration buckets."""
    new = {}
    if _has(df, "timestamp"):
        ts = F.col("timestamp")
        if dict(df.dtypes)["timestamp"] == "string":
            ts = F.try_to_timestamp(ts)
        else:
            ts = ts.cast("timestamp")
        hour = F.hour(ts)
        new["timestamp"] = ts
        new["hour_of_day"] = hour
        new["day_of_week"] = F.weekday(ts)
        new["is_weekend"] = F.coalesce(F.weekday(ts).isin(5, 6), F.lit(False)).cast("int")
        new["time_since_epoch"] = F.unix_seconds(ts)
        new["is_business_hours"] = F.coalesce((hour >= 9) & (hour <= 17), F.lit(False)).cast("int")
    if _has(df, "duration"):
        new["duration_minutes"] = F.col("duration") / 60.0
        new["duration_category"] = cut("duration", *DURATION_BINS)
    return df.withColumns(new) if new else df


def network_features(df: DataFrame, st: FeatureStats) -> DataFrame:
    """FE20-FE22: link speed, category code, network-weighted latency."""
    if not _has(df, "network_condition"):
        return df
    speeds = F.create_map(*[x for k, v in NETWORK_SPEED_MBPS.items() for x in (F.lit(k), F.lit(v))])
    mbps = F.element_at(speeds, F.col("network_condition"))
    out = df.withColumns({"network_speed_mbps": mbps, "network_speed_kbps": mbps * 1000})
    out = category_codes(out, "network_condition", "network_condition_encoded",
                         st.codes.get("network_condition"))
    if _has(df, "avg_response_time"):
        out = out.withColumn("network_performance_impact",
                             F.col("avg_response_time") * F.col("network_speed_mbps") / 50)
    return out


def frontend_features(df: DataFrame, st: FeatureStats) -> DataFrame:
    """FE21 (browser code), FE23-FE24: score categories, mean and spread."""
    new = {}
    for s in SCORE_COLUMNS:
        if _has(df, s):
            new[f"{s}_category"] = cut(F.coalesce(F.col(s), F.lit(0.5)), *SCORE_BINS)
    if _has(df, *SCORE_COLUMNS):
        filled = [F.coalesce(F.col(s), F.lit(0.5)) for s in SCORE_COLUMNS]
        new["overall_frontend_score"] = mean_of(filled)
        new["frontend_consistency"] = sample_std_of(filled)
    out = df.withColumns(new) if new else df
    if _has(df, "browser"):
        out = category_codes(out, "browser", "browser_encoded", st.codes.get("browser"))
    return out


def interaction_features(df: DataFrame, st: FeatureStats) -> DataFrame:
    """FE25-FE27: session duration, arrival rate, load share, intensity."""
    new = {}
    if _has(df, "concurrent_users", "spawn_rate", "duration"):
        new["user_session_duration"] = div("duration", "concurrent_users")
        new["user_arrival_rate"] = div("spawn_rate", "concurrent_users")
    if _has(df, "concurrent_users"):
        new["load_distribution"] = div(F.col("concurrent_users"),
                                       F.lit(None if st.max_users is None else float(st.max_users)))
    if _has(df, "concurrent_users", "duration", "requests_per_sec"):
        new["test_intensity"] = div(F.col("concurrent_users") * F.col("requests_per_sec"), "duration")
    return df.withColumns(new) if new else df


def complexity_features(df: DataFrame, st: FeatureStats) -> DataFrame:
    """FE28-FE30: endpoint count, payload size and class, resource complexity."""
    new = {}
    factors = []
    if _has(df, "api_endpoints"):
        new["endpoint_count"] = F.when(F.col("api_endpoints").isNotNull(),
                                       F.size("api_endpoints")).otherwise(F.lit(1))
        factors.append(new["endpoint_count"])
    if _has(df, "payload_size"):
        kb = (F.col("payload_size") / 1024.0) if st.payload_any else F.lit(0.0)
        new["payload_size_kb"] = kb
        new["payload_complexity"] = cut(kb, *PAYLOAD_BINS)
        factors.append(kb / 100)
    if factors:
        new["resource_complexity"] = mean_of(factors)
    return df.withColumns(new) if new else df


def engineer_features(df: DataFrame, st: FeatureStats | None = None) -> DataFrame:
    """All feature groups in the reference order, then the user's own (UX1); identity columns kept."""
    st = st or fit_feature_stats(df)
    out = basic_features(df)
    out = load_features(out, st)
    out = reliability_features(out)
    out = ratio_features(out, st)
    out = time_features(out)
    out = network_features(out, st)
    out = frontend_features(out, st)
    out = interaction_features(out, st)
    return apply_custom_features(complexity_features(out, st))


def feature_names(df: DataFrame) -> list[str]:
    """The columns that :func:`engineer_features` adds, by the schema alone: nothing is fitted or read."""
    nothing = FeatureStats(codes={})
    out = load_features(basic_features(df), nothing, rank=False)
    for group in (reliability_features, time_features):
        out = group(out)
    for group in (ratio_features, network_features, frontend_features, interaction_features, complexity_features):
        out = group(out, nothing)
    rank = ["load_progression"] if _has(df, "concurrent_users") else []
    return [c for c in out.columns if c not in df.columns] + rank


def feature_summary(df: DataFrame) -> DataFrame:
    """FE32: one row per column - kind, type, null count, engineered flag.

    Column kinds come from the schema; the null counts from one aggregate.
    """
    from pyspark.sql import types as T
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    base = set(BASE_FEATURES)
    rows = []
    for f in df.schema.fields:
        kind = ("numerical" if isinstance(f.dataType, T.NumericType)
                else "categorical" if isinstance(f.dataType, T.StringType) else "other")
        rows.append((f.name, kind, f.dataType.simpleString(), int(nulls[f.name]), f.name not in base))
    return df.sparkSession.createDataFrame(
        rows, "column string, kind string, data_type string, missing_values long, engineered boolean")
