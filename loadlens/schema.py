"""Fixed schemas of the run table and the configuration record."""

from __future__ import annotations

from pyspark.sql import types as T

# Identity fields kept out of the metadata JSON, required fields,
# and the 22 base column names of a run (anything else is "engineered").
REQUIRED_FIELDS = ["test_id", "test_type", "timestamp"]
METADATA_EXCLUDED = ["test_id", "test_type", "timestamp", "status", "error"]
BASE_FEATURES = [
    "test_id", "test_type", "timestamp", "total_requests", "total_failures",
    "error_rate", "avg_response_time", "max_response_time", "min_response_time",
    "requests_per_sec", "concurrent_users", "spawn_rate", "duration",
    "network_condition", "browser", "target_url", "performance_score",
    "accessibility_score", "best_practices_score", "seo_score", "status", "error",
]
SCORE_COLUMNS = ["performance_score", "accessibility_score", "best_practices_score", "seo_score"]

# Enum domains of a configuration.
NETWORK_CONDITIONS = ["wifi", "4g", "3g", "slow_3g"]
BROWSERS = ["chrome", "firefox", "safari", "edge"]
TEST_TYPES = ["api", "frontend", "load", "stress"]

RUN_SCHEMA = T.StructType([
    T.StructField("test_id", T.StringType()),
    T.StructField("test_type", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("total_requests", T.LongType()),
    T.StructField("total_failures", T.LongType()),
    T.StructField("error_rate", T.DoubleType()),
    T.StructField("avg_response_time", T.DoubleType()),
    T.StructField("max_response_time", T.DoubleType()),
    T.StructField("min_response_time", T.DoubleType()),
    T.StructField("requests_per_sec", T.DoubleType()),
    T.StructField("concurrent_users", T.LongType()),
    T.StructField("spawn_rate", T.DoubleType()),
    T.StructField("duration", T.LongType()),
    T.StructField("network_condition", T.StringType()),
    T.StructField("browser", T.StringType()),
    T.StructField("target_url", T.StringType()),
    T.StructField("performance_score", T.DoubleType()),
    T.StructField("accessibility_score", T.DoubleType()),
    T.StructField("best_practices_score", T.DoubleType()),
    T.StructField("seo_score", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])

CONFIG_SCHEMA = T.StructType([
    T.StructField("test_id", T.StringType()),
    T.StructField("test_type", T.StringType()),
    T.StructField("concurrent_users", T.LongType()),
    T.StructField("spawn_rate", T.DoubleType()),
    T.StructField("duration", T.LongType()),
    T.StructField("network_condition", T.StringType()),
    T.StructField("browser", T.StringType()),
    T.StructField("api_endpoints", T.ArrayType(T.StringType())),
    T.StructField("custom_headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload_size", T.LongType()),
    T.StructField("target_url", T.StringType()),
])

LOAD_STATS_SCHEMA = T.StructType([
    T.StructField("request_count", T.LongType()),
    T.StructField("failure_count", T.LongType()),
    T.StructField("avg_response_time", T.DoubleType()),
    T.StructField("max_response_time", T.DoubleType()),
    T.StructField("min_response_time", T.DoubleType()),
    T.StructField("requests_per_sec", T.DoubleType()),
])


def numeric_columns(df, exclude=()) -> list[str]:
    """Names of numeric columns (schema only, no job)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in ex]
