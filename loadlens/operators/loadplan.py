"""Load-configuration operators (LC1-LC10, W3, W6) as table operators.

The reference scores one configuration at a time inside a sequential
optimiser; here every candidate row (observed runs, a generated grid or a
model's predictions) is scored in parallel and the best one is a
``min_by`` aggregate, so the search is one pass.  Operators take the
predicted latency as a *column*, so any MLlib model (or a closed form)
can supply it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.operators.ordering import before, keys_at, running

# Thresholds of the load search and the risk assessment.
LATENCY_LIMIT_MS = 2000.0
ERROR_LIMIT = 0.05


def estimated_error_rate(users="concurrent_users", spawn="spawn_rate") -> Column:
    """err = max(0, users*spawn/1000 - 0.5) * 0.1."""
    return F.greatest(F.lit(0.0), F.col(users) * F.col(spawn) / 1000.0 - 0.5) * 0.1


def load_objective(latency: str = "predicted_latency", users="concurrent_users", spawn="spawn_rate",
                   latency_limit: float = LATENCY_LIMIT_MS, error_limit: float = ERROR_LIMIT) -> Column:
    """LC3: latency + 10*max(0, latency-limit) + 1000*max(0, err-limit)."""
    lat = F.col(latency)
    return (lat + F.greatest(F.lit(0.0), lat - latency_limit) * 10
            + F.greatest(F.lit(0.0), estimated_error_rate(users, spawn) - error_limit) * 1000)


def target_objective(target_latency: float = 1000, target_throughput: float = 100, max_error: float = 0.01,
                     latency: str = "predicted_latency", users="concurrent_users", spawn="spawn_rate") -> Column:
    """LC4: latency + penalties for latency, throughput shortfall and error."""
    lat = F.col(latency)
    tput = F.col(users) * F.col(spawn)
    return (lat + F.greatest(F.lit(0.0), lat - target_latency) * 10
            + F.greatest(F.lit(0.0), target_throughput - tput) * 5
            + F.greatest(F.lit(0.0), estimated_error_rate(users, spawn) - max_error) * 1000)


def meets_targets(target_latency: float = 1000, target_throughput: float = 100, max_error: float = 0.01,
                  latency: str = "predicted_latency", users="concurrent_users", spawn="spawn_rate") -> Column:
    return ((F.col(latency) <= target_latency) & (F.col(users) * F.col(spawn) >= target_throughput)
            & (estimated_error_rate(users, spawn) <= max_error))


def _ordered(df: DataFrame) -> list[str]:
    """The columns that have an order (maps and model vectors have none)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType, T.DatetimeType))]


def best_candidate(scored: DataFrame, objective: str = "objective",
                   tie_break: Sequence[str] = ("concurrent_users", "spawn_rate", "duration")) -> DataFrame:
    """LC5: the row with the smallest objective (ties: smaller load first).

    ``min_by`` over a struct is an algebraic aggregate: one pass, partial
    results per task, no sort of the candidates.  All other columns break the
    remaining ties.
    """
    cols = scored.columns
    order = F.struct(*dict.fromkeys([objective, *tie_break, *_ordered(scored)]))
    row = F.struct(*[F.col(c) for c in cols])
    return scored.agg(F.min_by(row, order).alias("b")).select("b.*")


def first_breach(scored: DataFrame, latency: str = "predicted_latency", tie_break: Sequence[str] = ()) -> DataFrame:
    """LC5 ``mode='first_breach'``: lightest load whose latency or error breaks a limit.

    Equal loads are told apart by ``tie_break`` and then by all other columns.
    """
    breach = (F.col(latency) > LATENCY_LIMIT_MS) | (estimated_error_rate() > ERROR_LIMIT)
    cand = scored.where(breach)
    order = F.struct((F.col("concurrent_users") * F.col("spawn_rate")).alias("load"),
                     *dict.fromkeys(["concurrent_users", "spawn_rate", "duration", *tie_break, *_ordered(scored)]))
    return cand.agg(F.min_by(F.struct(*[F.col(c) for c in scored.columns]), order).alias("b")).select("b.*")


def breaking_point(best: DataFrame, latency: str = "predicted_latency", objective: str = "objective") -> DataFrame:
    """LC5 record: load, predicted latency, throughput, error (rounded) and the breaking flag (on exact values)."""
    err = estimated_error_rate()
    return best.select(
        F.col("concurrent_users").cast("long").alias("concurrent_users"),
        F.round("spawn_rate", 2).alias("spawn_rate"), F.col("duration").cast("long").alias("duration"),
        F.round(latency, 2).alias("predicted_latency"),
        F.round(F.col("concurrent_users") * F.col("spawn_rate"), 2).alias("estimated_throughput"),
        F.round(err, 4).alias("estimated_error_rate"), F.round(objective, 2).alias("objective_value"),
        ((F.col(latency) > LATENCY_LIMIT_MS) | (err > ERROR_LIMIT)).alias("is_breaking_point"))


def load_recommendations(bp: DataFrame) -> DataFrame:
    """LC6: safe (x0.8, latency x0.7) and stress (x1.1, latency x1.2) loads."""
    def plan(kind, f_load, f_lat):
        return F.struct(F.lit(kind).alias("kind"),
                        (F.col("concurrent_users") * f_load).cast("long").alias("concurrent_users"),
                        F.round(F.col("spawn_rate") * f_load, 2).alias("spawn_rate"),
                        F.col("duration").alias("duration"),
                        F.round(F.col("predicted_latency") * f_lat, 2).alias("expected_latency"),
                        F.round(F.col("estimated_throughput") * f_load, 2).alias("expected_throughput"))
    return bp.select(F.explode(F.array(plan("safe_load", 0.8, 0.7), plan("stress_test", 1.1, 1.2))).alias("p")).select("p.*")


def recommendation_lines(bp: DataFrame, latency_limit: float = LATENCY_LIMIT_MS,
                         error_limit: float = ERROR_LIMIT) -> DataFrame:
    """LC6 text lines (one row per line)."""
    safe_u = (F.col("concurrent_users") * 0.8).cast("long")
    stress_u = (F.col("concurrent_users") * 1.1).cast("long")
    lines = F.array(
        F.format_string("Safe load: %d users at %s users/sec", safe_u, (F.col("spawn_rate") * 0.8).cast("string")),
        F.format_string("Stress test: %d users at %s users/sec", stress_u,
                        F.bround(F.col("spawn_rate") * 1.1, 2).cast("string")),
        F.format_string("Expected breaking point: %d users", F.col("concurrent_users")),
        F.lit(f"Monitor latency threshold: {latency_limit}ms"),
        F.lit(f"Monitor error rate threshold: {error_limit * 100}%"))
    return bp.select(F.posexplode(lines).alias("line_no", "line"))


# Risk recommendations, in rule order.
RISK_TEXT = {
    "high_concurrent_users": "Consider reducing concurrent users or running in stages",
    "high_spawn_rate": "Reduce spawn rate to avoid overwhelming the system",
    "long_duration": "Consider shorter test duration or monitoring intervals",
    "slow_network": "Test on faster network or adjust expectations",
    "high_predicted_latency": "System may not handle this load - reduce parameters",
}
SAFE_TEXT = "Configuration appears safe for testing"


def risk_flags(users="concurrent_users", spawn="spawn_rate", duration="duration",
               network_code="network_condition_encoded", latency="predicted_latency") -> dict[str, Column]:
    return {
        "high_concurrent_users": F.coalesce(F.col(users) > 500, F.lit(False)),
        "high_spawn_rate": F.coalesce(F.col(spawn) > 20, F.lit(False)),
        "long_duration": F.coalesce(F.col(duration) > 1800, F.lit(False)),
        "slow_network": F.coalesce(F.col(network_code) > 1, F.lit(False)),
        "high_predicted_latency": F.coalesce(F.col(latency) > LATENCY_LIMIT_MS, F.lit(False)),
    }


def assess_risk(df: DataFrame, prefix: str = "", **cols) -> DataFrame:
    """LC7: five risk flags, score = share of flags, level and recommendations."""
    flags = risk_flags(**cols)
    out = df.withColumns({f"{prefix}{k}": v for k, v in flags.items()})
    score = sum((F.col(f"{prefix}{k}").cast("int") for k in flags), F.lit(0)) / 5.0
    recs = F.filter(F.array(*[F.when(F.col(f"{prefix}{k}"), F.lit(t)) for k, t in RISK_TEXT.items()]),
                    lambda x: x.isNotNull())
    level = (F.when(score >= 0.8, "critical").when(score >= 0.6, "high")
              .when(score >= 0.4, "medium").otherwise("low"))
    return out.withColumns({f"{prefix}risk_score": score, f"{prefix}risk_level": level,
                            f"{prefix}recommendations": F.when(F.size(recs) == 0, F.array(F.lit(SAFE_TEXT)))
                            .otherwise(recs)})


def adjust_risk(df: DataFrame, target_level: str = "medium") -> DataFrame:
    """LC8: move a configuration toward ``target_level`` and reassess.

    critical/high: users x0.7, spawn x0.7, duration x0.8 on flagged fields;
    low: users x1.3, spawn x1.2.  The predicted latency column is reused.
    """
    a = assess_risk(df)
    lvl = F.col("risk_level")
    reduce = lvl.isin("critical", "high")
    grow = lvl == "low"
    needed = lvl != target_level
    users = (F.when(needed & reduce & F.col("high_concurrent_users"), (F.col("concurrent_users") * 0.7).cast("long"))
              .when(needed & grow, (F.col("concurrent_users") * 1.3).cast("long"))
              .otherwise(F.col("concurrent_users")))
    spawn = (F.when(needed & reduce & F.col("high_spawn_rate"), F.col("spawn_rate") * 0.7)
              .when(needed & grow, F.col("spawn_rate") * 1.2).otherwise(F.col("spawn_rate")))
    dur = (F.when(needed & reduce & F.col("long_duration"), (F.col("duration") * 0.8).cast("long"))
            .otherwise(F.col("duration")))
    adj = a.withColumns({"adjustments_needed": needed, "adjusted_users": users,
                         "adjusted_spawn_rate": spawn, "adjusted_duration": dur})
    return assess_risk(adj, prefix="adjusted_", users="adjusted_users", spawn="adjusted_spawn_rate",
                       duration="adjusted_duration")


def adaptive_plan(df: DataFrame, key: str = "test_id") -> DataFrame:
    """LC9: three phases per base configuration."""
    u, s = F.col("concurrent_users"), F.col("spawn_rate")
    phases = F.array(
        F.struct(F.lit(1).alias("phase"), F.lit("Baseline").alias("name"), F.least(u, F.lit(50)).alias("users"),
                 F.least(s, F.lit(2.0)).alias("spawn"), F.lit(300).alias("phase_duration"),
                 F.lit(0.8).alias("success_threshold")),
        F.struct(F.lit(2).alias("phase"), F.lit("Progressive Load").alias("name"),
                 (u * 0.7).cast("long").alias("users"), (s * 0.8).alias("spawn"),
                 F.lit(600).alias("phase_duration"), F.lit(0.7).alias("success_threshold")),
        F.struct(F.lit(3).alias("phase"), F.lit("Target Load").alias("name"), u.cast("long").alias("users"),
                 s.alias("spawn"), F.lit(900).alias("phase_duration"), F.lit(0.6).alias("success_threshold")))
    return df.select(key, F.explode(phases).alias("p")).select(key, "p.*")


def adaptation_actions(df: DataFrame, latency: str = "avg_response_time", error: str = "error_rate") -> DataFrame:
    """LC10: first matching adaptation rule per run and the next load."""
    lat, err = F.col(latency), F.col(error)
    r1, r2 = lat > 2000, err > 0.05
    r3 = (lat < 500) & (err < 0.01)
    action = (F.when(r1, "reduce_load").when(r2, "reduce_load").when(r3, "increase_load").otherwise("hold"))
    fu = F.when(r1, 0.8).when(r2, 0.7).when(r3, 1.2).otherwise(1.0)
    fs = F.when(r1, 0.8).when(r2, 0.7).when(r3, 1.1).otherwise(1.0)
    return df.withColumns({"action": action,
                           "next_users": (F.col("concurrent_users") * fu).cast("long"),
                           "next_spawn_rate": F.col("spawn_rate") * fs})


def best_so_far(df: DataFrame, objective: str, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Running minimum of the objective in iteration order per search."""
    return running(df, order, by, {"best_so_far": ("min", objective)})


def fold_bounds(df: DataFrame, order: Sequence[str], n_splits: int = 5) -> list[tuple]:
    """The order keys (begin, end) of each fold's test rows; None as end is the end of the table.

    Test size is n // (n_splits + 1); fold i trains on the first
    n - (n_splits - i) * test_size rows and tests on the next test_size.
    Rows that tie on the whole key stay on one side of a bound.
    """
    n = df.count()
    size = n // (n_splits + 1)
    if not size:
        return []
    starts = [n - (n_splits - i) * size for i in range(n_splits)]
    keys = keys_at(df, order, starts)
    found = [keys[s] for s in starts]
    return list(zip(found, [*found[1:], None]))


def timeseries_folds(df: DataFrame, order: Sequence[str], n_splits: int = 5) -> DataFrame:
    """Expanding-window folds; rows (fold, train_rows, test_rows, test_start, test_end), counted by the folds' predicates."""
    bounds = fold_bounds(df, order, n_splits)
    aggs = []
    for i, (begin, end) in enumerate(bounds):
        train = before(order, begin)
        aggs += [F.count_if(train).alias(f"tr{i}"), F.count_if(~train & before(order, end)).alias(f"te{i}")]
    r = df.agg(*aggs).first() if aggs else {}
    rows = [(i, r[f"tr{i}"], r[f"te{i}"], r[f"tr{i}"], r[f"tr{i}"] + r[f"te{i}"] - 1) for i in range(len(bounds))]
    return df.sparkSession.createDataFrame(rows, "fold int, train_rows long, test_rows long, test_start long, test_end long")


# The configuration grid.
API_LOADS = [(10, 1.0), (50, 2.0), (100, 5.0), (200, 10.0), (500, 20.0)]
API_NETWORKS = ["wifi", "4g", "3g"]
API_ENDPOINTS = ["/api/health", "/api/data/test", "/api/search?q=performance", "/api/users?page=1&limit=10",
                 "/api/upload", "/api/slow", "/api/memory"]
FRONTEND_BROWSERS = ["chrome", "firefox", "safari"]
FRONTEND_NETWORKS = ["wifi", "4g", "slow_3g"]
FRONTEND_PAGES = ["/", "/?heavy=true"]
LOAD_SCENARIOS = [(10, 1.0, 120), (50, 2.0, 300), (100, 5.0, 600), (200, 10.0, 900), (500, 20.0, 1200)]
STRESS_SCENARIOS = [(1000, 50.0, 1800), (2000, 100.0, 2400), (5000, 200.0, 3600)]


def config_grid(spark: SparkSession, base_url: str = "http://localhost:5000") -> DataFrame:
    """LC1: the 131-row configuration grid (U1 of four families).

    Each family is a chain of ``explode`` over its literal dimension lists;
    ids follow the reference's formats.
    """
    one = spark.range(1)

    def lit_array(rows):
        return F.array(*[F.struct(*[F.lit(v).alias(f"c{i}") for i, v in enumerate(r)]) for r in rows])
    api = (one.select(F.explode(lit_array(API_LOADS)).alias("l"))
              .select("l", F.explode(F.array(*[F.lit(n) for n in API_NETWORKS])).alias("net"))
              .select("l", "net", F.explode(F.array(*[F.lit(e) for e in API_ENDPOINTS])).alias("ep")))
    api = api.select(
        F.format_string("api_%du_%s_%s", "l.c0", "net", F.regexp_replace("ep", "/", "_")).alias("test_id"),
        F.lit("api").alias("test_type"), F.col("l.c0").cast("long").alias("concurrent_users"),
        F.col("l.c1").cast("double").alias("spawn_rate"), F.lit(300).cast("long").alias("duration"),
        F.col("net").alias("network_condition"), F.lit(None).cast("string").alias("browser"),
        F.array("ep").alias("api_endpoints"), F.concat(F.lit(base_url), "ep").alias("target_url"))
    front = (one.select(F.explode(F.array(*[F.lit(b) for b in FRONTEND_BROWSERS])).alias("browser"))
                .select("browser", F.explode(F.array(*[F.lit(n) for n in FRONTEND_NETWORKS])).alias("net"))
                .select("browser", "net", F.explode(F.array(*[F.lit(p) for p in FRONTEND_PAGES])).alias("page")))
    front = front.select(
        F.format_string("frontend_%s_%s_%s", "browser", "net", F.regexp_replace("page", "/", "_")).alias("test_id"),
        F.lit("frontend").alias("test_type"), F.lit(1).cast("long").alias("concurrent_users"),
        F.lit(0.1).alias("spawn_rate"), F.lit(60).cast("long").alias("duration"),
        F.col("net").alias("network_condition"), "browser",
        F.lit(None).cast("array<string>").alias("api_endpoints"), F.concat(F.lit(base_url), "page").alias("target_url"))

    def scen(rows, kind):
        d = one.select(F.explode(lit_array(rows)).alias("s"))
        return d.select(F.format_string(f"{kind}_%du_%ss", "s.c0", F.col("s.c1").cast("double").cast("string")).alias("test_id"),
                        F.lit(kind).alias("test_type"), F.col("s.c0").cast("long").alias("concurrent_users"),
                        F.col("s.c1").cast("double").alias("spawn_rate"), F.col("s.c2").cast("long").alias("duration"),
                        F.lit("wifi").alias("network_condition"), F.lit(None).cast("string").alias("browser"),
                        F.array(*[F.lit(e) for e in API_ENDPOINTS]).alias("api_endpoints"),
                        F.lit(base_url).alias("target_url"))
    return (api.unionByName(front).unionByName(scen(LOAD_SCENARIOS, "load"))
               .unionByName(scen(STRESS_SCENARIOS, "stress")))


def candidate_grid(spark: SparkSession, users=(10, 1000, 10), spawn=(0.5, 50.0, 0.5),
                   duration=(300, 3600, 300), num_partitions: int | None = None) -> DataFrame:
    """LC2: every (users, spawn, duration) step of the bounds, generated in parallel.

    ``spark.range`` over the users steps is split across tasks; the other
    dimensions are ``sequence`` + ``explode`` inside each task.
    """
    n_users = int(round((users[1] - users[0]) / users[2])) + 1
    n_spawn = int(round((spawn[1] - spawn[0]) / spawn[2])) + 1
    base = spark.range(0, n_users, 1, num_partitions).select(
        (F.lit(users[0]) + F.col("id") * users[2]).cast("long").alias("concurrent_users"))
    return (base.select("concurrent_users",
                        F.explode(F.sequence(F.lit(0), F.lit(n_spawn - 1))).alias("_s"))
                .select("concurrent_users", (F.lit(spawn[0]) + F.col("_s") * spawn[2]).alias("spawn_rate"),
                        F.explode(F.sequence(F.lit(int(duration[0])), F.lit(int(duration[1])),
                                             F.lit(int(duration[2]))).cast("array<bigint>")).alias("duration")))


def config_counts(configs: DataFrame) -> DataFrame:
    """Number of configurations per test type."""
    return configs.groupBy("test_type").agg(F.count("*").alias("configs"))
