"""Registry of queries: key -> (Spark plan builder, DuckDB oracle SQL).

Each Spark builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame
(fitted constants may run small jobs while building).  Double outputs named
in ``rnd`` are rounded on both sides with the same IEEE steps
(``floor(x * 2^20 + 0.5) / 2^20``), so summation order does not decide the
comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.plans.views import with_views

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
# Rounding grid 2^-20 (~1e-6): decimal-valued data never sits exactly on a half step.
SCALE = 1048576


def _round_spark(df: DataFrame, rnd: Sequence[str]) -> DataFrame:
    if not rnd:
        return df
    scale = float(SCALE)

    def grid(c):
        x = F.col(c).cast("double")
        # |x| below 1e12 keeps x * 2^20 inside bigint (Spark's floor type); larger values stay as they are
        return F.when(F.abs(x) < 1e12, F.floor(x * scale + 0.5).cast("double") / scale).otherwise(x)
    return df.withColumns({c: grid(c) for c in rnd})


def _round_sql(sql: str, rnd: Sequence[str]) -> str:
    if not rnd:
        return sql
    scale = f"{SCALE}.0E0"
    rep = ", ".join(f"CASE WHEN abs(CAST({c} AS DOUBLE)) < 1e12 THEN floor(CAST({c} AS DOUBLE) * {scale} + 0.5E0) / {scale} "
                    f"ELSE CAST({c} AS DOUBLE) END AS {c}" for c in rnd)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


def register(key: str, sql: str | None = None, views: Sequence[str] = (), rnd: Sequence[str] = ()):
    def deco(fn):
        def run(spark, sf_dir, _fn=fn):
            return _round_spark(_fn(spark, sf_dir), rnd)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            inner = _round_sql(sql, rnd)
            ORACLE[key] = with_views(inner, *views)
        return fn
    return deco


def load_all() -> None:
    """Import every query module (each registers its keys)."""
    from loadlens.plans import q_features, q_insight, q_io, q_logs, q_models, q_plan, q_profile, q_quality, q_runs  # noqa: F401
