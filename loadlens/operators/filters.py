"""Row and column filters used before modelling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.schema import SCORE_COLUMNS, numeric_columns

# Columns never used as model features.
NON_FEATURES = ["id", "test_id", "timestamp", "status", "error"]


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """drop rows with a null in any of ``columns``."""
    return df.na.drop(how="any", subset=list(columns))


def require_target(df: DataFrame, target: str) -> DataFrame:
    """drop rows with a missing target."""
    return df.where(F.col(target).isNotNull())


def sparse_columns(df: DataFrame, columns: Sequence[str], min_share: float = 0.5) -> list[str]:
    """F8: columns with fewer than ``min_share`` non-null values (one aggregate)."""
    if not columns:
        return []
    r = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if r[c] < min_share * r["_n"]]


def mean_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """replace nulls by the column mean (one aggregate, literals)."""
    if not columns:
        return df
    r = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(r[c])) for c in columns
                           if r[c] is not None})


def feature_columns(df: DataFrame, target: str | None = None, exclude: Sequence[str] = ()) -> list[str]:
    """numeric columns minus identity/target columns."""
    return numeric_columns(df, exclude=[*NON_FEATURES, *(x for x in [target] if x), *exclude])


def fill_scores(df: DataFrame, value: float = 0.5) -> DataFrame:
    """constant fill of the audit scores."""
    return df.withColumns({s: F.coalesce(F.col(s), F.lit(value)) for s in SCORE_COLUMNS if s in df.columns})


def frame_problem(df: DataFrame, target: str, exclude: Sequence[str] = (), keep: Sequence[str] = ("test_id",)):
    """M1 framing: F7 + F10 + F9 -> (frame with keep + features + target, feature names)."""
    d = require_target(df, target)
    feats = feature_columns(d, target, exclude)
    d = mean_impute(d, feats)
    return d.select(*[k for k in keep if k in d.columns], *feats, target), feats
