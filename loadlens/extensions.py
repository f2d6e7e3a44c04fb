"""User extension points (UX1-UX3).

* UX1 custom feature functions: any ``DataFrame -> DataFrame`` registered
  here is applied by ``engineer_features`` after the built-in groups, with
  ``df.transform``;
* UX2 custom models: any MLlib ``Estimator`` factory added to the menu;
* UX3 custom objectives: a function returning a ``Column`` - the load
  search (:func:`loadplan.best_candidate`) minimises whatever column it
  is given, so no other change is needed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

FEATURE_FUNCTIONS: dict[str, Callable[[DataFrame], DataFrame]] = {}
CUSTOM_MODELS: dict[str, dict[str, Callable]] = {"regression": {}, "classification": {}}


def register_feature(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    FEATURE_FUNCTIONS[name] = fn


def apply_custom_features(df: DataFrame) -> DataFrame:
    for fn in FEATURE_FUNCTIONS.values():
        df = df.transform(fn)
    return df


def register_model(problem: str, name: str, factory: Callable) -> None:
    CUSTOM_MODELS[problem][name] = factory


def models_for(problem: str) -> dict[str, Callable]:
    """The model menu of a problem, which holds the registered models."""
    from loadlens.operators.models import model_menu
    return model_menu(problem)


def score_with(df: DataFrame, objective: Callable[[], Column], name: str = "objective") -> DataFrame:
    """UX3: add a custom objective column for the load search."""
    return df.withColumn(name, objective())
