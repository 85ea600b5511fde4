"""Model families by name, their default parameters and how each is fitted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.models.extra_trees import fit_extra_trees
from riskspark.models.forest import fit_forests
from riskspark.models.ridge import fit_ridge
from riskspark.operators.statistics import grouped_medians

DEFAULT_MODEL = "extra_trees"

# Default parameters per family.
DEFAULT_PARAMS: dict[str, dict[str, Any]] = {
    "ridge_cv": {"alphas": (0.1, 1.0, 10.0)},
    "random_forest": {
        "n_estimators": 500,
        "max_depth": 8,
        "min_samples_leaf": 10,
        "max_features": 0.5,
        "random_state": 42,
    },
    "extra_trees": {
        "n_estimators": 500,
        "max_depth": 6,
        "min_samples_leaf": 2,
        "max_features": 1.0,
        "random_state": 42,
    },
}


def model_names() -> list[str]:
    return sorted(DEFAULT_PARAMS)


def model_params(
    name: str = DEFAULT_MODEL,
    seed: int | None = None,
    n_estimators: int | None = None,
    overrides: Mapping[str, Any] | None = None,
) -> dict[str, Any]:
    """Defaults of a family with seed, tree count and further values merged in."""
    if name not in DEFAULT_PARAMS:
        raise ValueError(f"unknown model {name!r}; choose from {model_names()}")
    params = dict(DEFAULT_PARAMS[name])
    asked = {"random_state": seed, "n_estimators": n_estimators}
    params |= {k: v for k, v in asked.items() if v is not None and k in params}
    params |= overrides or {}
    unknown = sorted(set(params) - set(DEFAULT_PARAMS[name]))
    if unknown:
        raise ValueError(f"unknown parameters of {name}: {', '.join(unknown)}")
    return params


def fit_models(
    name: str,
    df: DataFrame,
    features: Sequence[str],
    target: str,
    params: Mapping[str, Any],
    held_out: Sequence[int | None] = (None,),
) -> dict[int | None, Any]:
    """A fitted model per entry of ``held_out``: trained without that fold, or on all rows.

    ``df`` is a stored table with the features, the target and ``fold``.
    """

    def train_rows(fold):
        return df if fold is None else df.where(F.col("fold") != fold)

    if name in ("extra_trees", "random_forest"):
        others = {
            k: F.lit(True) if k is None else F.col("fold") != k for k in held_out
        }
        medians = grouped_medians(df, features, others)
        size = params["n_estimators"], params["max_depth"], params["min_samples_leaf"]
        if name == "random_forest":
            share, seed = params["max_features"], params["random_state"]
            return fit_forests(df, features, target, medians, *size, share, seed)
        if params["max_features"] != 1.0:
            raise ValueError("extra_trees looks at all features of a node")
        return fit_extra_trees(df, features, target, medians, *size, params["random_state"])
    if name == "ridge_cv":
        return {k: fit_ridge(train_rows(k), features, target, params["alphas"]) for k in held_out}
    raise ValueError(f"unknown model {name!r}; choose from {model_names()}")
