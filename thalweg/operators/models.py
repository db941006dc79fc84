"""Regressors for level differences; each kind fits all stations and horizons in one job.

``RandomForestRegressor_001`` and ``XGBoost_001`` are ensembles of trees (``operators.trees``), a row
per tree.  ``Prophet_001`` is an additive model, flat in trend, with yearly seasonality and all
features as linear regressors: each group's cross products are summed on the map side and one small
system is solved per group.  A fitted model of any kind is a table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thalweg.functions.dates import fourier_terms
from thalweg.operators import trees as tree_tables
from thalweg.operators.evaluation import linear_score
from thalweg.operators.features import feature_vector

KEYS = ("location", "forecast_days")
COEFFICIENTS = "location string, forecast_days int, rows long, intercept double, weights array<double>"


# --- tree ensembles


def fit_forest(train: DataFrame, trees: int = 100, depth: int = 30, min_leaf: int = 5, seed: int = 0) -> DataFrame:
    """A random forest per station and horizon, as a table of trees."""
    return tree_tables.fit(train, feature_vector(), tree_tables.forest, seed, trees=trees, depth=depth, min_leaf=min_leaf)


def forest_predict(trees: DataFrame, rows: DataFrame) -> DataFrame:
    """``y`` and ``y_var``, the mean squared distance of the single trees from it."""
    return tree_tables.predict(trees, rows, feature_vector(), mean=True)


def fit_boosted(train: DataFrame, rounds: int = 1000, depth: int = 7, step: float = 0.1, rows: float = 0.7, columns: float = 0.8, seed: int = 0) -> DataFrame:
    """Boosted trees per station and horizon, on samples of rows and columns, as a table of trees."""
    return tree_tables.fit(train, feature_vector(), tree_tables.boosted, seed, rounds=rounds, depth=depth, step=step, rows=rows, columns=columns)


def boosted_predict(trees: DataFrame, rows: DataFrame) -> DataFrame:
    return tree_tables.predict(trees, rows, feature_vector(), mean=False)


def save_trees(trees: DataFrame, path: str) -> None:
    """One folder per station, so that a station's trees can be read alone."""
    trees.write.mode("overwrite").partitionBy("location").parquet(path)


def load_trees(spark: SparkSession, path: str) -> DataFrame:
    names = [f.split()[0] for f in tree_tables.TREES.split(", ")]
    return spark.read.schema(tree_tables.TREES).parquet(path).select(*names)


# --- additive model


def with_design(rows: DataFrame, order: int = 10) -> DataFrame:
    """Features, date features and yearly terms as one array."""
    yearly = F.array(*fourier_terms("date", order).values())
    return rows.withColumn("x", F.concat(feature_vector(), yearly))


def _cross_products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch and group the matrix of sums of products of (1, x, y)."""
    for pdf in batches:
        out = []
        for key, part in pdf.groupby(list(KEYS), sort=False):
            x = np.vstack(part["x"].to_numpy())
            a = np.column_stack([np.ones(len(part)), x, part["y"].to_numpy()])
            out.append((*key, (a.T @ a).ravel()))
        yield pd.DataFrame(out, columns=[*KEYS, "g"])


def _solver(ridge: float):
    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum(np.vstack(pdf["g"].to_numpy()), axis=0)
        size = int(round(len(total) ** 0.5))
        g = total.reshape(size, size)
        n = g[0, 0]
        mean = g[0, 1:] / n
        c = g[1:, 1:] - n * np.outer(mean, mean)
        spread = np.sqrt(np.maximum(np.diag(c)[:-1], 0.0))
        # A column without spread beyond rounding carries nothing and gets no weight.
        used = spread > 1e-9 * np.sqrt(np.maximum(np.diag(g)[1:-1], 1e-300))
        weights = np.zeros(size - 2)
        if used.any():
            s = spread[used] / np.sqrt(n)
            z = c[:-1, :-1][np.ix_(used, used)] / np.outer(s, s)
            weights[used] = np.linalg.solve(z + ridge * np.eye(int(used.sum())), c[:-1, -1][used] / s) / s
        intercept = mean[-1] - weights @ mean[:-1]
        return pd.DataFrame([(*key, int(n), float(intercept), weights)], columns=[*KEYS, "rows", "intercept", "weights"])

    return solve


def fit_additive(train: DataFrame, ridge: float = 1.0, order: int = 10) -> DataFrame:
    """Coefficients per (location, forecast_days) from rows with those two columns, features and y.

    Rows are reduced where they lie: a task sends one square matrix per batch and group, as wide as
    the model has terms, and never a row.
    """
    design = with_design(train, order).filter(F.col("y").isNotNull()).select(*KEYS, "x", "y")
    sums = design.mapInPandas(_cross_products, "location string, forecast_days int, g array<double>")
    return sums.groupBy(*KEYS).applyInPandas(_solver(ridge), COEFFICIENTS)


def additive_predict(coefficients: DataFrame, rows: DataFrame, order: int = 10) -> DataFrame:
    """``y`` for rows with (location, forecast_days), by a join with the coefficients."""
    known = coefficients.select(*KEYS, "intercept", "weights")
    scored = with_design(rows.drop("y"), order).join(known, list(KEYS))
    dot = F.aggregate(F.zip_with("x", "weights", lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    return scored.withColumn("y", F.col("intercept") + dot).drop("x", "intercept", "weights")


def save_additive(coefficients: DataFrame, path: str) -> None:
    coefficients.write.mode("overwrite").parquet(path)


def load_additive(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COEFFICIENTS).parquet(path)


# --- registry


@dataclass(frozen=True)
class ModelKind:
    """How one kind of model is fitted, applied, stored and read back; models are tables by (location, forecast_days)."""

    fit: Callable[..., DataFrame]
    predict: Callable[[DataFrame, DataFrame], DataFrame]
    save: Callable[[DataFrame, str], None]
    load: Callable[[SparkSession, str], DataFrame]


# The names model files and stored predictions carry.
REGISTRY: dict[str, ModelKind] = {
    "RandomForestRegressor_001": ModelKind(fit_forest, forest_predict, save_trees, load_trees),
    "XGBoost_001": ModelKind(fit_boosted, boosted_predict, save_trees, load_trees),
    "Prophet_001": ModelKind(fit_additive, additive_predict, save_additive, load_additive),
}


def model_kind(name: str) -> ModelKind:
    if name not in REGISTRY:
        raise ValueError(f"unknown model type {name!r}, expected one of {sorted(REGISTRY)}")
    return REGISTRY[name]


def model_path(root: str, kind: str) -> str:
    return f"{root.rstrip('/')}/type={kind}"


def predictor(kind: str, fitted: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A predictor over rows of any number of stations and horizons."""
    return lambda rows: model_kind(kind).predict(fitted, rows)


def linear_predictor(names: Sequence[str], coefficients: dict[str, float], intercept: float = 0.0) -> Callable[[DataFrame], DataFrame]:
    """A fixed linear model over features in the order of ``names``; for checks."""
    return lambda rows: rows.drop("y").withColumn("y", linear_score(names, coefficients, intercept))
