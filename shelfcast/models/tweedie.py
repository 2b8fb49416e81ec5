"""Tweedie regression over all series as one distributed model.

Store and product enter through their mean sales in the training window, so the number of features
does not grow with the number of stores or products.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    GeneralizedLinearRegression,
    GeneralizedLinearRegressionModel,
)
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from shelfcast.fixed_values import (
    TWEEDIE_DRAWS,
    TWEEDIE_FOLDS,
    TWEEDIE_LOCKDOWNS,
    TWEEDIE_POWER,
    TWEEDIE_SEED,
    TWEEDIE_TRAIN_END,
    TWEEDIE_VALID_FROM,
)
from shelfcast.functions.calendar import calendar_features
from shelfcast.functions.metrics import cv_metrics
from shelfcast.operators.clean import stamp_run
from shelfcast.operators.folds import time_series_folds
from shelfcast.session import materialise

# What the random search draws from: the strength of the ridge. None is zero, so every fit has one answer.
RIDGE = tuple(10.0 ** (e / 2) for e in range(-10, 1))
MOST_ITERATIONS = 25  # a fit that takes more has not settled
# Of the coefficients, where iterations end.  Each squares the error, so the last leaves far less than this; a smaller
# one would be below the rounding of sums over many rows, whose order is left to the tasks.
TOLERANCE = 1e-8
FITS_AT_ONCE = 4
SAME = 1e-9  # share of a feature's variance that others must leave unexplained for it to be kept


@dataclasses.dataclass(frozen=True)
class TweedieConfig:
    power: float = TWEEDIE_POWER
    train_end: dt.date = TWEEDIE_TRAIN_END
    valid_from: dt.date = TWEEDIE_VALID_FROM
    folds: int = TWEEDIE_FOLDS
    draws: int = TWEEDIE_DRAWS
    seed: int = TWEEDIE_SEED
    regressors: tuple[str, ...] = ("black_week",)
    lockdowns: tuple[tuple[str, dt.date, dt.date], ...] = TWEEDIE_LOCKDOWNS


def tag_split(
    df: DataFrame,
    train_end: dt.date = TWEEDIE_TRAIN_END,
    valid_from: dt.date = TWEEDIE_VALID_FROM,
    date: str = "ds",
) -> DataFrame:
    """Flags ``is_train``, ``is_valid`` (the part of train after ``valid_from``) and ``is_predict``."""
    train = F.col(date) <= F.lit(train_end)
    return df.withColumns(
        {
            "is_train": train,
            "is_valid": train & (F.col(date) > F.lit(valid_from)),
            "is_predict": F.col(date) > F.lit(train_end),
        }
    )


def draws(cfg: TweedieConfig) -> list[float]:
    """Distinct draws from the search space, the same for every run with the same seed."""
    return random.Random(cfg.seed).sample(RIDGE, min(cfg.draws, len(RIDGE)))


def features(
    df: DataFrame,
    train: DataFrame,
    cfg: TweedieConfig,
    keys: Sequence[str] = ("store", "business_unit"),
) -> tuple[DataFrame, list[str]]:
    """``df`` with the feature columns, and their names; the means of the keys come from ``train`` alone.

    The level of a key is how far the logarithm of its mean lies above that of the whole; an unknown key has zero.
    """
    with_dates = calendar_features(df, cfg.lockdowns)
    whole = train.agg(F.log(F.avg("y") + 1).alias("m")).scalar()
    for key in keys:
        means = train.groupBy(key).agg(F.log(F.avg("y") + 1).alias(f"{key}_level"))
        with_dates = with_dates.join(means, key, "left")
    filled = with_dates.withColumn("_level", whole)
    # About the level of the whole, as the logarithm grows with the sales and a column far from zero beside its spread is
    # nearly a copy of the intercept: the rounding of its products would keep the fits from settling.
    level = F.coalesce("_level", F.lit(0.0))
    columns = {f"{key}_level": F.coalesce(f"{key}_level", level) - level for key in keys}
    columns |= {r: F.coalesce(F.col(r).cast("double"), F.lit(0.0)) for r in cfg.regressors}
    columns |= {f"month_{m}": (F.col("month") == m).cast("double") for m in range(2, 13)}
    # Centred, so that the intercept and the trend are not two copies of one column.
    columns["year_centred"] = (F.col("year") - cfg.train_end.year).cast("double")
    columns["corona_lockdown"] = F.col("corona_lockdown").cast("double")
    names = list(columns)
    return filled.withColumns(columns | {"y": F.col("y").cast("double")}), names


def independent(train: DataFrame, names: Sequence[str]) -> list[str]:
    """The names, in order, of the features that are not constant and not a combination of those before.

    One aggregation gives the sums of products, as many as pairs of features however many rows there are.
    """
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    sums = [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i, j in pairs]
    means = [F.avg(n).alias(f"m{i}") for i, n in enumerate(names)]
    row = train.agg(F.count("*").alias("n"), *means, *sums).first()
    if not row["n"]:
        return []
    center = np.array([row[f"m{i}"] for i in range(len(names))])
    spread = np.zeros((len(names), len(names)))
    for i, j in pairs:
        spread[i, j] = spread[j, i] = row[f"p{i}_{j}"] - row["n"] * center[i] * center[j]
    kept: list[int] = []
    for i in range(len(names)):
        own = spread[i, i]
        left = own
        if kept:
            left -= spread[i, kept] @ np.linalg.solve(spread[np.ix_(kept, kept)], spread[kept, i])
        if own > SAME * row["n"] and left > SAME * own:
            kept.append(i)
    return [names[i] for i in kept]


def assembled(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="error").transform(wide)


class NotSettled(ArithmeticError):
    """A fit that has not settled within ``MOST_ITERATIONS``."""


def _fit(train: DataFrame, cfg: TweedieConfig, ridge: float) -> GeneralizedLinearRegressionModel:
    model = GeneralizedLinearRegression(
        family="tweedie",
        variancePower=cfg.power,
        linkPower=0.0,
        regParam=ridge,
        maxIter=MOST_ITERATIONS,
        tol=TOLERANCE,
        labelCol="y",
        predictionCol="y_prediction",
    ).fit(train.select("features", "y"))
    if model.summary.numIterations >= MOST_ITERATIONS:
        raise NotSettled(f"the fit with ridge {ridge} has not settled")
    return model


def search(
    train: DataFrame, cfg: TweedieConfig, keys: Sequence[str] = ("store", "business_unit")
) -> list[tuple[float, float]]:
    """Cross-validated (rmse, ridge) of every draw, best first; a draw with a fit that does not settle comes last.

    The folds are written once; one of them is held in memory at a time, for all draws, of which a few are fitted
    at once. The loop is over the handful of draws and folds; each fit and score in it is a distributed job.
    """
    tagged = materialise(time_series_folds(train, cfg.folds, keys))
    squares = dict.fromkeys(draws(cfg), 0.0)
    tested = 0
    for fold in range(cfg.folds):
        rows = tagged.filter(F.col("fold") == fold)
        wide, names = features(rows, rows.filter(F.col("role") == "train"), cfg, keys)
        wide = materialise(wide.select("y", "role", *names))
        wide = assembled(wide, independent(wide.filter("role = 'train'"), names))
        wide = wide.select("y", "role", "features").persist(StorageLevel.MEMORY_AND_DISK)
        known, asked = wide.filter("role = 'train'"), wide.filter("role = 'test'")

        def lost(ridge: float) -> float:
            gap = F.col("y") - F.col("y_prediction")
            try:
                scored = _fit(known, cfg, ridge).transform(asked)
            except NotSettled:
                return math.inf
            return scored.agg(F.sum(gap * gap)).first()[0] or 0.0

        try:
            tested += asked.count()  # the first action, so that the rows are held once
            with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
                for ridge, found in zip(squares, list(pool.map(lost, squares)), strict=True):
                    squares[ridge] += found
        finally:
            wide.unpersist()
    return sorted((math.sqrt(s / max(tested, 1)), ridge) for ridge, s in squares.items())


def _trained(
    tagged: DataFrame, cfg: TweedieConfig, keys: Sequence[str], ridge: float
) -> tuple[DataFrame, GeneralizedLinearRegressionModel, list[str]]:
    """Assembled rows, written once, and the model of those that train."""
    wide, names = features(tagged, tagged.filter("is_train"), cfg, keys)
    wide = materialise(wide)
    names = independent(wide.filter("is_train"), names)
    wide = assembled(wide, names)
    return wide, _fit(wide.filter("is_train"), cfg, ridge), names


def tweedie_forecast(
    series: DataFrame,
    cfg: TweedieConfig | None = None,
    keys: Sequence[str] = ("store", "business_unit"),
    ridge: float | None = None,
    run_date: dt.date | None = None,
) -> DataFrame:
    """Predictions after the training end, by the best draw of the search or by a given ``ridge``.

    The series frame and its features are written once to the checkpoint folder, as the fits read them again
    and again.
    """
    cfg = cfg or TweedieConfig()
    tagged = materialise(tag_split(series, cfg.train_end, cfg.valid_from))
    if ridge is None:
        train = tagged.filter("is_train").drop("is_train", "is_valid", "is_predict")
        ridge = search(train, cfg, keys)[0][1]
    wide, model, _ = _trained(tagged, cfg, keys, ridge)
    predicted = model.transform(wide.filter("is_predict"))
    columns = ["ds", *keys, *cfg.regressors, "y", "y_prediction"]
    return stamp_run(predicted.select(*columns), run_date)


def optimum(
    series: DataFrame, cfg: TweedieConfig, ridge: float, keys: Sequence[str] = ("store", "business_unit")
) -> DataFrame:
    """``parameter`` and ``score``: the penalised likelihood's derivatives at the fit, zero at the optimum.

    A row for the intercept and each feature that is kept, in units of the mean weight of a row.
    """
    tagged = materialise(tag_split(series, cfg.train_end, cfg.valid_from))
    wide, model, names = _trained(tagged, cfg, keys, ridge)
    rows = model.transform(wide.filter("is_train"))
    pull = (F.col("y") - F.col("y_prediction")) * F.pow("y_prediction", F.lit(1.0 - cfg.power))
    weight = F.avg(F.pow("y_prediction", F.lit(2.0 - cfg.power)))
    slopes = dict(zip(names, model.coefficients.toArray().tolist()))
    scores = [(F.avg(pull) / weight).alias("intercept")]
    scores += [(F.avg(pull * F.col(n)) / weight - F.lit(ridge * slopes[n])).alias(n) for n in names]
    return rows.agg(*scores).unpivot([], ["intercept", *names], "parameter", "score")


def validation_score(series: DataFrame, cfg: TweedieConfig, ridge: float) -> DataFrame:
    """RMSE on the validation months, which lie inside the training window."""
    tagged = tag_split(series, cfg.train_end, cfg.valid_from).filter("is_train")
    wide, model, _ = _trained(tagged, cfg, ("store", "business_unit"), ridge)
    scored = model.transform(wide.filter("is_valid"))
    return cv_metrics(scored.withColumnRenamed("y_prediction", "yhat"), [])
