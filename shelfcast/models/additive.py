"""Additive forecast per series: trend with changepoints, seasons, events and regressors.

Spark groups the observations by series and builds the design; the only Python is the solve of one
small penalised system per series and trial, fed by Arrow batches in the same stage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from statistics import NormalDist

from pyspark.sql import DataFrame, functions as F, types as T

from shelfcast.functions.metrics import clip_negative
from shelfcast.models import solve
from shelfcast.models.design import (
    ForecastConfig,
    design_matrix,
    series_rows,
    with_fold,
    with_future,
)
from shelfcast.models.simulate import simulated_interval
from shelfcast.operators.clean import stamp_run
from shelfcast.schema import ATTRIBUTES, SERIES
from shelfcast.session import materialise


def _with_priors(
    series: DataFrame,
    cfg: ForecastConfig,
    keys: Sequence[str],
    best: DataFrame | None,
    unique: bool,
) -> DataFrame:
    """Rows of the final fit, each with its series' priors."""
    rows = with_future(series_rows(series, cfg, keys, unique), cfg)
    cp, season = F.lit(cfg.changepoint_prior), F.lit(cfg.seasonality_prior)
    if best is not None:
        chosen = best.select(*keys, "changepoint_prior", "seasonality_prior")
        rows = rows.join(chosen, list(keys), "left")
        cp = F.coalesce("changepoint_prior", cp)
        season = F.coalesce("seasonality_prior", season)
    return rows.withColumns({"_cp_prior": cp, "_season_prior": season}).drop(
        "changepoint_prior", "seasonality_prior"
    )


def optimum(
    series: DataFrame,
    cfg: ForecastConfig,
    keys: Sequence[str] = SERIES,
    best: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """``settled`` and ``slope`` of the fit behind ``forecast``, for every series that is fitted.

    ``slope`` is the largest entry of the objective's relative gradient at the solution.
    """
    design = design_matrix(_with_priors(series, cfg, keys, best, unique), cfg).select(
        *keys, "y", "is_train", "x", "y_scale", "n_cp", "n_season", "_cp_prior", "_season_prior", "pos"
    )
    schema = T.StructType([design.schema[c] for c in keys])
    schema = schema.add("settled", "boolean").add("slope", "double")
    return design.mapInArrow(solve.optimum_batches(cfg.holidays_prior, list(keys)), schema)


def forecast(
    series: DataFrame,
    cfg: ForecastConfig,
    keys: Sequence[str] = SERIES,
    best: DataFrame | None = None,
    run_date: dt.date | None = None,
    unique: bool = False,
    draws: int = 0,
) -> DataFrame:
    """Fitted history and the next periods of every series, with an interval.

    The interval is analytic; with ``draws``, that of the next periods comes from so many simulated trends. Fits are
    written once for that.

    One model per series. ``best`` (keys, changepoint_prior, seasonality_prior) overrides the priors
    per series. A series with fewer than two training points gets their mean and a null interval.
    Forecasts below zero become zero.
    """
    rows = _with_priors(series, cfg, keys, best, unique)
    carried = [a for a in ATTRIBUTES if a in rows.columns and a not in keys]
    design = design_matrix(rows, cfg).select(
        *keys, *carried, "ds", "y", "is_train", *cfg.regressors, "t", "x", "y_scale",
        "n_cp", "n_season", "_cp_prior", "_season_prior", "pos",
    )
    kept = [*keys, *carried, "ds", "y", "is_train", *cfg.regressors, "t", "n_cp"]
    schema = T.StructType([design.schema[c] for c in kept])
    for name in ("yhat", "_spread", "_noise", "_bend"):
        schema = schema.add(name, "double")
    fitted = design.mapInArrow(solve.forecast_batches(cfg.holidays_prior, kept), schema)
    width = F.lit(NormalDist().inv_cdf(0.5 + cfg.interval_width / 2)) * F.col("_spread")
    bounded = fitted.withColumns(
        {"yhat_upper": F.col("yhat") + width, "yhat_lower": F.col("yhat") - width}
    )
    if draws:
        fitted = materialise(fitted)
        steps = fitted.filter("t > 1 AND _noise IS NOT NULL").select(
            *keys, "ds", "t", "yhat", F.col("_noise").alias("noise"), F.col("_bend").alias("bend"), F.col("n_cp").alias("rate")
        )
        drawn = simulated_interval(steps, keys, draws, cfg.interval_width)
        bounded = fitted.join(drawn, [*keys, "ds"], "left").withColumns(
            {
                "yhat_upper": F.coalesce("upper", F.col("yhat") + width),
                "yhat_lower": F.coalesce("lower", F.col("yhat") - width),
            }
        )
    columns = ["ds", *keys, *carried, *cfg.regressors, "y", "yhat", "yhat_upper", "yhat_lower"]
    return stamp_run(clip_negative(bounded).select(*columns, "is_train"), run_date)


def cross_validate(
    series: DataFrame,
    cfg: ForecastConfig,
    trials: Sequence[tuple[int, float, float]],
    cutoffs: Sequence[dt.date],
    horizon: int,
    keys: Sequence[str] = SERIES,
    unique: bool = False,
) -> DataFrame:
    """Test predictions of every trial (id, changepoint prior, seasonality prior) on every fold.

    Folds are rows: one task solves one series and cutoff, for all trials from one Gram matrix.
    """
    rows = with_fold(series_rows(series, cfg, keys, unique), cfg, cutoffs, horizon)
    design = design_matrix(rows, cfg).select(
        *keys, "cutoff", "ds", "y", "is_train", "x", "y_scale", "n_cp", "n_season", "pos"
    )
    kept = [*keys, "cutoff", "ds", "y"]
    schema = T.StructType([design.schema[c] for c in kept])
    schema = schema.add("trial_id", T.IntegerType()).add("yhat", "double")
    return design.mapInArrow(solve.test_batches(trials, cfg.holidays_prior, kept), schema)


def fold_errors(
    rows: DataFrame,
    cfg: ForecastConfig,
    trials: Sequence[tuple[int, float, float]],
    cutoffs: Sequence[dt.date],
    horizon: int,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """Test points ``n``, ``squares`` and ``sizes`` of their errors, summed by series, fold and trial.

    Takes the frame of ``series_rows``. A column ``_trials`` in it, numbers of trials, says which of them a
    series is fitted with; without it every series is fitted with all.
    """
    folded = with_fold(rows, cfg, cutoffs, horizon)
    listed = "_trials" in rows.columns
    columns = [*keys, "cutoff", "y", "is_train", "x", "y_scale", "n_cp", "n_season", "pos"]
    # The list travels once per series and fold, not once per point.
    design = design_matrix(folded, cfg).select(
        *columns, *([F.when(F.col("pos") == 0, F.col("_trials")).alias("_trials")] if listed else [])
    )
    kept = [*keys, "cutoff"]
    schema = T.StructType([design.schema[c] for c in kept])
    schema = schema.add("trial_id", T.IntegerType()).add("n", T.LongType())
    schema = schema.add("squares", "double").add("sizes", "double")
    return design.mapInArrow(solve.error_batches(trials, cfg.holidays_prior, kept), schema)


def apply_per_series(
    df: DataFrame,
    fn: Callable,
    schema: T.StructType | str,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """Run a pandas function on each series; ``fn(key, frame)`` returns a frame of ``schema``.

    The whole series is one call, so pass a series frame: at most one row per date and key.
    """
    return df.groupBy(*keys).applyInPandas(fn, schema)
