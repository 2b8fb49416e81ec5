"""Search over priors: trials and folds are rows, the winner is refitted per series."""

from __future__ import annotations

import datetime as dt
import itertools
import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfcast.fixed_values import (
    BOUNDS_CHANGEPOINT,
    BOUNDS_SEASONALITY,
    GRID_CHANGEPOINT,
    GRID_SEASONALITY,
    TRIALS_LONG,
)
from shelfcast.functions.metrics import best_trial
from shelfcast.models.additive import fold_errors, forecast
from shelfcast.models.design import ForecastConfig, series_rows, solve_tasks
from shelfcast.schema import SERIES
from shelfcast.session import materialise

Trial = tuple[int, float, float]


def grid_trials(
    changepoint: Sequence[float] = GRID_CHANGEPOINT,
    seasonality: Sequence[float] = GRID_SEASONALITY,
) -> list[Trial]:
    """Every combination, changepoint prior first, numbered from 0."""
    return [(i, c, s) for i, (c, s) in enumerate(itertools.product(changepoint, seasonality))]


def random_trials(
    n: int = TRIALS_LONG,
    seed: int = 0,
    changepoint: tuple[float, float] = BOUNDS_CHANGEPOINT,
    seasonality: tuple[float, float] = BOUNDS_SEASONALITY,
) -> list[Trial]:
    """Uniform draws within the bounds, the same for every run with the same seed."""
    draw = random.Random(seed)
    return [(i, draw.uniform(*changepoint), draw.uniform(*seasonality)) for i in range(n)]


def trials_frame(spark: SparkSession, trials: Sequence[Trial]) -> DataFrame:
    return spark.createDataFrame(
        trials, "trial_id int, changepoint_prior double, seasonality_prior double"
    )


def search(
    series: DataFrame,
    cfg: ForecastConfig,
    trials: Sequence[Trial],
    cutoffs: Sequence[dt.date],
    horizon: int,
    keys: Sequence[str] = SERIES,
    unique: bool = False,
) -> DataFrame:
    """Best priors per series by cross-validated RMSE; the first trial wins a tie."""
    rows = series_rows(series, cfg, keys, unique)
    errors = fold_errors(rows, cfg, trials, cutoffs, horizon, keys)
    scores = errors.groupBy(*keys, "trial_id").agg(_rmse(F.sum("squares"), F.sum("n")).alias("rmse"))
    return _with_priors(best_trial(scores, keys), trials).select(
        *keys, "trial_id", "changepoint_prior", "seasonality_prior", "rmse"
    )


def _rmse(squares: Column, n: Column) -> Column:
    return F.sqrt(squares / F.nullif(n, F.lit(0)))


def _with_priors(best: DataFrame, trials: Sequence[Trial]) -> DataFrame:
    # The trial list is the caller's own short list, so its broadcast is bounded by it.
    return best.join(F.broadcast(trials_frame(best.sparkSession, trials)), "trial_id")


def halving(
    series: DataFrame,
    cfg: ForecastConfig,
    trials: Sequence[Trial],
    cutoffs: Sequence[dt.date],
    horizon: int,
    keys: Sequence[str] = SERIES,
    unique: bool = False,
    keep: float = 0.5,
    complete: bool = True,
) -> DataFrame:
    """The winner of ``search`` with fewer fits: losers are dropped from fold to fold.

    Rung by rung, latest cutoff first, the trials still in are fitted on one more fold, and the share ``keep`` of
    them with the smallest error so far stays. A trial that was dropped can still win only if the squares it has
    so far do not exceed those of the best trial that has seen every fold, since squares only add up. With ``complete``
    such trials are then fitted on the folds they miss, one fold at a time, so that the result is that of the whole
    search whatever ``keep`` is; without, the best of the last rung wins. ``n_fits`` counts the fits made for a
    series; ``search`` makes one per trial and fold. A series without a given fold keeps its trials there.
    """
    if not 0 < keep <= 1:
        raise ValueError(f"keep: {keep}")
    spark = series.sparkSession
    rows = materialise(series_rows(series, cfg, keys, unique))
    of_series = Window.partitionBy(*keys)
    order = sorted(cutoffs, reverse=True)
    empty = "trial_id int, done array<date>, n bigint, squares double, alive boolean"
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    state = spark.createDataFrame([], f"{kinds}, {empty}")

    def scored(state: DataFrame, wanted: DataFrame | None, cutoff: dt.date) -> DataFrame:
        asked = rows
        if wanted is not None:
            listed = wanted.groupBy(*keys).agg(F.array_sort(F.collect_list("trial_id")).alias("_trials"))
            asked = rows.join(listed, list(keys))
        # A set number of tasks, as in series_rows: these are few bytes and many fits.
        asked = asked.repartition(solve_tasks(spark, cfg), *keys)
        new = fold_errors(asked, cfg, trials, [cutoff], horizon, keys).select(
            *keys, "trial_id", F.array("cutoff").alias("done"), "n", "squares", F.lit(True).alias("alive")
        )
        return state.unionByName(new).groupBy(*keys, "trial_id").agg(
            F.array_sort(F.flatten(F.collect_list("done"))).alias("done"),
            F.sum("n").alias("n"),
            F.sum("squares").alias("squares"),
            F.bool_and("alive").alias("alive"),
        )

    for rung, cutoff in enumerate(order):
        # Before its first fold a series has no state and is asked for with all trials.
        fresh = rows.select(*keys).join(state.select(*keys).distinct(), list(keys), "left_anti")
        every = F.explode(F.array(*[F.lit(t[0]) for t in trials])).alias("trial_id")
        wanted = state.filter("alive").select(*keys, "trial_id").unionByName(fresh.select(*keys, every))
        state = scored(state, wanted if rung else None, cutoff)
        if rung < len(order) - 1:
            error = _rmse(F.col("squares"), F.col("n"))
            place = F.row_number().over(
                of_series.orderBy(F.col("alive").desc(), error.asc_nulls_last(), "trial_id")
            )
            still = F.count_if("alive").over(of_series)
            here = F.array_contains("done", F.lit(cutoff))
            seen = F.max(F.when(F.col("alive"), here)).over(of_series)
            state = state.withColumns({"_place": place, "_still": still, "_seen": seen}).withColumn(
                "alive", F.col("alive") & (~F.col("_seen") | (F.col("_place") <= F.ceil(F.col("_still") * keep)))
            ).drop("_place", "_still", "_seen")
        state = materialise(state)
    whole = F.size("done") == F.max(F.size("done")).over(of_series)
    usable = F.col("squares").isNotNull() & ~F.isnan("squares")
    for cutoff in order[1:] if complete else ():
        bound = F.min(F.when(F.col("_whole") & usable, F.col("squares"))).over(of_series)
        marked = state.withColumn("_whole", whole).withColumn("_bound", bound)
        open_ = ~F.col("_whole") & usable & (F.col("squares") <= F.coalesce("_bound", F.lit(float("inf"))))
        wanted = marked.filter(open_ & ~F.array_contains("done", F.lit(cutoff))).select(*keys, "trial_id")
        state = materialise(scored(state, wanted, cutoff))
    fits = state.withColumns({"n_fits": F.sum(F.size("done")).over(of_series), "_whole": whole})
    scores = fits.filter("_whole").withColumn("rmse", _rmse(F.col("squares"), F.col("n")))
    best = best_trial(scores, keys, ("trial_id", "n_fits"))
    return _with_priors(best, trials).select(
        *keys, "trial_id", "changepoint_prior", "seasonality_prior", "rmse", "n_fits"
    )


def search_and_forecast(
    series: DataFrame,
    cfg: ForecastConfig,
    trials: Sequence[Trial],
    cutoffs: Sequence[dt.date],
    horizon: int,
    keys: Sequence[str] = SERIES,
    run_date: dt.date | None = None,
    unique: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Best priors per series, and the forecast refitted with them."""
    best = search(series, cfg, trials, cutoffs, horizon, keys, unique)
    return best, forecast(series, cfg, keys, best, run_date, unique)


def grid_search(
    series: DataFrame, cfg: ForecastConfig, cutoffs: Sequence[dt.date], horizon: int = 60, **kwargs
) -> tuple[DataFrame, DataFrame]:
    """The fixed grid of 4 x 4 priors."""
    return search_and_forecast(series, cfg, grid_trials(), cutoffs, horizon, **kwargs)


def random_search(
    series: DataFrame,
    cfg: ForecastConfig,
    cutoffs: Sequence[dt.date],
    horizon: int = 30,
    n_trials: int = TRIALS_LONG,
    seed: int = 0,
    **kwargs,
) -> tuple[DataFrame, DataFrame]:
    """``n_trials`` uniform draws of the priors, losers dropped from fold to fold."""
    trials = random_trials(n_trials, seed)
    keys, unique = kwargs.get("keys", SERIES), kwargs.get("unique", False)
    best = materialise(halving(series, cfg, trials, cutoffs, horizon, keys, unique))
    return best, forecast(series, cfg, keys, best, kwargs.get("run_date"), unique)
