"""Design matrices and their sufficient statistics, as column expressions and Spark sums."""

from __future__ import annotations

import dataclasses
import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.fixed_values import INTERVAL_WIDTH, LOCKDOWNS, TRAIN_END
from shelfcast.functions.calendar import (
    easter_sunday,
    event_dates,
    holiday_flags,
    next_period_ends,
)
from shelfcast.schema import ATTRIBUTES, SERIES

EPOCH = dt.date(1970, 1, 1)


@dataclasses.dataclass(frozen=True)
class ForecastConfig:
    """What the additive model is made of: trend, seasons, events and regressors."""

    regressors: tuple[str, ...] = ("black_week", "christmas")
    train_end: dt.date = TRAIN_END
    periods: int = 1
    freq: str = "M"
    interval_width: float = INTERVAL_WIDTH
    changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_prior: float = 0.05
    seasonality_prior: float = 10.0
    holidays_prior: float = 10.0
    yearly_order: int = 10
    weekly_order: int = 0
    events: tuple[tuple[str, dt.date, dt.date], ...] = LOCKDOWNS
    country_holidays: bool = True
    tasks: int | None = None


def solve_tasks(spark: SparkSession, cfg: ForecastConfig) -> int:
    if cfg.tasks:
        return cfg.tasks
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, spark.sparkContext.defaultParallelism)


def series_rows(
    series: DataFrame,
    cfg: ForecastConfig,
    keys: Sequence[str] = SERIES,
    unique: bool = False,
) -> DataFrame:
    """One row per series holding its observations as an array in date order.

    Observations are merged to one per series and date first, so an array is no longer than the
    calendar. ``unique`` skips that merge for a frame known to be so already.
    """
    carried = [a for a in ATTRIBUTES if a in series.columns and a not in keys]
    placeholder = F.col("is_future") if "is_future" in series.columns else F.lit(False)
    points = series.select(
        *keys,
        "ds",
        F.col("y").cast("double").alias("y"),
        placeholder.alias("is_future"),
        *[F.col(r).cast("double").alias(r) for r in cfg.regressors],
        *carried,
    )
    if not unique:
        points = points.groupBy(*keys, "ds").agg(
            F.sum("y").alias("y"),
            F.bool_and("is_future").alias("is_future"),
            *[F.max(r).alias(r) for r in cfg.regressors],
            *[F.max(a).alias(a) for a in carried],
        )
    fields = [c for c in points.columns if c not in keys]
    # A set number of tasks: adaptive coalescing goes by bytes and would put these few bytes, and with
    # them every solve, into one task. Each series is bounded, so hashing its key is even enough.
    return points.repartition(solve_tasks(points.sparkSession, cfg), *keys).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("obs"),
        *[F.max_by(a, "ds").alias(a) for a in carried],
    )


def with_future(rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Split ``obs`` into ``train`` and the points to predict: the training dates and the next periods.

    A placeholder of the future is no observation, wherever its date lies; before the training end it is predicted.
    A future point takes its regressors from the observation of that date, or 0 without one; its
    actual stays null unless it was really observed. A series without training data predicts from
    the training end on.
    """
    end = F.lit(cfg.train_end)
    train = F.filter("obs", lambda o: (o["ds"] <= end) & ~o["is_future"])
    waiting = F.filter("obs", lambda o: (o["ds"] <= end) & o["is_future"])
    last = F.array_max(F.transform(F.filter("obs", lambda o: o["ds"] <= end), lambda o: o["ds"]))

    def point(day: Column) -> Column:
        seen = F.get(F.filter("obs", lambda o: o["ds"] == day), F.lit(0))
        actual = F.when(~seen["is_future"], seen["y"])
        regressors = [F.coalesce(seen[r], F.lit(0.0)).alias(r) for r in cfg.regressors]
        return F.struct(
            day.alias("ds"), actual.alias("y"), F.lit(False).alias("is_train"), *regressors
        )

    known = F.transform(
        "train",
        lambda o: F.struct(
            o["ds"].alias("ds"),
            o["y"].alias("y"),
            F.lit(True).alias("is_train"),
            *[o[r].alias(r) for r in cfg.regressors],
        ),
    )
    asked = F.transform(waiting, lambda o: point(o["ds"]))
    ahead = F.transform(next_period_ends(F.coalesce(last, end), cfg.periods, cfg.freq), point)
    points = F.concat(known, asked, ahead)
    return rows.withColumn("train", train).withColumn("points", points).drop("obs")


def with_fold(
    rows: DataFrame, cfg: ForecastConfig, cutoffs: Sequence[dt.date], horizon: int
) -> DataFrame:
    """One row per series and cutoff: training points up to it, test points within the horizon.

    A fold without a test point, or with fewer than two training points, is no fold.
    """
    folds = rows.withColumn("cutoff", F.explode(F.array(*[F.lit(c) for c in cutoffs])))
    observed = F.filter(
        "obs", lambda o: (o["ds"] <= F.date_add("cutoff", horizon)) & ~o["is_future"]
    )
    points = F.transform(
        observed,
        lambda o: F.struct(
            o["ds"].alias("ds"),
            o["y"].alias("y"),
            (o["ds"] <= F.col("cutoff")).alias("is_train"),
            *[o[r].alias(r) for r in cfg.regressors],
        ),
    )
    split = folds.withColumn(
        "train", F.filter("obs", lambda o: (o["ds"] <= F.col("cutoff")) & ~o["is_future"])
    ).withColumn("points", points)
    return split.filter((F.size("train") >= 2) & (F.size("points") > F.size("train"))).drop("obs")


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return total / F.nullif(F.size(values).cast("double"), F.lit(0.0))


def _deviation(values: Column, centre: Column) -> Column:
    squares = F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - centre) * (v - centre))
    return F.sqrt(squares / F.nullif((F.size(values) - 1).cast("double"), F.lit(0.0)))


def _field(array: str, name: str) -> Column:
    return F.transform(array, lambda o: o[name])


def _scales(rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Per-series scaling, trend changepoints and regressor standardisation, from ``train`` alone."""
    day = F.transform("train", lambda o: F.datediff(o["ds"], F.lit(EPOCH)))
    size = F.array_max(F.transform("train", lambda o: F.abs(o["y"])))
    columns = {
        "n_train": F.size("train"),
        "first_day": F.coalesce(F.array_min(day), F.lit(0)),
        "span": F.coalesce(F.nullif(F.array_max(day) - F.array_min(day), F.lit(0)), F.lit(1)),
        "y_scale": F.coalesce(F.nullif(size, F.lit(0.0)), F.lit(1.0)),
    }
    rows = rows.withColumns(columns)
    trend_points = F.floor(F.col("n_train") * cfg.changepoint_range).cast("int")
    rows = rows.withColumn(
        "n_cp", F.greatest(F.least(F.lit(cfg.changepoints), trend_points - 1), F.lit(0))
    ).withColumn("_reach", trend_points - 1)

    def changepoint(k: Column) -> Column:
        index = F.bround(k * F.col("_reach") / F.col("n_cp")).cast("int")
        when = F.get(F.col("train"), index)["ds"]
        return (F.datediff(when, F.lit(EPOCH)) - F.col("first_day")) / F.col("span")

    none = F.array().cast("array<double>")
    rows = rows.withColumn(
        "cps",
        F.when(
            F.col("n_cp") > 0, F.transform(F.sequence(F.lit(1), F.col("n_cp")), changepoint)
        ).otherwise(none),
    )
    standard = {}
    for r in cfg.regressors:
        values = _field("train", r)
        distinct = F.array_distinct(values)
        binary = F.size(F.array_except(distinct, F.array(F.lit(0.0), F.lit(1.0)))) == 0
        keep = (F.size(distinct) < 2) | binary
        centre = _mean(values)
        standard[f"_mean_{r}"] = F.when(keep, 0.0).otherwise(centre)
        standard[f"_std_{r}"] = F.when(keep, 1.0).otherwise(_deviation(values, centre))
    return rows.withColumns(standard) if standard else rows


def _fourier(days: Column, period: float, order: int) -> list[Column]:
    waves = []
    for k in range(1, order + 1):
        angle = days * F.lit(2.0 * math.pi * k / period)
        waves += [F.sin(angle), F.cos(angle)]
    return waves


def _events(cfg: ForecastConfig) -> list[Column]:
    named: dict[str, list[dt.date]] = {}
    for name, day in event_dates(cfg.events, "M" if cfg.freq == "M" else "D"):
        named.setdefault(name, []).append(day)
    flags = [F.col("ds").isin(sorted(days)) for days in named.values()]
    if cfg.country_holidays:
        flags += holiday_flags(F.col("ds"), F.col("_easter"))
    return [F.coalesce(f.cast("double"), F.lit(0.0)) for f in flags]


def design_matrix(rows: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """One row per point with its design vector ``x``.

    ``x`` is intercept, scaled time, one hinge per changepoint, yearly and weekly Fourier pairs, one
    indicator per event and the regressors. ``n_cp`` and ``n_season`` say how many hinges and waves
    it holds, ``pos`` counts the points of a series from 0; yearly waves need two years of history. Takes the rows of ``with_future`` or
    ``with_fold``; everything is a projection, so the rows stay where they are.
    """
    scaled = _scales(rows, cfg)
    passed = [c for c in scaled.columns if c not in ("train", "points", "_reach")]
    points = scaled.select(*passed, F.posexplode_outer("points").alias("pos", "_point"))
    points = points.select(*passed, "pos", "_point.*")
    days = F.datediff(F.col("ds"), F.lit(EPOCH))
    position = {"t": (days - F.col("first_day")) / F.col("span")}
    if cfg.country_holidays:
        position["_easter"] = easter_sunday(F.year("ds"))
    points = points.withColumns(position)
    hinges = F.transform("cps", lambda c: F.greatest(F.col("t") - c, F.lit(0.0)))
    none = F.array().cast("array<double>")
    yearly_on = F.col("span") >= 730
    yearly = _fourier(days, 365.25, cfg.yearly_order)
    waves = F.when(yearly_on, F.array(*yearly)).otherwise(none) if yearly else none
    weekly = _fourier(days, 7.0, cfg.weekly_order)
    tail = _events(cfg) + [
        (F.coalesce(F.col(r), F.lit(0.0)) - F.col(f"_mean_{r}")) / F.col(f"_std_{r}")
        for r in cfg.regressors
    ]
    parts = [F.array(F.lit(1.0), F.col("t")), hinges, waves]
    parts += [F.array(*weekly)] if weekly else []
    parts += [F.array(*tail)] if tail else []
    n_season = F.when(yearly_on, 2 * cfg.yearly_order).otherwise(0) + 2 * cfg.weekly_order
    helpers = [f"_{s}_{r}" for r in cfg.regressors for s in ("mean", "std")]
    return (
        points.withColumn("x", F.concat(*parts))
        .withColumn("n_season", n_season)
        .drop("cps", "first_day", "span", "_easter", *helpers)
    )


def normal_stats(design: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Sufficient statistics of least squares per series, from its training points.

    Row (i, j) with i <= j holds the sum of z_i * z_j, where z is the design vector followed by ``y``:
    the Gram matrix, its product with ``y`` and, in the last row, the sum of squares of ``y``. Sums
    are partial before any shuffle; a design already partitioned by series is not shuffled again.
    """
    z = F.concat("x", F.array("y"))
    rows = design.filter(F.col("is_train")).select(*keys, z.alias("z"))
    left = rows.select(*keys, "z", F.posexplode("z").alias("i", "_left"))
    right = F.slice("z", F.col("i") + 1, F.size("z") - F.col("i"))
    terms = left.select(
        *keys, "i", "_left", F.posexplode(right).alias("_offset", "_right")
    ).select(
        *keys,
        "i",
        (F.col("i") + F.col("_offset")).alias("j"),
        (F.col("_left") * F.col("_right")).alias("term"),
    )
    return terms.groupBy(*keys, "i", "j").agg(F.sum("term").alias("total"), F.count("*").alias("n"))
