"""Clipping, rounding, scores and trial selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.fixed_values import ROUND_UP_ABOVE
from shelfcast.schema import SERIES

FORECAST_COLUMNS = ("yhat", "yhat_upper", "yhat_lower")


def clip_negative(df: DataFrame, columns: Sequence[str] = FORECAST_COLUMNS) -> DataFrame:
    """Negative values become 0; null and NaN stay."""
    return df.withColumns(
        {c: F.when(F.col(c) < 0, F.lit(0.0)).otherwise(F.col(c)) for c in columns}
    )


def rounded_up_above(value: Column, threshold: float = ROUND_UP_ABOVE) -> Column:
    """Floor, plus one where the fraction is above the threshold; null and NaN give null."""
    known = F.when(value.isNotNull() & ~F.isnan(value), value)
    below = F.floor(known)
    return (below + ((known - below) > threshold).cast("bigint")).cast("bigint")


def round_up_above(
    df: DataFrame, columns: Sequence[str] = FORECAST_COLUMNS, threshold: float = ROUND_UP_ABOVE
) -> DataFrame:
    return df.withColumns({c: rounded_up_above(F.col(c).cast("double"), threshold) for c in columns})


def score(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Root of the mean absolute error, the same over the range of ``y``, and the true RMSE and MAE.

    Score a date slice by passing one. Placeholder rows of the future are not scored.
    """
    if "is_future" in df.columns:
        df = df.filter(~F.col("is_future"))
    gap = F.col("y") - F.col("yhat")
    totals = df.groupBy(*by).agg(
        F.count(gap).alias("n_scored"),
        F.sqrt(F.avg(F.abs(gap))).alias("root_mae"),
        F.avg(F.abs(gap)).alias("mae"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        (F.max("y") - F.min("y")).alias("_range"),
    )
    normalised = F.col("root_mae") / F.nullif(F.col("_range"), F.lit(0))
    return totals.withColumn("normalised", normalised).drop("_range")


def cv_metrics(predictions: DataFrame, by: Sequence[str] = (*SERIES, "trial_id")) -> DataFrame:
    """RMSE and MAE over all fold predictions of each group."""
    gap = F.col("y") - F.col("yhat")
    return predictions.groupBy(*by).agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
        F.count(gap).alias("n_scored"),
    )


def best_trial(
    scores: DataFrame, keys: Sequence[str] = SERIES, params: Sequence[str] = ("trial_id",)
) -> DataFrame:
    """Trial with the smallest RMSE per series; the first trial wins a tie, unscored trials never."""
    usable = scores.filter(F.col("rmse").isNotNull() & ~F.isnan("rmse"))
    rank = F.struct("rmse", "trial_id")
    picked = usable.groupBy(*keys).agg(
        F.min_by(F.struct(*params), rank).alias("_best"), F.min("rmse").alias("rmse")
    )
    return picked.select(*keys, "_best.*", "rmse")
