"""Time-ordered folds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.schema import SERIES


def time_series_folds(
    df: DataFrame, n: int, keys: Sequence[str] = SERIES, date: str = "ds"
) -> DataFrame:
    """Expanding folds: each row once per fold it takes part in, with ``fold`` and ``role``.

    The last ``n`` blocks of n_rows div (n + 1) rows are tested in turn, each trained on all rows
    before it. Expects a series frame, one row per series and date, so that a window partition is
    bounded by the calendar. A series shorter than n + 1 rows has no fold.
    """
    ordered = Window.partitionBy(*keys).orderBy(date)
    placed = df.withColumns(
        {
            "_row": F.row_number().over(ordered) - 1,
            "_rows": F.count("*").over(Window.partitionBy(*keys)).cast("int"),
        }
    ).withColumn("_size", F.floor(F.col("_rows") / (n + 1)).cast("int"))
    tagged = placed.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("fold")
    ).withColumn("_start", F.col("_rows") - (F.lit(n) - F.col("fold")) * F.col("_size"))
    taking_part = (F.col("_size") > 0) & (F.col("_row") < F.col("_start") + F.col("_size"))
    role = F.when(F.col("_row") < F.col("_start"), "train").otherwise("test")
    return (
        tagged.filter(taking_part)
        .withColumn("role", role)
        .drop("_row", "_rows", "_size", "_start")
    )


def rolling_origin_folds(
    df: DataFrame,
    cutoffs: Sequence[dt.date],
    horizon: int,
    date: str = "ds",
    incomplete: str = "keep",
) -> DataFrame:
    """Each row once per cutoff it serves: train up to the cutoff, test within ``horizon`` days after.

    A cutoff whose horizon passes the last date of the data is kept, skipped, or an error.
    """
    if incomplete not in ("keep", "skip", "error"):
        raise ValueError(f"incomplete: {incomplete}")
    if incomplete == "error":
        last = df.agg(F.max(date)).first()[0]
        late = [c for c in cutoffs if last is None or c + dt.timedelta(days=horizon) > last]
        if late:
            raise ValueError(f"no full horizon of history after {late}")
    points = F.array(*[F.lit(c) for c in cutoffs])
    serving = F.filter(points, lambda c: F.col(date) <= F.date_add(c, horizon))
    if incomplete == "skip":
        df = df.withColumn("_last", df.agg(F.max(date)).scalar())
        serving = F.filter(serving, lambda c: F.date_add(c, horizon) <= F.col("_last"))
    role = F.when(F.col(date) <= F.col("cutoff"), "train").otherwise("test")
    return df.select("*", F.explode(serving).alias("cutoff")).withColumn("role", role).drop("_last")
