"""Lookups and joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.schema import SERIES
from shelfcast.session import materialise


def last_attribute(
    df: DataFrame, key: str, attributes: Sequence[str], order: str = "sale_date"
) -> DataFrame:
    """Last value of each attribute per key: the latest date wins, then the largest value.

    The first aggregation keeps the last date of each distinct combination of values. Its buffer is
    one date, so it hashes without sorting and a hot key shrinks before any shuffle; the choice by
    (date, value) then sees only those few combinations.
    """
    seen = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key, *attributes)
        .agg(F.max(order).alias("_at"))
    )
    return seen.groupBy(key).agg(*[F.max_by(a, F.struct("_at", a)).alias(a) for a in attributes])


def attach_last(
    df: DataFrame, source: DataFrame, key: str, attributes: Sequence[str], order: str = "sale_date"
) -> DataFrame:
    """Replace the attributes of ``df`` by the last ones seen per key in ``source``.

    The lookup is written first, so the join is planned with its size and ``df`` stays in place where it is small.
    """
    lookup = materialise(last_attribute(source, key, attributes, order))
    return df.drop(*attributes).join(lookup, key, "left")


def map_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    key: str,
    value: str,
    out: str,
    order: str | None = None,
) -> DataFrame:
    """Add ``out``: the dimension's ``value`` where its ``key`` equals ``on``; null where unmapped.

    A repeated key counts once: its last entry by ``order``, or its largest value without one. The lookup is
    written first, so that its size in bytes, not a guess, decides how it is joined.
    """
    entry = F.col(f"`{value}`")
    rank = F.struct(F.col(order), entry) if order else entry
    lookup = (
        dim.filter(F.col(f"`{key}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias(on))
        .agg(F.max_by(entry, rank).alias(out))
    )
    return df.join(materialise(lookup), on, "left")


def add_promos(
    df: DataFrame, monthly: DataFrame, date: str = "sale_date", flag: str = "promos"
) -> DataFrame:
    """Promotion flag by month end and product; 0 where there was none."""
    flags = monthly.select(
        F.col("month_end").alias(date), "business_unit", F.col(flag).alias("_flag")
    )
    joined = df.join(flags, [date, "business_unit"], "left")
    return joined.withColumn(flag, F.coalesce("_flag", F.lit(0))).drop("_flag")


def join_actuals(
    forecast: DataFrame, actuals: DataFrame, keys: Sequence[str] = SERIES, date: str = "ds"
) -> DataFrame:
    """Left join of actuals onto a forecast. Forecast-only dates keep a null ``y``; repeats multiply."""
    taken = [c for c in actuals.columns if c in (*keys, date) or c not in forecast.columns]
    return forecast.join(actuals.select(*taken), [*keys, date], "left")


def attach_regressors(
    future: DataFrame,
    series: DataFrame,
    columns: Sequence[str],
    flags: Sequence[str] = (),
    keys: Sequence[str] = SERIES,
    date: str = "ds",
) -> DataFrame:
    """Look regressors up by date within the series.

    ``columns`` are null on unknown dates. ``flags`` are 1 where the series holds a 1 on that date and
    0 everywhere else. A date that occurs twice counts once, with the larger value.
    """
    values: list[Column] = [F.max(c).alias(c) for c in columns]
    values += [F.max((F.col(c) == 1).cast("int")).alias(c) for c in flags]
    known = series.groupBy(*keys, date).agg(*values)
    joined = future.drop(*columns, *flags).join(known, [*keys, date], "left")
    return joined.fillna(0, subset=list(flags)) if flags else joined
