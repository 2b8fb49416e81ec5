"""Filters, value cleaning and set operations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfcast.session import materialise


def drop_returns(df: DataFrame, quantity: str = "quantity") -> DataFrame:
    """Keep sales that are not returns; an unknown quantity goes too."""
    return df.filter(F.col(quantity) >= 0)


def filter_equals(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(f"`{column}`") == F.lit(value))


def filter_in(df: DataFrame, column: str, values: Iterable | DataFrame) -> DataFrame:
    """Keep rows whose value is listed, either in a short literal list or in a one-column frame."""
    if isinstance(values, DataFrame):
        return df.join(_listed(values, column), column, "left_semi")
    return df.filter(F.col(column).isin(list(values)))


def _listed(values: DataFrame, column: str) -> DataFrame:
    """The distinct values as a written table, so that its size is known when the join is planned.

    A short list is then broadcast from the start, and ``df`` is not shuffled on the few values of a hot column.
    """
    return materialise(values.select(F.col(values.columns[0]).alias(column)).distinct())


def keep_eligible(df: DataFrame, history: DataFrame, column: str = "store") -> DataFrame:
    """Keep stores that occur in history."""
    return filter_in(df, column, history.select(column))


def drop_closed(df: DataFrame, closed: Sequence[str] | DataFrame, column: str = "store") -> DataFrame:
    """Drop listed stores. A row without a store stays, as it matches no list entry."""
    if isinstance(closed, DataFrame):
        return df.join(_listed(closed, column), column, "left_anti")
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(list(closed)))


def replace_values(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Swap exact values, all at once: a swapped value is not swapped again."""
    return df.replace(dict(mapping), subset=[column])


def replace_regex(df: DataFrame, column: str, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Replace the whole value where a pattern matches, rule after rule."""
    value: Column = F.col(column)
    for pattern, new in rules:
        value = F.when(value.rlike(pattern), F.lit(new)).otherwise(value)
    return df.withColumn(column, value)


def promote_level(
    df: DataFrame, source: str = "product_division", target: str = "business_unit"
) -> DataFrame:
    """Forecast one level up: ``source`` takes the place and name of ``target``."""
    return df.drop(target).withColumnRenamed(source, target)


def select_series(
    df: DataFrame, store: str | None = None, business_unit: str | None = None
) -> DataFrame:
    if store is not None:
        df = df.filter(F.col("store") == store)
    if business_unit is not None:
        df = df.filter(F.col("business_unit") == business_unit)
    return df


def split_by_date(
    df: DataFrame, cutoff: dt.date, date: str = "ds"
) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including the cutoff, and rows after it."""
    return df.filter(F.col(date) <= F.lit(cutoff)), df.filter(F.col(date) > F.lit(cutoff))


def date_slice(
    df: DataFrame,
    low: dt.date | None = None,
    high: dt.date | None = None,
    closed: str = "both",
    date: str = "ds",
) -> DataFrame:
    """Rows in a date range whose ends belong to it as ``closed`` says: both, left, right or neither."""
    if closed not in ("both", "left", "right", "neither"):
        raise ValueError(f"closed: {closed}")
    when = F.col(date)
    if low is not None:
        df = df.filter(when >= F.lit(low) if closed in ("both", "left") else when > F.lit(low))
    if high is not None:
        df = df.filter(when <= F.lit(high) if closed in ("both", "right") else when < F.lit(high))
    return df


def dedup(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(values))


def stamp_run(
    df: DataFrame, run_date: dt.date | None = None, column: str = "training_date"
) -> DataFrame:
    """Add the load date: the given one, or today."""
    return df.withColumn(column, F.current_date() if run_date is None else F.lit(run_date))


def append(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack frames by column name; a column that a frame lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def order_output(
    df: DataFrame,
    columns: Sequence[str] = (
        "store",
        "city",
        "super_division",
        "product_division",
        "business_unit",
        "ds",
    ),
) -> DataFrame:
    """Total order for a sink; nothing before a sink needs one."""
    return df.orderBy(*[c for c in columns if c in df.columns])


def preview(df: DataFrame, n: int, order: Sequence[str], last: bool = False) -> DataFrame:
    """The first or last ``n`` rows in an explicit order (top-n per task, then one merge of n rows)."""
    return df.orderBy(*[F.col(c).desc() if last else F.col(c).asc() for c in order]).limit(n)


_INTEGERS = (
    (T.ByteType(), -(2**7), 2**7 - 1),
    (T.ShortType(), -(2**15), 2**15 - 1),
    (T.IntegerType(), -(2**31), 2**31 - 1),
    (T.LongType(), -(2**63), 2**63 - 1),
)
_FLOAT_MAX = 3.4028234663852886e38


def _narrowest(kind: T.DataType, low: object, high: object, allow_float: bool) -> T.DataType:
    if low is None or high is None:
        return kind
    if isinstance(kind, T.IntegralType):
        for narrow, bottom, top in _INTEGERS:
            if low > bottom and high < top:
                return narrow
        return kind
    if allow_float and low > -_FLOAT_MAX and high < _FLOAT_MAX:
        return T.FloatType()
    return kind


def narrow_numeric(
    df: DataFrame, allow_float: bool = False
) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """Cast numbers to the narrowest type whose bounds lie strictly outside the observed range.

    One aggregation finds all ranges and only its single row reaches the driver. Returns the frame
    and the columns that changed, as (column, old type, new type). Floats stay double unless allowed.
    """
    numeric = [
        f
        for f in df.schema
        if isinstance(f.dataType, (T.IntegralType, T.FloatType, T.DoubleType))
    ]
    if not numeric:
        return df, []
    ranges = df.agg(
        *[F.min(f.name).alias(f"low_{i}") for i, f in enumerate(numeric)],
        *[F.max(f.name).alias(f"high_{i}") for i, f in enumerate(numeric)],
    ).first()
    casts, report = {}, []
    for i, f in enumerate(numeric):
        narrow = _narrowest(f.dataType, ranges[f"low_{i}"], ranges[f"high_{i}"], allow_float)
        if narrow != f.dataType:
            casts[f.name] = F.col(f.name).cast(narrow)
            report.append((f.name, f.dataType.simpleString(), narrow.simpleString()))
    return (df.withColumns(casts) if casts else df), report
