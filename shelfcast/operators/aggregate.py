"""Aggregation, densification, resampling, reshaping and profiling."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfcast.functions.calendar import period_end
from shelfcast.operators.joins import last_attribute
from shelfcast.schema import MEASURES, SERIES
from shelfcast.session import materialise


def aggregate_sales(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str] = MEASURES
) -> DataFrame:
    """Sum the measures by keys; rows with a null key are left out."""
    return (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    )


def _zero(kind: T.DataType) -> Column:
    return F.lit(0).cast(kind)


def densify(
    df: DataFrame,
    axis: str = "observed",
    keys: Sequence[str] = SERIES,
    measures: Sequence[str] = MEASURES,
    date: str = "sale_date",
    freq: str = "D",
    attributes: Mapping[str, tuple[str, ...]] | None = None,
    cut: bool = True,
) -> DataFrame:
    """One row per period and observed series, 0 where nothing was sold.

    The axis is every period in which any series sold ("observed"), or every one from the first to
    the last ("calendar"). Sales are summed per cell first, so a series holds at most one entry per
    calendar day however many sales it has. Its missing periods are then filled in place: grid rows
    are generated after the last shuffle and never exchanged.

    ``freq="M"`` sums to month ends before filling, which gives what filling days and then summing
    them gives, with a thirtieth of the rows. ``attributes`` maps a key column to the attributes whose
    last value per key is carried along; they join per series, before rows multiply. ``cut`` writes
    the cells to the checkpoint folder, so that the input is read once for cells, axis and attributes;
    without it no job starts while the plan is built, and the input is read again for each of them.
    """
    sold = df.dropna(subset=[date, *keys])
    carried = [a for names in (attributes or {}).values() for a in names]
    period = period_end(F.col(date), freq)
    # Attributes are grouping keys here rather than struct maxima: that buffer of fixed-width values
    # hashes, where one of strings would have to sort the whole input.
    cells = sold.groupBy(period.alias("_period"), *keys, *carried).agg(
        *[F.sum(m).alias(m) for m in measures], F.max(date).alias("_at")
    )
    if cut:
        cells = materialise(cells)
    entries = cells
    if carried:
        entries = cells.groupBy("_period", *keys).agg(*[F.sum(m).alias(m) for m in measures])
    kinds = {f.name: f.dataType for f in entries.schema}
    per_series = entries.groupBy(*keys).agg(
        F.collect_list(
            F.struct(
                F.col("_period").alias(date),
                *[F.coalesce(m, _zero(kinds[m])).alias(m) for m in measures],
            )
        ).alias("cells")
    )
    periods = cells.select("_period") if cut else sold.select(period.alias("_period"))
    if axis == "observed":
        axis_frame = periods.agg(F.collect_set("_period"))
    elif axis == "calendar":
        step = F.make_ym_interval(F.lit(0), F.lit(1)) if freq == "M" else F.make_dt_interval(
            F.lit(7 if freq == "W" else 1)
        )
        first, last = F.min("_period"), F.max("_period")
        every = F.sequence(F.trunc(first, "MM") if freq == "M" else first, last, step)
        axis_frame = periods.agg(every.alias("every")).select(
            F.transform("every", lambda d: period_end(d, freq))
        )
    else:
        raise ValueError(f"axis: {axis}")
    per_series = per_series.withColumn("_axis", axis_frame.scalar())
    for key, names in (attributes or {}).items():
        lookup = last_attribute(cells, key, names, "_at")
        if cut:
            # As a table its size is known: a small one is broadcast and the series stay in place.
            lookup = materialise(lookup)
        per_series = per_series.join(lookup, key, "left")
    missing = F.array_except("_axis", F.transform("cells", lambda cell: cell[date]))
    zeros = F.transform(
        missing,
        lambda day: F.struct(day.alias(date), *[_zero(kinds[m]).alias(m) for m in measures]),
    )
    filled = per_series.select(*keys, *carried, F.inline(F.concat("cells", zeros)))
    return filled.select(date, *keys, *carried, *measures)


def pivot_series(
    df: DataFrame,
    key: str,
    values: Sequence[str],
    measure: str = "quantity",
    date: str = "sale_date",
) -> DataFrame:
    """Wide form for inspection: one row per date, one column per listed series, 0 where empty."""
    wide = df.groupBy(date).pivot(key, list(values)).agg(F.sum(measure))
    return wide.fillna(0, subset=list(values))


def unpivot_series(
    wide: DataFrame,
    columns: Mapping[str, Mapping[str, str]] | Sequence[str],
    measure: str = "quantity",
    date: str = "sale_date",
    key: str = "store",
) -> DataFrame:
    """Long form of a wide frame.

    With a plain list of columns the name becomes ``key``. With a mapping from column name to its key
    values, those become typed key columns, so a name may hold any character.
    """
    names = list(columns)
    label = key if not isinstance(columns, Mapping) else "_column"
    long = wide.unpivot([date], names, label, measure)
    if not isinstance(columns, Mapping):
        return long
    key_names = list(next(iter(columns.values())))
    lookup = {
        k: F.create_map(*[F.lit(x) for n in names for x in (n, columns[n][k])]) for k in key_names
    }
    return long.select(date, *[lookup[k][F.col(label)].alias(k) for k in key_names], measure)


def resample(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] = MEASURES,
    freq: str = "M",
    date: str = "sale_date",
) -> DataFrame:
    """Sum by period end (day, week ending Sunday, month), whole numbers toward zero, null keys left out.

    Only periods in which a key has rows appear.
    """
    return (
        df.dropna(subset=[*keys, date])
        .groupBy(*keys, period_end(F.col(date), freq).alias(date))
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in measures])
    )


def resample_month(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] = MEASURES,
    date: str = "sale_date",
) -> DataFrame:
    return resample(df, keys, measures, "M", date)


def monthly_promos(promos: DataFrame, keep_discount: bool = False) -> DataFrame:
    """Months with a promotion per product: flag 1, optionally with the summed discount."""
    monthly = (
        promos.dropna(subset=["business_unit", "sale_date"])
        .groupBy("business_unit", F.last_day("sale_date").alias("month_end"))
        .agg(F.sum("discount_amount").alias("discount_amount"))
        .withColumn("promos", F.lit(1))
    )
    return monthly if keep_discount else monthly.drop("discount_amount")


def series_frame(
    df: DataFrame,
    regressors: Sequence[str],
    attributes: Sequence[str] = ("city", "super_division", "product_division"),
    date: str = "sale_date",
    quantity: str = "quantity",
) -> DataFrame:
    """Model input: summed quantity ``y`` per series, attributes, regressors and date ``ds``."""
    keys = ["store", *[a for a in attributes if a in df.columns], "business_unit", *regressors]
    return df.groupBy(*keys, F.col(date).alias("ds")).agg(
        F.sum(quantity).cast("bigint").alias("y")
    )


def series_counts(
    df: DataFrame, keys: Sequence[str] = ("store", "city", "business_unit")
) -> DataFrame:
    """Rows per series."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def forecast_rollup(forecast: DataFrame, since: object) -> DataFrame:
    """Actual and predicted totals per product and month from a date on, toward zero."""
    return (
        forecast.filter(F.col("ds") >= F.lit(since))
        .groupBy("business_unit", F.last_day("ds").alias("month_end"))
        .agg(
            F.coalesce(F.sum("y"), F.lit(0.0)).cast("bigint").alias("y"),
            F.coalesce(F.sum("yhat"), F.lit(0.0)).cast("bigint").alias("yhat"),
        )
    )


def sales_rollup(
    df: DataFrame,
    keys: Sequence[str] = ("super_division", "product_division", "business_unit"),
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Monthly totals above the store level, the data behind the sales charts."""
    return resample(df, keys, measures, "M")


def max_date(df: DataFrame, date: str = "sale_date") -> DataFrame:
    """Last date, as one row; ``.scalar()`` of it is a column usable in any expression."""
    return df.agg(F.max(date).alias("max_date"))


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Per column: rows, distinct values, nulls and whether there are any.

    Distinct values are estimated in one pass. ``exact`` counts each column's values by themselves, shuffling only
    values that each task has already merged; ``df`` is read once and written to the checkpoint folder, of which each
    count reads its own column.
    """
    names = df.columns
    if exact:
        df, counted = materialise(df), []
        for name in names:
            values = df.groupBy(F.col(f"`{name}`").alias("v")).agg(F.count("*").alias("n"))
            absent = F.col("v").isNull()
            counted.append(
                values.agg(
                    F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                    F.count("v").alias("n_distinct"),
                    F.coalesce(F.sum(F.when(absent, F.col("n"))), F.lit(0)).alias("n_null"),
                ).select(
                    F.lit(name).alias("column_name"),
                    "n_rows",
                    F.lit(len(names)).alias("n_columns"),
                    "n_distinct",
                    "n_null",
                    (F.col("n_null") > 0).alias("has_null"),
                )
            )
        return functools.reduce(DataFrame.unionAll, counted)
    totals = df.agg(
        F.count("*").alias("n_rows"),
        *[F.approx_count_distinct(F.col(f"`{n}`")).alias(f"d{i}") for i, n in enumerate(names)],
        *[F.count_if(F.col(f"`{n}`").isNull()).alias(f"n{i}") for i, n in enumerate(names)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("column_name"),
                F.col("n_rows"),
                F.lit(len(names)).alias("n_columns"),
                F.col(f"d{i}").alias("n_distinct"),
                F.col(f"n{i}").alias("n_null"),
                (F.col(f"n{i}") > 0).alias("has_null"),
            )
            for i, n in enumerate(names)
        ]
    )
    return totals.select(F.inline(rows))


#: Bits of the address of a sketch of distinct values: 2^14 bytes at most.
SKETCH_BITS = 14
#: The estimate of distinct values is within this share of the truth but once in some four hundred columns (three
#: standard errors of 1.04 / sqrt(2^SKETCH_BITS)).
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def profile_sketches(df: DataFrame, date: str = "sale_date") -> DataFrame:
    """Per month end and column: rows, nulls, a sketch of the distinct values, and one of the quantiles of numbers.

    One pass over ``df``, and a row per month and column whatever its size. The rows of new months are simply appended
    to those of earlier ones; ``merged_profile`` makes any set of them a profile. ``month`` is null for rows without a date.
    """
    numbers = (T.NumericType,)
    columns, rows = [F.count("*").alias("n_rows")], []
    for i, field in enumerate(df.schema):
        value = F.col(f"`{field.name}`")
        number = isinstance(field.dataType, numbers)
        columns += [
            F.count_if(value.isNull()).alias(f"n{i}"),
            F.hll_sketch_agg(value.cast("string"), F.lit(SKETCH_BITS)).alias(f"d{i}"),
        ]
        if number:
            columns.append(F.kll_sketch_agg_double(value.cast("double")).alias(f"q{i}"))
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col("n_rows"),
                F.col(f"n{i}").alias("n_null"),
                F.col(f"d{i}").alias("distinct_sketch"),
                (F.col(f"q{i}") if number else F.lit(None).cast("binary")).alias("quantile_sketch"),
            )
        )
    totals = df.groupBy(F.last_day(date).alias("month")).agg(*columns)
    return totals.select("month", F.inline(F.array(*rows)))


def merged_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The profile of all months in ``sketches``: rows, estimated distinct values, nulls, quantiles of numbers."""
    merged = sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
        F.sum("n_null").alias("n_null"),
        F.kll_merge_agg_double("quantile_sketch").alias("_quantiles"),
    )
    some = F.col("_quantiles").isNotNull() & (F.kll_sketch_get_n_double("_quantiles") > 0)
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    return merged.withColumns(
        {
            "has_null": F.col("n_null") > 0,
            "quantiles": F.when(some, F.kll_sketch_get_quantile_double("_quantiles", asked)),
        }
    ).drop("_quantiles")
