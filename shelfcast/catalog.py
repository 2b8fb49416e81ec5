"""Every operator as a query over the star tables."""

from __future__ import annotations

import datetime as dt
import sys
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfcast import fixed_values as fixed
from shelfcast.fixed_values import Rule
from shelfcast.functions import calendar, metrics
from shelfcast.models import additive, boosting, design, search, simulate, tweedie
from shelfcast.operators import aggregate, clean, folds, joins
from shelfcast.plans import lines, product_line
from shelfcast.session import materialise, scratch_dir
from shelfcast.sources import canonicalise, cells, promotions_from_star, published, readers, sales_from_star

# The one pandas function below travels with its task; executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Query = Callable[[SparkSession, str], DataFrame]

TRAIN_END = dt.date(2001, 9, 30)
RUN_DATE = dt.date(2001, 10, 1)
CUTOFFS = [dt.date(2000, 9, 1), dt.date(2000, 12, 1), dt.date(2001, 3, 1), dt.date(2001, 6, 1)]
SERIES_KEYS = ["store", "business_unit"]
YEARS_BACK = 20

_QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text, money as double and flags as numbers, so that any two engines print them alike."""
    casts = {T.DateType: "string", T.DecimalType: "double", T.BooleanType: "int"}
    return df.select(
        *[
            F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in casts
            else F.col(f.name)
            for f in df.schema
        ]
    )


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(fn(spark, sf_dir))

    _QUERIES[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _stores(spark: SparkSession, sf: str) -> list[str]:
    """Names of the stores, a row each in their dimension."""
    return sorted(r["n_name"] for r in _table(spark, sf, "nation").select("n_name").distinct().collect())


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_returns(sales_from_star(spark, sf))


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return product_line.monthly_series(_kept(spark, sf))


def _years(spark: SparkSession, sf: str) -> DataFrame:
    return clean.distinct_values(
        sales_from_star(spark, sf).select(F.year("sale_date").alias("year")), "year"
    )


def _totals(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.sum("quantity").cast("bigint").alias("quantity")
    )


# A. Sources


@query
def star_sales(spark, sf):
    return sales_from_star(spark, sf)


@query
def canonical_orders(spark, sf):
    mapping = {
        "o_orderdate": "sale_date",
        "o_orderstatus": "store",
        "o_custkey": "postal_code",
        "o_orderpriority": "business_unit",
        "o_totalprice": "amount",
    }
    raw = _table(spark, sf, "orders")
    return canonicalise(raw.withColumns({c: F.col(c).cast("string") for c in mapping}), mapping).select(
        "sale_date", "store", "postal_code", "business_unit", "amount"
    )


def _raw_orders(spark, sf):
    """Orders as a file would hold them: dates day first, some of them and some quantities unreadable."""
    day = F.when(F.col("o_orderstatus") == "P", "open").otherwise(F.date_format("o_orderdate", "d.M.yyyy"))
    number = F.col("o_orderpriority")
    count = F.when(number == "5-LOW", number).otherwise(F.substring(number, 1, 1))
    return _table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("postal_code"),
        day.alias("sale_date"), count.alias("quantity"), F.col("o_totalprice").cast("string").alias("amount"),
    )


@query
def typed_orders(spark, sf):
    typed, _ = readers.typed_and_rejected(_raw_orders(spark, sf), {})
    return typed.select("postal_code", "sale_date", "quantity", "amount")


@query
def rejected_orders(spark, sf):
    _, rejects = readers.typed_and_rejected(_raw_orders(spark, sf), {})
    return rejects.withColumn("rejected", F.array_join("rejected", ","))


# B. Filters and value cleaning


@query
def drop_returns(spark, sf):
    return _kept(spark, sf)


@query
def filter_equals(spark, sf):
    return clean.filter_equals(sales_from_star(spark, sf), "city", "EUROPE")


@query
def filter_in(spark, sf):
    return clean.filter_in(
        sales_from_star(spark, sf), "product_division", ("PROMO", "SMALL", "LARGE")
    )


@query
def keep_eligible(spark, sf):
    sales = sales_from_star(spark, sf)
    history = sales.filter((F.year("sale_date") == 1995) & (F.col("business_unit") == "Brand#1"))
    return clean.keep_eligible(sales, history, "postal_code")


@query
def drop_closed(spark, sf):
    sales = sales_from_star(spark, sf)
    closed = _table(spark, sf, "nation").filter("n_regionkey = 2").select("n_name")
    return clean.drop_closed(clean.drop_closed(sales, closed), ["NATION_3", "NATION_14"])


@query
def replace_values(spark, sf):
    swapped = clean.replace_values(
        sales_from_star(spark, sf), "product_division", {"SMALL": "LARGE", "LARGE": "HUGE"}
    )
    return _totals(swapped, "product_division", "store")


@query
def replace_regex(spark, sf):
    rules = ((r"^.*_1.*$", "TEENS"), (r"^NATION_.$", "DIGITS"))
    return _totals(clean.replace_regex(sales_from_star(spark, sf), "store", rules), "store")


@query
def promote_level(spark, sf):
    return _totals(clean.promote_level(sales_from_star(spark, sf)), "store", "business_unit")


@query
def select_series(spark, sf):
    return clean.select_series(sales_from_star(spark, sf), "NATION_3", "Brand#7")


@query
def split_by_date(spark, sf):
    past, ahead = clean.split_by_date(sales_from_star(spark, sf), TRAIN_END, "sale_date")
    both = clean.append(
        past.withColumn("part", F.lit("past")), ahead.withColumn("part", F.lit("ahead"))
    )
    return _totals(both, "part", "store")


@query
def date_slice(spark, sf):
    sales = sales_from_star(spark, sf)
    low, high = dt.date(1998, 1, 15), dt.date(1998, 3, 20)
    slices = [
        clean.date_slice(sales, low, high, closed, "sale_date").withColumn("closed", F.lit(closed))
        for closed in ("both", "left", "right", "neither")
    ]
    return _totals(clean.append(*slices), "closed", "store")


@query
def dedup(spark, sf):
    return clean.dedup(sales_from_star(spark, sf).select("sale_date", "store", "business_unit"))


@query
def fill(spark, sf):
    sales = sales_from_star(spark, sf).withColumn(
        "quantity", F.when(F.col("quantity") >= 0, F.col("quantity"))
    )
    return clean.fill(sales, {"quantity": 0}).select("sale_date", "store", "quantity")


@query
def stamp_run(spark, sf):
    return clean.stamp_run(_totals(sales_from_star(spark, sf), "store"), RUN_DATE)


@query
def narrow_numeric(spark, sf):
    places = _table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("long"))
    line = _table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_tax")
    rows = line.join(places, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "s_nationkey", "l_linenumber", "l_tax"
    )
    narrow, _ = clean.narrow_numeric(rows, allow_float=True)
    columns = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.typeof(c).alias("type_name"),
                F.round(F.col(c).cast("double"), 2).alias("value"),
            )
            for c in narrow.columns
        ]
    )
    return (
        narrow.select(F.inline(columns))
        .groupBy("column_name", "type_name")
        .agg(F.count("*").alias("n_rows"), F.round(F.sum("value"), 2).alias("total"))
    )


# C. Joins


@query
def map_lookup(spark, sf):
    dim = _table(spark, sf, "supplier").filter("s_acctbal > 0")
    line = _table(spark, sf, "lineitem").select("l_suppkey", "l_quantity")
    named = joins.map_lookup(line, dim, "l_suppkey", "s_suppkey", "s_name", "store")
    return named.groupBy(F.coalesce("store", F.lit("unmapped")).alias("store")).agg(
        F.count("*").alias("n_rows"), F.sum("l_quantity").alias("quantity")
    )


@query
def last_attribute_by_store(spark, sf):
    return joins.last_attribute(_kept(spark, sf), "store", ("city", "postal_code"))


@query
def last_attribute_by_product(spark, sf):
    return joins.last_attribute(
        _kept(spark, sf), "business_unit", ("super_division", "product_division")
    )


@query
def attach_last_attributes(spark, sf):
    kept = _kept(spark, sf)
    attached = joins.attach_last(kept, kept, "store", ("postal_code",))
    return _totals(attached, "store", "postal_code")


@query
def add_promos(spark, sf):
    monthly = aggregate.resample_month(_kept(spark, sf), SERIES_KEYS)
    promos = aggregate.monthly_promos(promotions_from_star(spark, sf, 0.1))
    return joins.add_promos(monthly, promos)


@query
def join_actuals(spark, sf):
    series = _series(spark, sf)
    ahead = calendar.extend_months(series, 1)
    joined = joins.join_actuals(ahead, series.select(*SERIES_KEYS, "ds", "y"))
    return joined.withColumn("y", F.coalesce("y", F.lit(-1)))


@query
def attach_regressors(spark, sf):
    monthly = aggregate.resample_month(_kept(spark, sf), SERIES_KEYS)
    promos = aggregate.monthly_promos(promotions_from_star(spark, sf, 0.1))
    known = joins.add_promos(monthly, promos).select(
        *SERIES_KEYS, F.col("sale_date").alias("ds"), "promos", "quantity"
    )
    ahead = calendar.extend_months(known, 2)
    joined = joins.attach_regressors(ahead, known, ["quantity"], ["promos"])
    return joined.withColumn("quantity", F.coalesce("quantity", F.lit(-1)))


# D. Aggregation and densification


@query
def aggregate_sales(spark, sf):
    keys = ["sale_date", "store", "city", "super_division", "product_division", "business_unit"]
    return aggregate.aggregate_sales(_kept(spark, sf), keys)


def _grid_totals(dense: DataFrame) -> DataFrame:
    return dense.groupBy("sale_date", "store").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("amount") == 0).alias("n_zero"),
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.sum("amount").cast("decimal(28,2)").alias("amount"),
    )


@query
def densify_observed(spark, sf):
    return _grid_totals(aggregate.densify(_kept(spark, sf)))


@query
def densify_calendar(spark, sf):
    return _grid_totals(aggregate.densify(_kept(spark, sf), axis="calendar"))


@query
def densify_monthly(spark, sf):
    return aggregate.densify(_kept(spark, sf), freq="M")


@query
def densify_daily_attributes(spark, sf):
    dense = aggregate.densify(
        _kept(spark, sf),
        attributes={
            "store": ("city", "postal_code"),
            "business_unit": ("super_division", "product_division"),
        },
        cut=True,
    )
    return _totals(
        dense, "store", "city", "postal_code", "business_unit", "super_division", "product_division"
    )


@query
def pivot_series(spark, sf):
    monthly = aggregate.resample_month(_kept(spark, sf), ["store"])
    return aggregate.pivot_series(monthly, "store", _stores(spark, sf))


@query
def unpivot_series(spark, sf):
    monthly = aggregate.resample_month(_kept(spark, sf), ["store"])
    stores = _stores(spark, sf)
    wide = aggregate.pivot_series(monthly, "store", stores)
    return aggregate.unpivot_series(wide, {s: {"store": s} for s in stores})


@query
def resample_month(spark, sf):
    return aggregate.resample_month(_kept(spark, sf), [*SERIES_KEYS, "product_division"])


@query
def resample_week(spark, sf):
    return aggregate.resample(_kept(spark, sf), ["store"], freq="W")


@query
def resample_event_week(spark, sf):
    events = _table(spark, sf, "events").select(
        F.col("event_type").alias("store"),
        F.col("ts").cast("date").alias("sale_date"),
        F.lit(1).alias("quantity"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
    )
    return aggregate.resample(events, ["store"], freq="W")


@query
def monthly_promos(spark, sf):
    monthly = aggregate.monthly_promos(promotions_from_star(spark, sf), keep_discount=True)
    return monthly.withColumn("discount_amount", F.round("discount_amount", 4))


@query
def series_frame(spark, sf):
    return _series(spark, sf)


@query
def series_frame_by_day(spark, sf):
    dense = aggregate.densify(
        _kept(spark, sf),
        attributes={"store": ("city",), "business_unit": ("super_division", "product_division")},
        cut=True,
    )
    flagged = dense.withColumn("black_week", calendar.black_week_flag(F.col("sale_date")))
    keys = ["store", "city", "super_division", "product_division", "business_unit", "black_week"]
    monthly = aggregate.resample_month(flagged, keys)
    return aggregate.series_frame(monthly, ["black_week"])


@query
def series_counts(spark, sf):
    return aggregate.series_counts(_kept(spark, sf))


def _standin(series: DataFrame) -> DataFrame:
    """A forecast that any engine can recompute exactly."""
    return series.withColumns(
        {
            "y": F.col("y").cast("double"),
            "yhat": F.col("y") * 0.75 + F.month("ds") - 4.0,
            "yhat_upper": F.col("y") * 1.25 + 1.0,
            "yhat_lower": F.col("y") * 0.5 - 9.0,
        }
    )


@query
def forecast_rollup(spark, sf):
    return aggregate.forecast_rollup(_standin(_series(spark, sf)), dt.date(2000, 1, 31))


@query
def sales_rollup(spark, sf):
    return aggregate.sales_rollup(_kept(spark, sf))


@query
def max_date(spark, sf):
    return aggregate.max_date(sales_from_star(spark, sf))


@query
def profile(spark, sf):
    sales = sales_from_star(spark, sf)
    return aggregate.profile(
        sales.withColumn("quantity", F.when(F.col("quantity") >= 0, F.col("quantity"))), exact=True
    )


@query
def profile_merged(spark, sf):
    """Sketches of every month merged; their estimates lie within the stated error of the exact counts."""
    sales = sales_from_star(spark, sf)
    masked = sales.withColumn("quantity", F.when(F.col("quantity") >= 0, F.col("quantity")))
    estimated = aggregate.merged_profile(materialise(aggregate.profile_sketches(masked)))
    exact = aggregate.profile(masked, exact=True).select("column_name", F.col("n_distinct").alias("exact"))
    off = F.abs(F.col("n_distinct") - F.col("exact"))
    return estimated.join(exact, "column_name").select(
        "column_name", "n_rows", "n_null", (off <= aggregate.SKETCH_ERROR * F.col("exact")).alias("within")
    )


@query
def distinct_values(spark, sf):
    return clean.distinct_values(sales_from_star(spark, sf), "business_unit")


# E. Folds and order


def _fold_totals(tagged: DataFrame, fold: str) -> DataFrame:
    return tagged.groupBy(*SERIES_KEYS, fold, "role").agg(
        F.count("*").alias("n_rows"),
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.sum("y").cast("bigint").alias("y"),
    )


@query
def time_series_folds(spark, sf):
    return _fold_totals(folds.time_series_folds(_series(spark, sf), 5), "fold")


@query
def rolling_origin_folds(spark, sf):
    return _fold_totals(folds.rolling_origin_folds(_series(spark, sf), CUTOFFS, 60), "cutoff")


@query
def rolling_origin_folds_complete(spark, sf):
    late = [*CUTOFFS, dt.date(2001, 11, 1)]
    tagged = folds.rolling_origin_folds(_series(spark, sf), late, 60, incomplete="skip")
    return _fold_totals(tagged, "cutoff")


@query
def order_output(spark, sf):
    return clean.order_output(_series(spark, sf))


@query
def preview_first(spark, sf):
    return clean.preview(_series(spark, sf), 10, ["store", "business_unit", "ds"])


@query
def preview_last(spark, sf):
    return clean.preview(_series(spark, sf), 10, ["store", "business_unit", "ds"], last=True)


@query
def best_trial(spark, sf):
    off = F.col("y") - 20
    scores = (
        _series(spark, sf)
        .groupBy(*SERIES_KEYS, F.month("ds").alias("trial_id"))
        .agg(F.round(F.sqrt(F.avg(off * off)), 3).alias("rmse"))
    )
    return metrics.best_trial(scores)


# F. Set operations


@query
def append(spark, sf):
    past, ahead = clean.split_by_date(_kept(spark, sf), TRAIN_END, "sale_date")
    stacked = clean.append(past, ahead.drop("city", "postal_code"))
    return stacked.groupBy(F.coalesce("city", F.lit("none")).alias("city"), "store").agg(
        F.count("*").alias("n_rows"), F.sum("quantity").alias("quantity")
    )


@query
def append_cells(spark, sf):
    """Two files that share a month, the second added twice as after a lost driver."""
    sales, path = _kept(spark, sf), f"{scratch_dir(spark)}/cells-{uuid.uuid4().hex}"
    past, ahead = clean.split_by_date(sales, dt.date(2001, 6, 12), "sale_date")
    for name, file in (("past", past), ("ahead", ahead), ("ahead", ahead)):
        cells.append_cells(file, path, name)
    return cells.read_cells(spark, path)


@query
def published_series(spark, sf):
    """The second of two versions, read back from its CSV files."""
    series, path = _series(spark, sf), f"{scratch_dir(spark)}/published-{uuid.uuid4().hex}"
    published.publish(series.filter(F.col("ds") <= TRAIN_END), path)
    published.publish(series, path)
    return published.read_published(spark, path)


# G. Calendar


@query
def future_frame(spark, sf):
    return calendar.future_frame(_kept(spark, sf))


@query
def future_frame_of_template(spark, sf):
    return calendar.future_frame(_kept(spark, sf), template_store="NATION_4", grain="month")


def _days(spark: SparkSession, sf: str) -> DataFrame:
    return clean.distinct_values(sales_from_star(spark, sf), "sale_date")


@query
def horizon_days(spark, sf):
    return _days(spark, sf).withColumn("days", calendar.horizon_days(F.col("sale_date")))


@query
def black_week_flag(spark, sf):
    day = F.col("sale_date")
    return _days(spark, sf).withColumns(
        {"black_week": calendar.black_week_flag(day), "november": calendar.november_flag(day)}
    )


def _as_line(df: DataFrame, products: tuple[str, ...], date: str) -> DataFrame:
    """The star's brands and years under the names and years a product line knows."""
    renamed = clean.replace_values(
        df, "business_unit", {f"Brand#{i + 1}": p for i, p in enumerate(products)}
    )
    return renamed.withColumn(date, F.last_day(F.add_months(date, 12 * YEARS_BACK)))


def _rule_totals(df: DataFrame) -> DataFrame:
    flags = [c for c in ("black_week", "christmas", "promos") if c in df.columns]
    return df.groupBy("business_unit", "sale_date", *flags).agg(
        F.count("*").alias("n_rows"), F.sum("quantity").cast("bigint").alias("quantity")
    )


@query
def calendar_rules_consoles(spark, sf):
    monthly = aggregate.resample_month(_kept(spark, sf), SERIES_KEYS)
    df = _as_line(monthly, fixed.CONSOLE_PRODUCTS, "sale_date")
    base = calendar.november_flag(F.col("sale_date"))
    df = calendar.apply_calendar_rules(df, fixed.CONSOLE_BLACK_WEEK, "black_week", base)
    return _rule_totals(calendar.apply_calendar_rules(df, fixed.CONSOLE_CHRISTMAS, "christmas"))


@query
def calendar_rules_suites(spark, sf):
    monthly = aggregate.resample_month(_kept(spark, sf), SERIES_KEYS)
    df = _as_line(monthly, fixed.SUITE_PRODUCTS, "sale_date")
    df = calendar.apply_calendar_rules(df, fixed.SUITE_BLACK_WEEK, "black_week")
    return _rule_totals(calendar.apply_calendar_rules(df, fixed.SUITE_CHRISTMAS, "christmas"))


@query
def calendar_rules_devices(spark, sf):
    monthly = aggregate.resample_month(_kept(spark, sf), SERIES_KEYS)
    promos = aggregate.monthly_promos(promotions_from_star(spark, sf, 0.1))
    df = joins.add_promos(monthly, promos)
    df = _as_line(df, fixed.DEVICE_PRODUCTS, "sale_date")
    df = calendar.apply_calendar_rules(df, fixed.DEVICE_BLACK_WEEK, "black_week")
    df = calendar.apply_calendar_rules(df, fixed.DEVICE_DECEMBER, "christmas")
    kept = F.col("promos")
    return _rule_totals(calendar.apply_calendar_rules(df, fixed.DEVICE_DECEMBER, "promos", kept))


@query
def calendar_rules_intended(spark, sf):
    rules = (
        Rule("Brand#1", (11,), (1995, 1996, 1998), 1),
        Rule("Brand#1", (11, 12), (1998, 1999), 2),
        Rule("Brand#2", (12,), (), 3),
    )
    monthly = aggregate.resample_month(_kept(spark, sf), SERIES_KEYS)
    return _rule_totals(
        calendar.apply_calendar_rules(monthly, rules, "promos", profile="intended")
    )


@query
def black_friday_window(spark, sf):
    return calendar.black_friday_window(_years(spark, sf))


def _trading_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return (
        sales_from_star(spark, sf)
        .groupBy(F.col("postal_code").alias("holiday"))
        .agg(F.min("sale_date").alias("start"), F.max("sale_date").alias("end"))
    )


@query
def event_calendar(spark, sf):
    return calendar.event_calendar(_trading_ranges(spark, sf))


@query
def event_calendar_daily(spark, sf):
    days = calendar.event_calendar(_trading_ranges(spark, sf), freq="D")
    return days.groupBy("ds").agg(F.count("*").alias("n_events"))


@query
def german_holidays(spark, sf):
    return calendar.german_holidays(_years(spark, sf))


@query
def extend_months(spark, sf):
    return calendar.extend_months(_series(spark, sf), 2)


@query
def calendar_features(spark, sf):
    shifted = _series(spark, sf).withColumn("ds", F.last_day(F.add_months("ds", 12 * YEARS_BACK)))
    featured = calendar.calendar_features(shifted, fixed.TWEEDIE_LOCKDOWNS)
    return featured.groupBy("ds", "year", "month", "corona_lockdown").agg(
        F.count("*").alias("n_rows")
    )


@query
def cutoffs(spark, sf):
    bounds = sales_from_star(spark, sf).agg(
        F.min("sale_date").alias("start"), F.max("sale_date").alias("end")
    )
    return calendar.cutoffs(bounds, 2)


# H. Post-processing and metrics


@query
def clip_negative(spark, sf):
    return metrics.clip_negative(_standin(_series(spark, sf))).select(
        *SERIES_KEYS, "ds", "yhat", "yhat_upper", "yhat_lower"
    )


@query
def round_up_above(spark, sf):
    shared = _series(spark, sf).withColumns(
        {"yhat": F.col("y") / 7.0 - 2.0, "yhat_upper": F.col("y") / 5.0, "yhat_lower": -F.col("y") / 3.0}
    )
    return metrics.round_up_above(shared).select(
        *SERIES_KEYS, "ds", "yhat", "yhat_upper", "yhat_lower"
    )


def _rounded(scored: DataFrame) -> DataFrame:
    kinds = dict(scored.dtypes)
    return scored.withColumns({c: F.round(c, 6) for c, k in kinds.items() if k == "double"})


@query
def score(spark, sf):
    fitted = _standin(_series(spark, sf))
    return _rounded(metrics.score(clean.date_slice(fitted, dt.date(2001, 1, 31)), ["store"]))


@query
def score_one_date(spark, sf):
    fitted = _standin(_series(spark, sf))
    return _rounded(metrics.score(clean.date_slice(fitted, TRAIN_END, TRAIN_END)))


@query
def cv_metrics(spark, sf):
    fitted = _standin(_series(spark, sf)).withColumn("trial_id", F.quarter("ds"))
    return _rounded(metrics.cv_metrics(fitted))


# I. Models


def _config(**changes) -> design.ForecastConfig:
    return design.ForecastConfig(**{"train_end": TRAIN_END, **changes})


@query
def design_matrix(spark, sf):
    cfg = _config()
    rows = design.with_future(design.series_rows(_series(spark, sf), cfg, unique=True), cfg)
    points = design.design_matrix(rows, cfg)

    def total(first, count):
        return F.aggregate(F.slice("x", first, count), F.lit(0.0), lambda a, v: a + v)

    waves = 2 * cfg.yearly_order
    return points.select(
        *SERIES_KEYS,
        "ds",
        "is_train",
        "n_cp",
        "n_season",
        F.round("t", 6).alias("t"),
        F.round(total(3, F.col("n_cp")), 6).alias("hinges"),
        F.round(total(F.col("n_cp") + 3, F.lit(waves)), 6).alias("waves"),
        total(F.col("n_cp") + waves + 3, F.size("x") - F.col("n_cp") - waves - 3).alias("flags"),
        F.size("x").alias("width"),
    )


SMALL = dict(changepoints=3, yearly_order=1, events=(), country_holidays=False)


@query
def simulated_interval(spark, sf):
    series = _series(spark, sf)
    known = series.filter(F.col("ds") <= TRAIN_END).groupBy("store", "business_unit")
    known = known.agg(
        F.min("ds").alias("first"), F.max("ds").alias("last"), F.avg("y").alias("yhat"), F.stddev_pop("y").alias("noise")
    )
    days = F.datediff("ds", "first") / F.datediff("last", "first")
    ahead = series.filter(F.col("ds") > TRAIN_END).join(known, ["store", "business_unit"])
    steps = ahead.select(
        "store", "business_unit", "ds", days.alias("t"), "yhat", "noise", F.col("noise").alias("bend"), F.lit(25).alias("rate")
    )
    found = simulate.simulated_interval(steps, ["store", "business_unit"], draws=100)
    return found.withColumns({c: F.round(c, 4) for c in ("lower", "upper")}).withColumn("ds", F.col("ds").cast("string"))


@query
def normal_stats(spark, sf):
    cfg = _config(**SMALL)
    rows = design.with_future(design.series_rows(_series(spark, sf), cfg, unique=True), cfg)
    stats = design.normal_stats(design.design_matrix(rows, cfg))
    return stats.withColumn("total", F.round("total", 4))


@query
def forecast(spark, sf):
    return additive.forecast(_series(spark, sf), _config(), run_date=RUN_DATE, unique=True)


@query
def forecast_optimum(spark, sf):
    """Every fit has settled, and its objective is flat there."""
    found = additive.optimum(_series(spark, sf), _config(), unique=True)
    return found.select(*SERIES_KEYS, F.col("settled").cast("int").alias("settled"), F.round("slope", 4).alias("slope"))


@query
def grid_search(spark, sf):
    return search.search(
        _series(spark, sf), _config(), search.grid_trials(), CUTOFFS, 60, unique=True
    )


@query
def grid_search_forecast(spark, sf):
    _, fitted = search.grid_search(
        _series(spark, sf), _config(), CUTOFFS, 60, run_date=RUN_DATE, unique=True
    )
    return fitted


@query
def random_search(spark, sf):
    trials = search.random_trials(fixed.TRIALS_SHORT, seed=7)
    return search.search(_series(spark, sf), _config(), trials, CUTOFFS, 30, unique=True)


@query
def halving_search(spark, sf):
    """All 100 draws."""
    trials = search.random_trials(seed=7)
    return search.halving(_series(spark, sf), _config(), trials, CUTOFFS, 30, unique=True)


@query
def search_agreement(spark, sf):
    """Winners of both searches against errors computed from every single prediction of the grid."""
    frame, cfg, grid = materialise(_series(spark, sf)), _config(), search.grid_trials()
    points = additive.cross_validate(frame, cfg, grid, CUTOFFS, 60, unique=True)
    scores = materialise(metrics.cv_metrics(points))
    least = scores.groupBy(*SERIES_KEYS).agg(F.min("rmse").alias("least"), F.max("n_scored").alias("n_scored"))
    found = least
    for name, best in (
        ("searched", search.search(frame, cfg, grid, CUTOFFS, 60, unique=True)),
        ("halved", search.halving(frame, cfg, grid, CUTOFFS, 60, unique=True)),
    ):
        # The error reported is that of the trial named, and no trial has a smaller one.
        named = best.select(*SERIES_KEYS, "trial_id", F.col("rmse").alias("reported"))
        own = named.join(scores, [*SERIES_KEYS, "trial_id"]).select(*SERIES_KEYS, "reported", "rmse")
        room = 1e-6 * (1 + F.col("least"))
        fits = (F.abs(F.col("reported") - F.col("rmse")) <= room) & (F.col("rmse") <= F.col("least") + room)
        found = found.join(own, SERIES_KEYS).withColumn(name, fits).drop("reported", "rmse")
    return found.drop("least")


@query
def tweedie_forecast(spark, sf):
    cfg = tweedie.TweedieConfig(train_end=TRAIN_END, valid_from=dt.date(2001, 8, 31))
    return tweedie.tweedie_forecast(_series(spark, sf), cfg, run_date=RUN_DATE)


@query
def tweedie_optimum(spark, sf):
    """The scores of the penalised likelihood are zero at the fit; no feature repeats another."""
    cfg = tweedie.TweedieConfig(train_end=TRAIN_END, valid_from=dt.date(2001, 8, 31))
    found = tweedie.optimum(_series(spark, sf), cfg, tweedie.RIDGE[0])
    return found.select("parameter", F.round("score", 4).alias("score"))


@query
def boosting_histogram(spark, sf):
    """Sums of the first level of the first tree: gradients and hessians by feature and bin."""
    cfg = tweedie.TweedieConfig(train_end=TRAIN_END, valid_from=dt.date(2001, 8, 31))
    known = clean.split_by_date(_series(spark, sf), TRAIN_END, "ds")[0]
    wide, names = boosting.features(known, known, cfg, SERIES_KEYS)
    bins = boosting.binned(wide, names, boosting.cut_points(wide, names))
    marked = wide.select(F.lit(0).alias("model"), F.lit(True).alias("train"), bins.alias("bins"), "y")
    state = boosting.cells(marked).withColumn("margin", F.log(known.agg(F.avg("y")).scalar()))
    sums = boosting.histogram(state, cfg.power, F.lit(0))
    named = F.get(F.array(*[F.lit(n) for n in names]), F.col("feature"))
    return sums.select(named.alias("feature"), "bin", F.round("g", 4).alias("g"), F.round("h", 4).alias("h"))


@query
def boosted_forecast(spark, sf):
    cfg = tweedie.TweedieConfig(train_end=TRAIN_END, valid_from=dt.date(2001, 8, 31))
    return boosting.boosted_forecast(_series(spark, sf), cfg, run_date=RUN_DATE)


@query
def tag_split(spark, sf):
    tagged = tweedie.tag_split(_series(spark, sf), TRAIN_END, dt.date(2001, 8, 31))
    return tagged.groupBy("store", "is_train", "is_valid", "is_predict").agg(
        F.count("*").alias("n_rows"), F.sum("y").cast("bigint").alias("y")
    )


# J. Publishing


@query
def publish_historic(spark, sf):
    historic, _ = product_line.publish_frames(_standin(_series(spark, sf)), TRAIN_END)
    return historic


@query
def publish_predicted(spark, sf):
    _, predicted = product_line.publish_frames(_standin(_series(spark, sf)), TRAIN_END)
    return predicted


@query
def publish_database(spark, sf):
    fitted = _standin(_series(spark, sf))
    _, predicted = product_line.database_frames(fitted, dt.date(2001, 1, 1))
    return predicted


# K. Grouped functions, SQL and product lines


def _running(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    ordered = pdf.sort_values("ds")
    return ordered.assign(running=ordered["y"].cumsum())[["store", "business_unit", "ds", "running"]]


@query
def apply_per_series(spark, sf):
    schema = "store string, business_unit string, ds date, running bigint"
    columns = [*SERIES_KEYS, "ds", "y"]
    return additive.apply_per_series(_series(spark, sf).select(*columns), _running, schema)


@query
def register_sales(spark, sf):
    return product_line.register_sales(_series(spark, sf), "monthly_sales")


RAW_HEADERS = {v: k for k, v in fixed.RAW_COLUMNS.items()}


def _raw_line(spark: SparkSession, sf: str, products: tuple[str, ...], level: str) -> DataFrame:
    """The star's sales with raw headers, an organisation id instead of a store, and a country."""
    sales = sales_from_star(spark, sf).withColumn(
        "sale_date", F.add_months("sale_date", 12 * YEARS_BACK)
    )
    names = {f"Brand#{i + 1}": p for i, p in enumerate(products)}
    known = clean.replace_values(sales, "business_unit", names)
    if level == "product_division":
        known = known.withColumn("product_division", F.col("business_unit"))
    raw = known.withColumnsRenamed({c: RAW_HEADERS[c] for c in known.columns if c != "store"})
    return raw.withColumns(
        {
            fixed.RAW_ORG_ID: F.col(RAW_HEADERS["postal_code"]),
            fixed.RAW_COUNTRY: F.when(F.col("store") == "NATION_8", "Austria").otherwise("Germany"),
        }
    ).drop("store")


def _dimension(spark: SparkSession, sf: str) -> DataFrame:
    nation = _table(spark, sf, "nation")
    return (
        _table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.lpad(F.col("s_suppkey").cast("string"), 5, "0").alias(fixed.DIM_ORG_ID),
            F.col("n_name").alias(fixed.DIM_STORE),
        )
    )


def _line_inputs(spark: SparkSession, sf: str, products: tuple[str, ...], level: str):
    """Raw sales from 2020 on, history before that, and the store dimension."""
    raw = _raw_line(spark, sf, products, level)
    split = F.lit(dt.date(2020, 1, 1))
    dimension = _dimension(spark, sf)
    past = joins.map_lookup(
        raw.filter(F.col("Sales Date") < split),
        dimension,
        fixed.RAW_ORG_ID,
        fixed.DIM_ORG_ID,
        fixed.DIM_STORE,
        "Store_names",
    )
    history = canonicalise(past).filter(F.col("business_unit").isin(list(products)))
    return raw.filter(F.col("Sales Date") >= split), clean.drop_returns(history), dimension


@query
def console_line_frame(spark, sf):
    line = lines.CONSOLES_FROM_UNION
    raw, history, dimension = _line_inputs(spark, sf, fixed.CONSOLE_PRODUCTS, "business_unit")
    new = product_line.dense_sales(product_line.clean_sales(raw, line, history, dimension), line)
    merged = product_line.merged_sales(new, history, line)
    return product_line.model_frame(merged, line)


@query
def suite_line_merged(spark, sf):
    line = lines.SUITES
    raw, history, dimension = _line_inputs(spark, sf, fixed.SUITE_PRODUCTS, "business_unit")
    open_divisions = dict(zip(("SMALL GOODS", "LARGE GOODS"), fixed.SUITE_DIVISIONS))
    raw = clean.replace_values(raw, "Super Division", open_divisions)
    new = product_line.dense_sales(product_line.clean_sales(raw, line, history, dimension), line)
    return _totals(
        product_line.merged_sales(new, history, line), "store", "super_division", "business_unit"
    )


def _device_inputs(spark: SparkSession, sf: str):
    raw, history, dimension = _line_inputs(spark, sf, fixed.DEVICE_PRODUCTS, "product_division")
    raw = raw.withColumn("Super Division", F.lit(fixed.DEVICE_DIVISIONS[0]))
    promos = promotions_from_star(spark, sf).withColumn(
        "sale_date", F.add_months("sale_date", 12 * YEARS_BACK)
    )
    names = {f"Brand#{i + 1}": p for i, p in enumerate(fixed.DEVICE_PRODUCTS)}
    promos = clean.replace_values(promos, "business_unit", names)
    return raw, history.drop("product_division"), dimension, promos


@query
def device_line_frame(spark, sf):
    line = lines.DEVICES_WITH_CHRISTMAS
    raw, history, dimension, promos = _device_inputs(spark, sf)
    new = product_line.dense_sales(product_line.clean_sales(raw, line, history, dimension), line)
    return product_line.model_frame(product_line.merged_sales(new, history, line), line, promos)


@query
def device_line_forecast(spark, sf):
    raw, history, dimension, promos = _device_inputs(spark, sf)
    frames = product_line.run_product_line(
        lines.DEVICES_WITH_CHRISTMAS,
        raw,
        history,
        dimension,
        promos,
        dt.date(2021, 9, 30),
        RUN_DATE,
    )
    return frames["predicted"]
