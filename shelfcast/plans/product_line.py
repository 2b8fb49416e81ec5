"""From raw sales to published forecasts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfcast import fixed_values as fixed
from shelfcast.functions.calendar import apply_calendar_rules, future_frame, november_flag
from shelfcast.functions.metrics import round_up_above, score
from shelfcast.models.additive import forecast
from shelfcast.models.design import ForecastConfig
from shelfcast.models.search import Trial, search
from shelfcast.operators import clean
from shelfcast.operators.aggregate import densify, monthly_promos
from shelfcast.operators.joins import add_promos, map_lookup
from shelfcast.plans.lines import LineConfig
from shelfcast.session import materialise
from shelfcast.sources.readers import canonicalise, typed_and_rejected

CARRIED = {
    "store": ("city", "postal_code"),
    "business_unit": ("super_division", "product_division"),
}


def clean_sales(
    raw: DataFrame, line: LineConfig, history: DataFrame, dimension: DataFrame | None = None
) -> DataFrame:
    """Raw sales of one line in canonical form: mapped, filtered, merged and of eligible stores.

    ``raw`` holds either the raw headers or canonical ones. A dimension maps organisation ids to
    store names; without one the frame names its stores itself.
    """
    return clean_typed(canonicalise(line_rows(raw, line, dimension)), line, history)


def line_rows(raw: DataFrame, line: LineConfig, dimension: DataFrame | None = None) -> DataFrame:
    """Raw sales of the line's country, with their store names."""
    df = raw
    if dimension is not None:
        df = df.drop("Store_names", "store")
        df = map_lookup(
            df, dimension, fixed.RAW_ORG_ID, fixed.DIM_ORG_ID, fixed.DIM_STORE, "Store_names"
        )
    if fixed.RAW_COUNTRY in df.columns:
        df = clean.filter_equals(df, fixed.RAW_COUNTRY, line.country)
    return df


def clean_typed(sales: DataFrame, line: LineConfig, history: DataFrame) -> DataFrame:
    """Canonical sales of one line, filtered, merged and of eligible stores."""
    df = clean.drop_returns(sales)
    if line.store_merges:
        df = clean.replace_values(df, "store", line.store_merges)
    if line.super_divisions:
        df = clean.filter_in(df, "super_division", line.super_divisions)
    if line.promote:
        df = clean.promote_level(df)
    if line.successors:
        df = clean.replace_values(df, "business_unit", line.successors)
    df = clean.filter_in(df, "business_unit", line.products)
    for column in ("business_unit", "product_division"):
        if line.product_merges and column in df.columns:
            df = clean.replace_values(df, column, line.product_merges)
    df = clean.replace_regex(df, "city", line.city_patterns)
    df = clean.replace_values(df, "city", line.city_fixes)
    df = clean.keep_eligible(df, open_history(history, line))
    return clean.drop_closed(df, line.closed_stores) if "new" in line.closed_in else df


def open_history(history: DataFrame, line: LineConfig) -> DataFrame:
    """History without closed stores, for the lines that close them there."""
    return clean.drop_closed(history, line.closed_stores) if "history" in line.closed_in else history


def dense_sales(sales: DataFrame, line: LineConfig, cut: bool = True) -> DataFrame:
    """Daily sales of every observed series on every observed date, with last-known attributes."""
    carried = {
        key: tuple(a for a in names if a in sales.columns) for key, names in CARRIED.items()
    }
    complete = sales.dropna(subset=[k for k in line.group_keys if k in sales.columns])
    return densify(complete, attributes=carried, cut=cut)


def merged_sales(new: DataFrame, history: DataFrame, line: LineConfig) -> DataFrame:
    """History followed by the new dense sales."""
    merged = clean.append(open_history(history, line), new)
    return clean.drop_closed(merged, line.closed_stores) if "union" in line.closed_in else merged


def model_frame(
    sales: DataFrame,
    line: LineConfig,
    promotions: DataFrame | None = None,
    template_store: str | None = None,
    profile: str = "reference",
) -> DataFrame:
    """Monthly model input with regressors, reaching to the end of the month after the last sale.

    The future part of the frame is flagged ``is_future``: its months hold no sale yet. Repeated rows count once.
    A cell without a sale changes no sum, so only the others are compared as whole rows; the empty ones are taken
    together by month before they are shuffled.
    """
    levels = [c for c in line.levels if c in sales.columns]
    future = future_frame(sales, template_store, levels=levels, grain="month")
    keys = ["store", "city", *levels, "business_unit"]
    empty = F.coalesce("quantity", F.lit(0)) == 0
    months = sales.filter(empty).dropna(subset=[*keys, "sale_date"])
    months = months.groupBy(*keys, F.last_day("sale_date").alias("sale_date")).agg(F.sum("quantity").alias("quantity"))
    rows = clean.append(
        clean.dedup(sales.filter(~empty)).withColumn("is_future", F.lit(False)),
        months.withColumn("is_future", F.lit(False)),
        future.withColumn("is_future", F.lit(True)),
    )
    monthly = (
        rows.dropna(subset=[*keys, "sale_date"])
        .groupBy(*keys, F.last_day("sale_date").alias("sale_date"))
        .agg(
            F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("quantity"),
            F.bool_and("is_future").alias("is_future"),
        )
    )
    if line.promotions:
        if promotions is None:
            raise ValueError(f"{line.name} needs a promotion calendar")
        monthly = add_promos(monthly, monthly_promos(promotions))
    for flag in line.flags:
        base = {
            "november": november_flag(F.col("sale_date")),
            "zero": F.lit(0),
            "keep": F.col(flag.column) if flag.column in monthly.columns else F.lit(0),
        }[flag.base]
        monthly = apply_calendar_rules(monthly, flag.rules, flag.column, base, profile)
    return monthly.select(
        *keys,
        *line.regressors,
        F.col("sale_date").alias("ds"),
        F.col("quantity").alias("y"),
        "is_future",
    )


def monthly_series(sales: DataFrame, cut: bool = True) -> DataFrame:
    """Dense monthly series frame of any canonical sales, with November and December flags.

    Sums to months before filling, reads the input once, and is one row per series and month.
    """
    dense = densify(
        sales,
        freq="M",
        attributes={"store": ("city",), "business_unit": ("super_division", "product_division")},
        cut=cut,
    )
    return dense.select(
        "store",
        "city",
        "super_division",
        "product_division",
        "business_unit",
        november_flag(F.col("sale_date")).alias("black_week"),
        (F.month("sale_date") == 12).cast("int").alias("christmas"),
        F.col("sale_date").alias("ds"),
        F.col("quantity").cast("bigint").alias("y"),
    )


def publish_frames(
    forecast_frame: DataFrame, train_end: dt.date
) -> tuple[DataFrame, DataFrame]:
    """Historic frame (all distinct rows) and predicted frame (rows after the training end, rounded)."""
    historic = clean.dedup(forecast_frame)
    _, ahead = clean.split_by_date(historic, train_end)
    return historic, round_up_above(ahead)


def database_frames(
    forecast_frame: DataFrame, since: dt.date = fixed.PREDICTION_FROM
) -> tuple[DataFrame, DataFrame]:
    """Frames for the relational sink: the whole forecast, and its rounded rows from a date on."""
    return forecast_frame, round_up_above(clean.date_slice(forecast_frame, since))


def run_product_line(
    line: LineConfig,
    raw: DataFrame,
    history: DataFrame,
    dimension: DataFrame | None = None,
    promotions: DataFrame | None = None,
    train_end: dt.date = fixed.TRAIN_END,
    run_date: dt.date | None = None,
    template_store: str | None = None,
    profile: str = "reference",
    trials: Sequence[Trial] | None = None,
    cutoffs: Sequence[dt.date] = (),
    horizon: int = 60,
) -> dict[str, DataFrame]:
    """All frames of one line: merged daily sales, model frame, forecast, historic and predicted, scores.

    With ``trials``, each series is first searched for its best priors over ``cutoffs``, and fitted with those;
    they are the frame ``best``. ``rejects`` holds the raw rows of the line's country with a value that could not be
    typed, ``reject_counts`` their number by column; they come from the scan that reads the sales. Scores are of the fit on its training points, in all and by product.
    The merged sales and the forecast feed several frames each, so both are written once to the
    checkpoint folder.
    """
    typed, rejects = typed_and_rejected(line_rows(raw, line, dimension))
    new = dense_sales(clean_typed(typed, line, history), line)
    merged = materialise(merged_sales(new, history, line))
    base = merged if line.model_base == "union" else new
    frame = model_frame(base, line, promotions, template_store, profile)
    cfg = ForecastConfig(regressors=line.regressors, train_end=train_end)
    best = None
    if trials:
        if not cutoffs:
            raise ValueError("a search needs cutoffs")
        frame = materialise(frame)
        best = materialise(search(frame, cfg, trials, cutoffs, horizon))
    fitted = materialise(forecast(frame, cfg, best=best, run_date=run_date))
    known = fitted.filter("is_train")
    fitted = fitted.drop("is_train")
    historic, predicted = publish_frames(fitted, train_end)
    frames = {
        "merged": merged,
        "model_frame": frame,
        "forecast": fitted,
        "historic": historic,
        "predicted": predicted,
        "scores": score(known),
        "scores_by_product": score(known, ["business_unit"]),
        "rejects": rejects,
        "reject_counts": rejects.select(F.explode("rejected").alias("column_name")).groupBy("column_name").agg(
            F.count("*").alias("n_rows")
        ),
    }
    return frames | ({"best": best} if best is not None else {})


def register_sales(frame: DataFrame, name: str = "sales") -> DataFrame:
    """Register a model frame or monthly sales as a view and return the per-series counts by SQL."""
    frame.createOrReplaceTempView(name)
    return frame.sparkSession.sql(
        f"SELECT store, city, business_unit, count(*) AS n_rows FROM {name} "
        "GROUP BY store, city, business_unit"
    )
