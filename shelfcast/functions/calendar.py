"""Calendar features, events and future dates."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.fixed_values import Rule
from shelfcast.operators.joins import last_attribute
from shelfcast.session import materialise

# Pairs of store and product that meet in one part of the join, about.
_PAIRS = 1_000_000


def period_end(date: Column, freq: str) -> Column:
    """Last day of the day's own day, week (Sunday) or month."""
    if freq == "D":
        return date
    if freq == "W":
        return F.date_add(F.date_trunc("week", date).cast("date"), 6)
    if freq == "M":
        return F.last_day(date)
    raise ValueError(f"freq: {freq}")


def horizon_days(date: Column) -> Column:
    """Days from a date to the end of the next month."""
    return F.datediff(F.last_day(F.add_months(date, 1)), date)


def black_week_flag(date: Column) -> Column:
    """1 in the last week of November."""
    return ((F.month(date) == 11) & (F.dayofmonth(date) > 23)).cast("int")


def november_flag(date: Column) -> Column:
    return (F.month(date) == 11).cast("int")


def effective(listed: Sequence[int], profile: str) -> tuple[int, ...]:
    """Years or months a rule really applies to.

    "intended" takes the list as it stands. "reference" joins it into one number bit by bit, which is
    what published results were made with: 2017, 2018 and 2019 give 2019 alone.
    """
    if profile == "intended" or not listed:
        return tuple(listed)
    if profile == "reference":
        return (reduce(or_, listed),)
    raise ValueError(f"profile: {profile}")


def calendar_rules(
    rules: Iterable[Rule],
    default: Column | int,
    profile: str = "reference",
    date: str = "sale_date",
    product: str = "business_unit",
) -> Column:
    """Value of the last rule that matches product, month and year; ``default`` where none does."""
    choice: Column | None = None
    for rule in reversed(list(rules)):
        hit = (F.col(product) == rule.product) & F.month(date).isin(
            list(effective(rule.months, profile))
        )
        if rule.years:
            hit = hit & F.year(date).isin(list(effective(rule.years, profile)))
        choice = F.when(hit, rule.value) if choice is None else choice.when(hit, rule.value)
    fallback = default if isinstance(default, Column) else F.lit(default)
    return fallback if choice is None else choice.otherwise(fallback)


def apply_calendar_rules(
    df: DataFrame,
    rules: Iterable[Rule],
    target: str,
    default: Column | int = 0,
    profile: str = "reference",
    date: str = "sale_date",
    product: str = "business_unit",
) -> DataFrame:
    """Set ``target`` by ordered rules, as one CASE expression."""
    return df.withColumn(target, calendar_rules(rules, default, profile, date, product))


def black_friday_window(years: DataFrame) -> DataFrame:
    """Days from four before to one after the fourth Friday of November, and Cyber Monday, per year.

    ``years`` has one column ``year``.
    """
    friday = F.date_add(
        F.next_day(F.make_date(F.col("year"), F.lit(10), F.lit(31)), "FRI"), 21
    )
    days = F.transform(
        F.sequence(F.date_sub("friday", 4), F.date_add("friday", 1)),
        lambda d: F.struct(F.lit("black_friday").alias("event"), d.alias("ds")),
    )
    monday = F.array(
        F.struct(F.lit("cyber_monday").alias("event"), F.date_add("friday", 3).alias("ds"))
    )
    return years.select("year", friday.alias("friday")).select(
        "year", F.inline(F.concat(days, monday))
    )


def event_dates(
    ranges: Iterable[tuple[str, dt.date, dt.date]], freq: str = "M"
) -> list[tuple[str, dt.date]]:
    """The events of a short literal list of ranges: their month ends, or all their days."""
    events = []
    for name, start, end in ranges:
        for offset in range((end - start).days + 1):
            day = start + dt.timedelta(days=offset)
            if freq == "D" or (day + dt.timedelta(days=1)).day == 1:
                events.append((name, day))
    return events


def event_calendar(ranges: DataFrame, freq: str = "M") -> DataFrame:
    """Events from ranges (``holiday``, ``start``, ``end``): their month ends, or all their days."""
    days = ranges.select("holiday", F.explode(F.sequence("start", "end")).alias("ds"))
    return days if freq == "D" else days.filter(F.col("ds") == F.last_day("ds"))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by integer arithmetic (the anonymous computus)."""

    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    golden = year % 19
    century = div(year, 100)
    rest = year % 100
    drift = div(century, 4) + div(century - div(century + 8, 25) + 1, 3)
    moon = (golden * 19 + century - drift + 15) % 30
    weekday = (century % 4 * 2 + div(rest, 4) * 2 - moon - rest % 4 + 32) % 7
    shift = div(golden + moon * 11 + weekday * 22, 451)
    serial = moon + weekday - shift * 7 + 114
    return F.make_date(year, div(serial, 31), serial % 31 + 1)


# Nationwide German holidays, by date and by distance from Easter Sunday.
FIXED_HOLIDAYS = (
    ("Neujahr", 1, 1),
    ("Erster Mai", 5, 1),
    ("Tag der Deutschen Einheit", 10, 3),
    ("Erster Weihnachtstag", 12, 25),
    ("Zweiter Weihnachtstag", 12, 26),
)
EASTER_HOLIDAYS = (
    ("Karfreitag", -2),
    ("Ostermontag", 1),
    ("Christi Himmelfahrt", 39),
    ("Pfingstmontag", 50),
)
SINGLE_HOLIDAYS = (("Reformationstag", 2017, 10, 31),)
HOLIDAY_NAMES = tuple(h[0] for h in (*FIXED_HOLIDAYS, *EASTER_HOLIDAYS, *SINGLE_HOLIDAYS))


def holiday_dates(year: Column) -> list[tuple[str, Column]]:
    """Date of every nationwide holiday in a year; null where a year does not have it."""
    easter = easter_sunday(year)
    dates = [(n, F.make_date(year, F.lit(m), F.lit(d))) for n, m, d in FIXED_HOLIDAYS]
    dates += [(n, F.date_add(easter, offset)) for n, offset in EASTER_HOLIDAYS]
    dates += [
        (n, F.when(year == y, F.make_date(year, F.lit(m), F.lit(d))))
        for n, y, m, d in SINGLE_HOLIDAYS
    ]
    return dates


def holiday_flags(date: Column, easter: Column) -> list[Column]:
    """Whether a date is each of the nationwide holidays, given Easter Sunday of its year."""
    month, day = F.month(date), F.dayofmonth(date)
    flags = [(month == m) & (day == d) for _, m, d in FIXED_HOLIDAYS]
    flags += [F.datediff(date, easter) == offset for _, offset in EASTER_HOLIDAYS]
    return flags + [date == F.lit(dt.date(y, m, d)) for _, y, m, d in SINGLE_HOLIDAYS]


def german_holidays(years: DataFrame) -> DataFrame:
    """Nationwide German holidays of the years in column ``year``."""
    entries = F.array(
        *[
            F.struct(F.lit(n).alias("holiday"), day.alias("ds"))
            for n, day in holiday_dates(F.col("year"))
        ]
    )
    return years.select("year", F.inline(entries)).filter(F.col("ds").isNotNull())


def next_period_ends(last: Column, periods: int, freq: str = "M") -> Column:
    """Array of the next ``periods`` month ends (or days) strictly after a date."""
    steps = F.sequence(F.lit(1), F.lit(periods))
    if freq == "D":
        return F.transform(steps, lambda k: F.date_add(last, k))
    # A date before its own month end reaches that one first.
    back = F.when(last == F.last_day(last), 0).otherwise(1)
    return F.transform(steps, lambda k: F.last_day(F.add_months(last, k - back)))


def extend_months(
    series: DataFrame, periods: int, keys: Sequence[str] = ("store", "business_unit")
) -> DataFrame:
    """History dates of each series plus its next ``periods`` month ends, flagged ``is_future``."""
    last = series.groupBy(*keys).agg(F.max("ds").alias("last"))
    future = last.select(
        *keys,
        F.explode(next_period_ends(F.col("last"), periods)).alias("ds"),
        F.lit(True).alias("is_future"),
    )
    return series.select(*keys, "ds", F.lit(False).alias("is_future")).unionByName(future)


def calendar_features(
    df: DataFrame, lockdowns: Iterable[tuple[str, dt.date, dt.date]], date: str = "ds"
) -> DataFrame:
    """Year, month and the lockdown indicator, which is 0 on a lockdown month end and 1 elsewhere."""
    closed = sorted({day for _, day in event_dates(lockdowns)})
    return df.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "corona_lockdown": F.when(F.col(date).isin(closed), 0).otherwise(1),
        }
    )


def cutoff_array(start: Column, end: Column, step: int) -> Column:
    """Month starts from the first one on or after ``start`` up to ``end``, every ``step`` months."""
    first = F.when(start == F.trunc(start, "MM"), start).otherwise(
        F.add_months(F.trunc(start, "MM"), 1)
    )
    months = F.sequence(first, F.greatest(first, end), F.make_ym_interval(F.lit(0), F.lit(step)))
    return F.filter(months, lambda d: d <= end)


def cutoffs(bounds: DataFrame, step: int) -> DataFrame:
    """Cutoff dates between the columns ``start`` and ``end``."""
    return bounds.select(F.explode(cutoff_array(F.col("start"), F.col("end"), step)).alias("cutoff"))


def future_frame(
    df: DataFrame,
    template_store: str | None = None,
    attributes: Sequence[str] = ("city", "postal_code"),
    levels: Sequence[str] = ("super_division", "product_division"),
    grain: str = "day",
    date: str = "sale_date",
) -> DataFrame:
    """Zero rows from the day after the last date to the end of the next month.

    Every store gets every template product: the products sold anywhere on the last date, or in
    ``template_store`` on it. The store's last attributes come along. With ``grain="month"`` one row
    per month end stands for its days.

    ``df`` is read once, for the last date of each combination of its keys; that table is written and gives
    the last date, the template and the stores. The result is stores x products x days by definition; stores and
    products meet in an equi-join on a pair of part numbers, of which there are as many as the pairs need,
    so that no side is broadcast whole or kept in one task.
    """
    levels = [c for c in levels if c in df.columns]
    attributes = [c for c in attributes if c in df.columns]
    keys = ["store", *attributes, *levels, "business_unit"]
    seen = materialise(df.groupBy(*keys).agg(F.max(date).alias(date)))
    last = seen.agg(F.max(date)).scalar()
    template = seen.filter(F.col(date) == last)
    if template_store is not None:
        template = template.filter(F.col("store") == template_store)
    products = template.select(*levels, "business_unit").distinct()
    stores = last_attribute(seen, "store", attributes, date)
    n_parts = math.isqrt(stores.count() * products.count() // _PAIRS) + 1
    parts = F.sequence(F.lit(0), F.lit(n_parts - 1))
    stores = stores.select(
        "store",
        *attributes,
        F.pmod(F.hash("store"), F.lit(n_parts)).alias("_store_part"),
        F.explode(parts).alias("_product_part"),
    )
    products = products.select(
        *levels,
        "business_unit",
        F.pmod(F.hash(*levels, "business_unit"), F.lit(n_parts)).alias("_product_part"),
        F.explode(parts).alias("_store_part"),
    )
    pairs = stores.join(products, ["_store_part", "_product_part"]).withColumn("_last", last)
    first, end = F.date_add("_last", 1), F.last_day(F.add_months("_last", 1))
    if grain == "day":
        days = F.sequence(first, end)
    elif grain == "month":
        month = F.make_ym_interval(F.lit(0), F.lit(1))
        starts = F.sequence(F.trunc(first, "MM"), F.trunc(end, "MM"), month)
        days = F.transform(starts, F.last_day)
    else:
        raise ValueError(f"grain: {grain}")
    pairs = pairs.withColumn("_days", days)
    frame = pairs.select(
        "store", *attributes, *levels, "business_unit", F.explode("_days").alias(date)
    )
    kinds = {f.name: f.dataType for f in df.schema}
    return frame.withColumns(
        {m: F.lit(0).cast(kinds[m]) for m in ("quantity", "amount") if m in kinds}
    )
