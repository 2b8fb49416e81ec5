from __future__ import annotations

import calendar as months
import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast import fixed_values as fixed
from shelfcast.functions import calendar

D = dt.date
SALES = "sale_date date, store string, city string, super_division string, business_unit string, quantity long"

# Flags of the published sample: every other cell of 3 products x 62 months is 0.
GOLDEN = {
    ("Xbox Series S", D(2017, 11, 30)): (1, 0),
    ("Xbox Series S", D(2018, 11, 30)): (1, 0),
    ("Xbox Series S", D(2019, 11, 30)): (2, 0),
    ("Xbox Series S", D(2020, 11, 30)): (1, 0),
    ("Xbox Series S", D(2021, 11, 30)): (1, 0),
    ("Xbox Series S", D(2017, 12, 31)): (0, 2),
    ("Xbox Series X", D(2017, 11, 30)): (1, 0),
    ("Xbox Series X", D(2018, 11, 30)): (1, 0),
    ("Xbox Series X", D(2019, 11, 30)): (1, 0),
    ("Xbox Series X", D(2020, 11, 30)): (2, 0),
    ("Xbox Series X", D(2021, 12, 31)): (0, 1),
    ("Game Pass PC", D(2017, 12, 31)): (0, 2),
    ("Game Pass PC", D(2019, 12, 31)): (0, 2),
}


def month_ends():
    for year in range(2017, 2023):
        for month in range(1, 13):
            if (year, month) <= (2022, 2):
                yield D(year, month, months.monthrange(year, month)[1])


def flags(spark, profile):
    rows = [(p, d) for p in fixed.CONSOLE_PRODUCTS for d in month_ends()]
    df = spark.createDataFrame(rows, "business_unit string, sale_date date")
    base = calendar.november_flag(F.col("sale_date"))
    df = calendar.apply_calendar_rules(df, fixed.CONSOLE_BLACK_WEEK, "b", base, profile)
    df = calendar.apply_calendar_rules(df, fixed.CONSOLE_CHRISTMAS, "c", 0, profile)
    return {(r["business_unit"], r["sale_date"]): (r["b"], r["c"]) for r in df.collect()}


def test_golden_flags(spark):
    got = flags(spark, "reference")
    assert len(got) == 186
    assert got == {key: GOLDEN.get(key, (0, 0)) for key in got}


def test_intended_profile_differs_on_seven_cells(spark):
    got = flags(spark, "intended")
    base = flags(spark, "reference")
    assert sum(got[k][0] != base[k][0] for k in got) == 2
    assert sum(got[k][1] != base[k][1] for k in got) == 5


@pytest.mark.parametrize(
    "listed,folded", [((2017, 2018, 2019), 2019), ((2019, 2021), 2023), ((2020, 2021), 2021), ((7, 9), 15)]
)
def test_effective_years(listed, folded):
    assert calendar.effective(listed, "reference") == (folded,)
    assert calendar.effective(listed, "intended") == listed


def test_later_rule_wins(spark):
    df = spark.createDataFrame([("p", D(2021, 11, 30))], "business_unit string, sale_date date")
    rules = [fixed.Rule("p", (11,), (2021,), 1), fixed.Rule("p", (11,), (), 2), fixed.Rule("p", (12,), (), 3)]
    assert calendar.apply_calendar_rules(df, rules, "x").first()["x"] == 2


@pytest.mark.parametrize(
    "day,days,last",
    [(D(2021, 12, 15), 47, D(2022, 1, 31)), (D(2021, 12, 31), 31, D(2022, 1, 31)), (D(2022, 1, 31), 28, D(2022, 2, 28))],
)
def test_future_reaches_over_the_year_end(spark, day, days, last):
    rows = [(day, "a", "x", "d", "p", 5), (day, "a", "x", "d", "q", 5), (D(2021, 1, 1), "b", "y", "d", "r", 1)]
    df = spark.createDataFrame(rows, SALES)
    assert df.select(calendar.horizon_days(F.col("sale_date"))).first()[0] == days
    frame = calendar.future_frame(df)
    got = frame.collect()
    assert len(got) == len({tuple(r) for r in got}) == 2 * 2 * days
    assert {(r["store"], r["city"]) for r in got} == {("a", "x"), ("b", "y")}
    assert {r["business_unit"] for r in got} == {"p", "q"}
    assert min(r["sale_date"] for r in got) == day + dt.timedelta(days=1)
    assert max(r["sale_date"] for r in got) == last and {r["quantity"] for r in got} == {0}
    by_month = {r["sale_date"] for r in calendar.future_frame(df, grain="month").collect()}
    ends = {D(r["sale_date"].year, r["sale_date"].month, months.monthrange(r["sale_date"].year, r["sale_date"].month)[1]) for r in got}
    assert by_month == ends


def test_template_store_absent_on_the_last_date_gives_no_rows(spark):
    rows = [(D(2021, 1, 2), "a", "x", "d", "p", 5), (D(2021, 1, 1), "b", "y", "d", "r", 1)]
    assert calendar.future_frame(spark.createDataFrame(rows, SALES), "b").count() == 0


def test_black_friday(spark):
    years = spark.createDataFrame([(2019,), (2021,), (2024,)], "year int")
    got = calendar.black_friday_window(years).collect()
    fridays = {2019: D(2019, 11, 22), 2021: D(2021, 11, 26), 2024: D(2024, 11, 22)}
    for year, friday in fridays.items():
        days = [r["ds"] for r in got if r["year"] == year and r["event"] == "black_friday"]
        assert sorted(days) == [friday + dt.timedelta(days=k) for k in range(-4, 2)]
        assert [r["ds"] for r in got if r["year"] == year and r["event"] == "cyber_monday"] == [friday + dt.timedelta(days=3)]


def test_easter_of_known_years(spark):
    known = {1997: D(1997, 3, 30), 2000: D(2000, 4, 23), 2008: D(2008, 3, 23), 2019: D(2019, 4, 21), 2024: D(2024, 3, 31), 2038: D(2038, 4, 25)}
    years = spark.createDataFrame([(y,) for y in known], "year int")
    got = {r["year"]: r["e"] for r in years.withColumn("e", calendar.easter_sunday(F.col("year"))).collect()}
    assert got == known


def test_holidays_by_flag_equal_holidays_by_date(spark):
    days = spark.sql("SELECT explode(sequence(date'2016-01-01', date'2018-12-31')) AS ds")
    easter = calendar.easter_sunday(F.year("ds"))
    hit = F.greatest(*[f.cast("int") for f in calendar.holiday_flags(F.col("ds"), easter)])
    by_flag = {r["ds"] for r in days.filter(hit == 1).collect()}
    years = spark.createDataFrame([(2016,), (2017,), (2018,)], "year int")
    by_date = {r["ds"] for r in calendar.german_holidays(years).collect()}
    assert by_flag == by_date and len(by_date) == 28 and D(2017, 10, 31) in by_date


def test_lockdown_month_ends(spark):
    ends = [d for _, d in calendar.event_dates(fixed.LOCKDOWNS)]
    assert ends == [D(2020, 3, 31), D(2020, 4, 30), D(2020, 12, 31), D(2021, 1, 31), D(2021, 2, 28)]
    later = [d for _, d in calendar.event_dates(fixed.TWEEDIE_LOCKDOWNS)]
    assert later == [D(2020, 3, 31), D(2020, 4, 30), D(2020, 11, 30), D(2020, 12, 31)]
    ranges = spark.createDataFrame(list(fixed.LOCKDOWNS), "holiday string, start date, end date")
    assert sorted(r["ds"] for r in calendar.event_calendar(ranges).collect()) == ends


def test_lockdown_indicator_is_inverted(spark):
    df = spark.createDataFrame([(D(2020, 3, 31),), (D(2020, 5, 31),)], "ds date")
    got = calendar.calendar_features(df, fixed.TWEEDIE_LOCKDOWNS).orderBy("ds").collect()
    assert [r["corona_lockdown"] for r in got] == [0, 1]


@pytest.mark.parametrize(
    "start,end,step,want",
    [
        (D(2021, 7, 1), D(2022, 1, 31), 2, [(2021, 7), (2021, 9), (2021, 11), (2022, 1)]),
        (D(2021, 12, 1), D(2022, 2, 28), 1, [(2021, 12), (2022, 1), (2022, 2)]),
        (D(2021, 6, 1), D(2021, 12, 31), 2, [(2021, 6), (2021, 8), (2021, 10), (2021, 12)]),
        (D(2021, 6, 2), D(2021, 6, 30), 1, []),
    ],
)
def test_cutoffs(spark, start, end, step, want):
    bounds = spark.createDataFrame([(start, end)], "start date, end date")
    got = sorted(r["cutoff"] for r in calendar.cutoffs(bounds, step).collect())
    assert got == [D(y, m, 1) for y, m in want]


def test_next_month_ends_start_with_the_own_month(spark):
    df = spark.createDataFrame([("s", "p", D(2022, 2, 15)), ("t", "p", D(2021, 12, 31))], "store string, business_unit string, ds date")
    got = calendar.extend_months(df, 2).filter("is_future").collect()
    assert sorted((r["store"], r["ds"]) for r in got) == [
        ("s", D(2022, 2, 28)), ("s", D(2022, 3, 31)), ("t", D(2022, 1, 31)), ("t", D(2022, 2, 28)),
    ]
