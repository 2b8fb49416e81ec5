from __future__ import annotations

import datetime as dt

from shelfcast.operators import clean, joins

D = dt.date


def test_lookup_keeps_unmapped_and_does_not_multiply(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "org string")
    dim = spark.createDataFrame([("1", "a", 1), ("1", "b", 0)], "id string, name string, line int")
    by_order = joins.map_lookup(df, dim, "org", "id", "name", "store", order="line")
    assert {(r["org"], r["store"]) for r in by_order.collect()} == {("1", "a"), ("2", None), (None, None)}
    assert joins.map_lookup(df, dim, "org", "id", "name", "store").count() == 3


def test_last_attribute_breaks_ties_by_value(spark):
    rows = [
        ("s", "x", D(2021, 1, 1)), ("s", "y", D(2021, 1, 2)), ("s", "w", D(2021, 1, 2)), (None, "z", D(2021, 1, 3)),
    ]
    df = spark.createDataFrame(rows, "store string, city string, sale_date date")
    assert [tuple(r) for r in joins.last_attribute(df, "store", ("city",)).collect()] == [("s", "y")]


def test_last_attributes_are_chosen_one_by_one(spark):
    rows = [("s", "x", "1", D(2021, 1, 1)), ("s", "x", "2", D(2021, 1, 3)), ("s", "y", "1", D(2021, 1, 3))]
    df = spark.createDataFrame(rows, "store string, city string, zip string, sale_date date")
    assert tuple(joins.last_attribute(df, "store", ("city", "zip")).first()) == ("s", "y", "2")


def test_lookups_leave_the_fact_in_place(spark, tmp_path):
    """Short lookups are broadcast from the start: no exchange on the fact's hot column."""
    path = f"file://{tmp_path}/fact"
    rows = [(f"s{i % 3}", f"c{i % 2}", D(2021, 1, 1 + i % 28)) for i in range(500)]
    spark.createDataFrame(rows, "store string, city string, sale_date date").write.parquet(path)
    fact = spark.read.parquet(path)
    frames = [
        joins.attach_last(fact, fact, "store", ("city",)),
        clean.keep_eligible(fact, fact.filter("city = 'c1'")),
        clean.drop_closed(fact, fact.filter("store = 's1'").select("store")),
        joins.map_lookup(fact, fact, "store", "store", "city", "town"),
    ]
    for frame in frames:
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert frames[1].count() == 500 and frames[2].filter("store = 's1'").count() == 0


def test_repeated_actuals_multiply_and_future_stays_null(spark):
    keys = ("s", "p")
    fc = spark.createDataFrame(
        [(*keys, D(2021, 1, 31), 1.0), (*keys, D(2021, 2, 28), 2.0)],
        "store string, business_unit string, ds date, yhat double",
    )
    actual = spark.createDataFrame(
        [(*keys, D(2021, 1, 31), 5.0), (*keys, D(2021, 1, 31), 6.0)],
        "store string, business_unit string, ds date, y double",
    )
    got = sorted((r["ds"].month, r["y"] or 0) for r in joins.join_actuals(fc, actual).collect())
    assert got == [(1, 5.0), (1, 6.0), (2, 0)]


def test_regressors_and_flags_by_date(spark):
    schema = "store string, business_unit string, ds date"
    future = spark.createDataFrame([("s", "p", D(2021, m, 28)) for m in (1, 2, 3)], schema)
    series = spark.createDataFrame(
        [("s", "p", D(2021, 1, 28), 2, 1), ("s", "p", D(2021, 2, 28), 0, 0)],
        schema + ", black_week int, promos int",
    )
    got = joins.attach_regressors(future, series, ["black_week"], ["promos"]).orderBy("ds").collect()
    assert [(r["black_week"], r["promos"]) for r in got] == [(2, 1), (0, 0), (None, 0)]


def test_promotions_missing_is_zero(spark):
    df = spark.createDataFrame([(D(2021, 1, 31), "p"), (D(2021, 2, 28), "p")], "sale_date date, business_unit string")
    monthly = spark.createDataFrame([("p", D(2021, 1, 31), 1)], "business_unit string, month_end date, promos int")
    assert {r["sale_date"].month: r["promos"] for r in joins.add_promos(df, monthly).collect()} == {1: 1, 2: 0}
