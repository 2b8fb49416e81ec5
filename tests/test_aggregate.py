from __future__ import annotations

import datetime as dt
import itertools

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from shelfcast.operators import aggregate

D = dt.date
SALES = "sale_date date, store string, business_unit string, quantity long, amount decimal(18,2)"


def cells(df):
    return {(r["sale_date"], r["store"], r["business_unit"]): r["quantity"] for r in df.collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.dates(D(2021, 1, 1), D(2021, 3, 5)),
            st.sampled_from(["A_B", "A", "C"]),
            st.sampled_from(["p", "B_p"]),
            st.integers(0, 9),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_dense_grid_by_brute_force(spark, sales):
    df = spark.createDataFrame([(*s, 0) for s in sales], SALES.replace("decimal(18,2)", "int"))
    days = {s[0] for s in sales}
    pairs = {s[1:3] for s in sales}
    want = {(d, *p): 0 for d, p in itertools.product(days, pairs)}
    for day, store, product, quantity in sales:
        want[day, store, product] += quantity
    dense = aggregate.densify(df)
    assert dense.count() == len(days) * len(pairs)
    assert cells(dense) == want
    span = [min(days) + dt.timedelta(days=i) for i in range((max(days) - min(days)).days + 1)]
    calendar = cells(aggregate.densify(df, axis="calendar"))
    assert calendar == {(d, *p): want.get((d, *p), 0) for d, p in itertools.product(span, pairs)}


def test_filling_months_equals_filling_days_then_summing(spark):
    sales = [
        (D(2021, 1, 5), "a", "p", 2, "1.50"), (D(2021, 1, 9), "a", "p", 3, "2.25"), (D(2021, 3, 1), "b", "q", 4, "9.99"),
    ]
    df = spark.createDataFrame(sales, SALES.replace("decimal(18,2)", "string")).withColumn(
        "amount", aggregate.F.col("amount").cast("decimal(18,2)")
    )
    by_day = aggregate.resample_month(aggregate.densify(df), ["store", "business_unit"])
    by_month = aggregate.resample_month(aggregate.densify(df, freq="M", cut=True), ["store", "business_unit"])
    assert sorted(map(tuple, by_day.collect())) == sorted(map(tuple, by_month.collect()))
    assert by_day.count() == 4
    calendar = aggregate.densify(df, axis="calendar", freq="M")
    assert {r["sale_date"].month for r in calendar.collect()} == {1, 2, 3}


def test_attributes_ride_along(spark):
    rows = [(D(2021, 1, 1), "a", "p", 1, "x"), (D(2021, 1, 2), "a", "q", 1, "y"), (D(2021, 1, 1), "a", "p", 2, "z")]
    df = spark.createDataFrame(rows, "sale_date date, store string, business_unit string, quantity long, city string")
    for cut in (False, True):
        dense = aggregate.densify(df, measures=("quantity",), attributes={"store": ("city",)}, cut=cut)
        assert {r["city"] for r in dense.collect()} == {"y"} and dense.count() == 4
        assert sum(r["quantity"] for r in dense.collect()) == 4


def test_hot_series_keeps_its_sum(spark):
    df = spark.range(20000).selectExpr(
        "date_add(date'2021-01-01', cast(id % 40 as int)) AS sale_date",
        "IF(id % 3 = 0, 'hot', concat('s', id % 50)) AS store",
        "'p' AS business_unit", "1L AS quantity", "CAST(1 AS DECIMAL(18,2)) AS amount",
    )
    dense = aggregate.densify(df)
    assert dense.count() == 40 * df.select("store").distinct().count()
    assert dense.agg({"quantity": "sum"}).first()[0] == 20000


def test_dense_grid_is_not_shuffled(spark):
    df = spark.createDataFrame([(D(2021, 1, 1), "a", "p", 1, None)], SALES)
    plan = aggregate.densify(df)._jdf.queryExecution().executedPlan().toString()
    head = plan[: plan.index("Generate")]
    assert "Exchange" not in head and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_null_keys_are_left_out(spark):
    df = spark.createDataFrame([(D(2021, 1, 1), "a", "p", 1, None), (D(2021, 1, 1), None, "p", 5, None)], SALES)
    summed = aggregate.aggregate_sales(df, ["sale_date", "store", "business_unit"])
    assert [r["quantity"] for r in summed.collect()] == [1]
    assert aggregate.densify(df).count() == 1


def test_unpivot_undoes_pivot(spark):
    rows = [(D(2021, 1, 1), "A_B", "p", 3, None), (D(2021, 1, 2), "A", "B_p", 4, None)]
    df = spark.createDataFrame(rows, SALES)
    keyed = df.withColumn("series", aggregate.F.concat_ws("_", "store", "business_unit"))
    names = {"A_B_p": {"store": "A_B", "business_unit": "p"}, "A_B_p2": {"store": "A", "business_unit": "B_p"}}
    keyed = keyed.withColumn(
        "series", aggregate.F.when(aggregate.F.col("store") == "A", "A_B_p2").otherwise(keyed["series"])
    )
    wide = aggregate.pivot_series(keyed, "series", list(names))
    assert cells(aggregate.unpivot_series(wide, names)) == cells(aggregate.densify(df))


@pytest.mark.parametrize("day,end", [(D(2021, 1, 3), D(2021, 1, 3)), (D(2021, 1, 4), D(2021, 1, 10))])
def test_weeks_end_on_sunday(spark, day, end):
    df = spark.createDataFrame([(day, "a", "p", 1, None)], SALES)
    assert aggregate.resample(df, ["store"], freq="W").first()["sale_date"] == end


def test_money_is_cut_toward_zero(spark):
    df = spark.createDataFrame([("a", D(2021, 1, 3), -1.7, 1)], "store string, sale_date date, amount double, quantity long")
    assert aggregate.resample_month(df, ["store"]).first()["amount"] == -1


def test_profile_counts(spark):
    df = spark.createDataFrame([("a", 1), (None, 1)], "s string, n int")
    got = {r["column_name"]: (r["n_rows"], r["n_distinct"], r["n_null"], r["has_null"]) for r in aggregate.profile(df, exact=True).collect()}
    assert got == {"s": (2, 1, 1, True), "n": (2, 1, 0, False)}
    assert {tuple(r) for r in aggregate.profile(df).collect()} == {tuple(r) for r in aggregate.profile(df, exact=True).collect()}


def test_merged_sketches_profile_the_whole(spark):
    df = spark.range(30_000).selectExpr(
        "id % 5000 AS few", "id AS every", "CASE WHEN id % 3 = 0 THEN cast(id % 7 AS string) END AS word",
        "cast(null AS double) AS never",
        "CASE WHEN id % 100 > 0 THEN date_add(DATE '2021-01-01', cast(id % 300 AS int)) END AS sale_date",
    )
    sketches = aggregate.profile_sketches(df)
    assert sketches.count() == 5 * 11  # ten months and the rows without a date
    early, late = sketches.filter("month < '2021-05-01'"), sketches.filter("month >= '2021-05-01' OR month IS NULL")
    got = {r["column_name"]: r for r in aggregate.merged_profile(early.unionAll(late)).collect()}
    want = {r["column_name"]: r for r in aggregate.profile(df, exact=True).collect()}
    assert set(got) == set(want) and got["every"]["n_distinct"] != 0
    for name, r in want.items():
        found = got[name]
        assert (found["n_rows"], found["n_null"], found["has_null"]) == (r["n_rows"], r["n_null"], r["has_null"])
        assert abs(found["n_distinct"] - r["n_distinct"]) <= aggregate.SKETCH_ERROR * r["n_distinct"]
    assert got["word"]["quantiles"] is None and got["never"]["quantiles"] is None
    for found, share in zip(got["every"]["quantiles"], (0.25, 0.5, 0.75)):
        assert abs(found / 30_000 - share) < 0.02


def test_sketches_of_an_empty_table(spark):
    df = spark.createDataFrame([], "sale_date date, quantity bigint")
    assert aggregate.merged_profile(aggregate.profile_sketches(df)).count() == 0


@pytest.mark.parametrize("make", ["densify", "profile"])
def test_source_is_read_once(spark, make):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    schema = "sale_date date, store string, business_unit string, quantity bigint, amount bigint"
    df = spark.range(40).selectExpr(
        "date_add(DATE '2021-01-01', cast(id % 9 AS int)) AS sale_date", "'s' AS store",
        "'p' AS business_unit", "id AS quantity", "id AS amount",
    ).mapInArrow(count, schema)
    result = aggregate.densify(df) if make == "densify" else aggregate.profile(df, exact=True)
    assert len(result.collect()) == (9 if make == "densify" else 5)
    assert seen.value == 40
