from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast import fixed_values as fixed
from shelfcast.plans import lines, product_line

D = dt.date
RAW = (
    "`Reseller Organization ID` string, `Reseller Country` string, `Reseller Postal Code` string, "
    "`Reseller City` string, `Super Division` string, `Product Division` string, `Business Unit` string, "
    "`Sales Date` date, `Rslr Sales Quantity` long, `Rslr Sales Amount` double"
)
HISTORY = (
    "sale_date date, store string, city string, postal_code string, super_division string, "
    "product_division string, business_unit string, quantity long, amount decimal(18,2)"
)
CONSOLE = ("EDG Managed - Xbox Hardware", "Xbox Console")


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.createDataFrame(
        [("1", "Shop A"), ("2", "Shop B"), ("3", "Saturn Wesel"), ("4", "Unknown Shop")],
        "`Org als Text` string, `Unique Name (Masterlist)` string",
    )


@pytest.fixture(scope="module")
def history(spark):
    rows = []
    for year in range(2018, 2022):
        for month in range(1, 13):
            for store in ("Shop A", "Shop B", "Saturn Wesel"):
                for product in fixed.CONSOLE_PRODUCTS:
                    rows.append((D(year, month, 15), store, "Berlin", "1", *CONSOLE, product, month, None))
    return spark.createDataFrame(rows, HISTORY)


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        ("1", "Germany", "10", "Alt-Berlin Süd", *CONSOLE, "Xbox One X", D(2022, 1, 31), 4, 10.0),
        ("1", "Germany", "10", "Alt-Berlin Süd", *CONSOLE, "Xbox Series X", D(2022, 1, 31), 1, 5.0),
        ("1", "Germany", "11", "Stuttgart-Vaihingen", *CONSOLE, "Game Pass PC", D(2022, 2, 15), 2, 3.0),
        ("2", "Germany", "20", "M?llheim", *CONSOLE, "Xbox Series S", D(2022, 2, 15), 7, 9.0),
        ("2", "Germany", "20", "M?llheim", *CONSOLE, "Xbox Series S", D(2022, 2, 15), -7, -9.0),
        ("2", "Austria", "20", "Wien", *CONSOLE, "Xbox Series S", D(2022, 2, 14), 50, 9.0),
        ("3", "Germany", "30", "Wesel", *CONSOLE, "Xbox Series S", D(2022, 2, 15), 1, 1.0),
        ("4", "Germany", "40", "Ulm", *CONSOLE, "Xbox Series S", D(2022, 2, 15), 1, 1.0),
        ("2", "Germany", "20", "M?llheim", *CONSOLE, "Headset", D(2022, 2, 15), 1, 1.0),
    ]
    return spark.createDataFrame(rows, RAW)


def test_console_line_is_cleaned_and_densified(spark, raw, history, dimension):
    line = lines.CONSOLES
    cleaned = product_line.clean_sales(raw, line, history, dimension)
    got = {(r["store"], r["city"], r["business_unit"], r["quantity"]) for r in cleaned.collect()}
    assert got == {
        ("Shop A", "Berlin", "Xbox Series X", 4), ("Shop A", "Berlin", "Xbox Series X", 1),
        ("Shop A", "Stuttgart", "Game Pass PC", 2), ("Shop B", "Müllheim", "Xbox Series S", 7),
        ("Saturn Wesel", "Wesel", "Xbox Series S", 1),
    }
    dense = product_line.dense_sales(cleaned, line).collect()
    assert len(dense) == 2 * 4
    cells = {(r["sale_date"], r["store"], r["business_unit"]): r["quantity"] for r in dense}
    assert cells[D(2022, 1, 31), "Shop A", "Xbox Series X"] == 5
    assert cells[D(2022, 1, 31), "Shop B", "Xbox Series S"] == 0
    assert {r["city"] for r in dense if r["store"] == "Shop A"} == {"Stuttgart"}


def test_console_line_to_published_frames(spark, raw, history, dimension):
    frames = product_line.run_product_line(
        lines.CONSOLES_FROM_UNION, raw, history, dimension, train_end=D(2022, 2, 28), run_date=D(2022, 3, 1)
    )
    merged = frames["merged"]
    assert merged.filter("store = 'Saturn Wesel'").count() == 0
    frame = frames["model_frame"]
    ahead = {(r["ds"], r["is_future"]) for r in frame.filter("ds > '2022-01-31'").collect()}
    assert ahead == {(D(2022, 2, 28), False), (D(2022, 2, 28), True), (D(2022, 3, 31), True)}
    series = frame.select("store", "business_unit").distinct().count()
    predicted = frames["predicted"].collect()
    assert len(predicted) == series == 6
    overall = frames["scores"].first()
    known = frames["forecast"].filter("ds <= '2022-02-28'").count()
    assert overall["n_scored"] <= known and overall["root_mae"] >= 0 and frames["scores_by_product"].count() <= 6
    searched = product_line.run_product_line(
        lines.CONSOLES_FROM_UNION, raw, history, dimension, train_end=D(2022, 2, 28), run_date=D(2022, 3, 1),
        trials=[(1, 0.05, 10.0), (2, 0.5, 0.1)], cutoffs=[D(2021, 6, 30), D(2021, 9, 30)],
    )
    assert searched["best"].count() == 6
    assert searched["predicted"].count() == 6
    assert {r["ds"] for r in predicted} == {D(2022, 3, 31)}
    assert all(r["yhat"] is None or r["yhat"] == int(r["yhat"]) >= 0 for r in predicted)
    assert {r["y"] for r in predicted} == {None}
    assert frames["rejects"].count() == frames["reject_counts"].count() == 0
    historic = frames["historic"]
    assert historic.count() == historic.dropDuplicates().count() > len(predicted)


def test_new_data_only_base(spark, raw, history, dimension):
    frame = product_line.run_product_line(
        lines.CONSOLES, raw, history, dimension, train_end=D(2022, 2, 28)
    )["model_frame"]
    assert frame.agg({"ds": "min"}).first()[0] == D(2022, 1, 31)


def test_device_line_promotes_the_level_and_needs_promotions(spark, dimension):
    division = fixed.DEVICE_DIVISIONS[0]
    raw = spark.createDataFrame(
        [
            ("1", "Germany", "10", "Berlin-Steglitz", division, "Surface Pro", "Type X", D(2021, 12, 31), 4, 10.0),
            ("1", "Germany", "10", "Berlin-Steglitz", "Other", "Surface Pro", "Type X", D(2021, 12, 31), 4, 10.0),
        ],
        RAW,
    )
    history = spark.createDataFrame(
        [(D(2020, 11, 30), "Shop A", "Berlin", "1", division, None, "Surface Pro", 2, None)], HISTORY
    ).drop("product_division")
    line = lines.DEVICES
    new = product_line.dense_sales(product_line.clean_sales(raw, line, history, dimension), line)
    assert [(r["business_unit"], r["city"], r["quantity"]) for r in new.collect()] == [("Surface Pro", "Berlin", 4)]
    merged = product_line.merged_sales(new, history, line)
    with pytest.raises(ValueError):
        product_line.model_frame(merged, line)
    promos = spark.createDataFrame(
        [("Surface Pro", D(2021, 12, 3), 5.0)], "business_unit string, sale_date date, discount_amount double"
    )
    got = product_line.model_frame(merged, line, promos).orderBy("ds").collect()
    assert [(r["ds"], r["black_week"], r["promos"], r["y"], r["is_future"]) for r in got] == [
        (D(2020, 11, 30), 2, 0, 2, False), (D(2021, 12, 31), 0, 1, 4, False), (D(2022, 1, 31), 0, 0, 0, True),
    ]


def test_suite_line_merges_products_and_drops_closed_history(spark, dimension):
    division = fixed.SUITE_DIVISIONS[0]
    raw = spark.createDataFrame(
        [
            ("1", "Germany", "10", "Berlin", division, "Office for Mac", "Office for Mac", D(2021, 9, 30), 4, 10.0),
            ("3", "Germany", "10", "Wesel", division, "M365", "M365", D(2021, 9, 30), 4, 10.0),
        ],
        RAW,
    )
    rows = [(D(2021, 8, 31), s, "Berlin", "1", division, "M365", "M365", 2, None) for s in ("Shop A", "Saturn Wesel")]
    history = spark.createDataFrame(rows, HISTORY)
    line = lines.SUITES
    assert {r["store"] for r in product_line.open_history(history, line).collect()} == {"Shop A"}
    cleaned = product_line.clean_sales(raw, line, history, dimension)
    got = [(r["store"], r["product_division"], r["business_unit"]) for r in cleaned.collect()]
    assert got == [("Shop A", "Office Standard", "Office Standard")]
    frame = product_line.model_frame(
        product_line.merged_sales(product_line.dense_sales(cleaned, line), history, line), line
    )
    flags = {(r["ds"], r["business_unit"]): r["christmas"] for r in frame.collect()}
    assert flags[D(2021, 9, 30), "Office Standard"] == 2 and flags[D(2021, 8, 31), "M365"] == 0


def test_sql_view(spark, history):
    counts = product_line.register_sales(history, "console_history")
    assert counts.count() == 9 and spark.table("console_history").count() == history.count()


def test_every_line_names_known_flags():
    for line in lines.LINES.values():
        made = {f.column for f in line.flags} | ({"promos"} if line.promotions else set())
        assert set(line.regressors) <= made


def test_a_line_reports_what_it_cannot_read(spark, raw, history, dimension):
    quantity = next(old for old, new in fixed.RAW_COLUMNS.items() if new == "quantity")
    text = raw.withColumn(quantity, F.when(F.monotonically_increasing_id() == 0, "many").otherwise(F.col(quantity).cast("string")))
    frames = product_line.run_product_line(lines.CONSOLES, text, history, dimension, train_end=D(2022, 2, 28))
    assert [tuple(r) for r in frames["reject_counts"].collect()] == [("quantity", 1)]
    assert [r[quantity] for r in frames["rejects"].collect()] == ["many"]
