from __future__ import annotations

import datetime as dt

from shelfcast.operators import clean


def values(df, column):
    return sorted((r[0] for r in df.select(column).collect()), key=str)


def test_returns_and_unknown_quantities_go(spark):
    df = spark.createDataFrame([(1,), (0,), (-1,), (None,)], "quantity long")
    assert values(clean.drop_returns(df), "quantity") == [0, 1]


def test_row_without_store_survives_the_denylist(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "store string")
    closed = spark.createDataFrame([("a",)], "s string")
    assert values(clean.drop_closed(df, ["a"]), "store") == [None, "b"]
    assert values(clean.drop_closed(df, closed), "store") == [None, "b"]


def test_eligible_by_history(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "store string")
    history = spark.createDataFrame([("b",), ("b",), ("c",)], "store string")
    assert values(clean.keep_eligible(df, history), "store") == ["b"]


def test_replacement_is_simultaneous(spark):
    df = spark.createDataFrame([("a",), ("b",)], "city string")
    assert values(clean.replace_values(df, "city", {"a": "b", "b": "c"}), "city") == ["b", "c"]


def test_pattern_replaces_the_whole_value(spark):
    df = spark.createDataFrame([("Berlin-Mitte",), ("Alt Berlin",), ("Bonn",), (None,)], "city string")
    fixed = clean.replace_regex(df, "city", [(r"^.*Berlin.*$", "Berlin")])
    assert values(fixed, "city") == ["Berlin", "Berlin", "Bonn", None]


def test_promoted_level_takes_name_and_place(spark):
    df = spark.createDataFrame([("x", "y")], "product_division string, business_unit string")
    promoted = clean.promote_level(df)
    assert promoted.columns == ["business_unit"] and promoted.first()[0] == "x"


def test_split_and_slices(spark):
    days = [dt.date(2021, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(d,) for d in days], "ds date")
    past, ahead = clean.split_by_date(df, days[1])
    assert (past.count(), ahead.count()) == (2, 1)
    sizes = {c: clean.date_slice(df, days[0], days[2], c).count() for c in ("both", "left", "right", "neither")}
    assert sizes == {"both": 3, "left": 2, "right": 2, "neither": 1}


def test_append_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2,)], "n int")
    assert sorted(map(tuple, clean.append(a, b).collect())) == [(1, "x"), (2, None)]


def test_stamp_is_injectable(spark):
    df = clean.stamp_run(spark.range(1), dt.date(2022, 3, 1))
    assert df.first()["training_date"] == dt.date(2022, 3, 1)


def test_narrowing_bounds_are_strict(spark):
    rows = [(126, 127, 40000, 2**40, 1.5, None), (-127, 0, 0, 0, -2.5, None)]
    df = spark.createDataFrame(rows, "a long, b long, c long, d long, e double, f long")
    narrow, report = clean.narrow_numeric(df)
    assert dict(narrow.dtypes) == {
        "a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "e": "double", "f": "bigint",
    }
    assert ("a", "bigint", "tinyint") in report and len(report) == 3
    assert dict(clean.narrow_numeric(df, allow_float=True)[0].dtypes)["e"] == "float"
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, df.collect()))


def test_preview_both_ends(spark):
    df = spark.range(10)
    assert [r[0] for r in clean.preview(df, 2, ["id"]).collect()] == [0, 1]
    assert [r[0] for r in clean.preview(df, 2, ["id"], last=True).collect()] == [9, 8]
