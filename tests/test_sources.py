from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from shelfcast import session
from shelfcast.schema import SALES
from shelfcast.sources import (
    readers,
    canonicalise,
    publish_tables,
    read_dimension,
    read_promotions,
    read_sales,
    replace_file,
    write_csv,
    write_jdbc,
)

HEADER = "Store_names,Reseller City,Super Division,Product Division,Business Unit,Sales Date,Rslr Sales Quantity,Rslr Sales Amount,black_week"


def test_csv_sales_are_typed_in_any_column_order(spark, tmp_path):
    (tmp_path / "sales.csv").write_text(
        f"{HEADER}\nShop Köln,Köln,D,P,Pad,2021-01-31,3,537.5,0\nShop,,D,P,Pad,2021-02-28 00:00:00,2.0,oops,1\n"
    )
    df = read_sales(spark, str(tmp_path / "sales.csv"), keep=("black_week",))
    assert df.columns == [*SALES.names, "black_week"]
    assert [f.dataType for f in df.schema][:9] == [f.dataType for f in SALES]
    first, second = df.orderBy("sale_date").collect()
    assert first["store"] == "Shop Köln" and first["amount"] == Decimal("537.50") and first["postal_code"] is None
    assert second["sale_date"] == dt.date(2021, 2, 28) and second["quantity"] == 2
    assert second["amount"] is None and second["city"] is None


def test_dimension_skips_long_lines_and_pads_short_ones(spark, tmp_path):
    (tmp_path / "dim.csv").write_text("Org als Text;Unique Name (Masterlist);Ort\n1;a;x\n2;b\n3;c;y;z\n4;d;w\n")
    df = read_dimension(spark, str(tmp_path / "dim.csv"))
    got = {r["Org als Text"]: (r["Unique Name (Masterlist)"], r["Ort"]) for r in df.collect()}
    assert got == {"1": ("a", "x"), "2": ("b", None), "4": ("d", "w")}
    assert df.select("Org als Text").count() == 3


@pytest.mark.parametrize("header", ["Sales_Date,Business unit,Discount_amount", "Sales Date,Business Unit,Discount_amount"])
def test_promotions_under_either_header(spark, tmp_path, header):
    (tmp_path / "promos.csv").write_text(f"{header}\n2021-01-05,Pad,10.5\n")
    assert tuple(read_promotions(spark, str(tmp_path / "promos.csv")).first()) == ("Pad", dt.date(2021, 1, 5), 10.5)


def test_csv_round_trip_and_replacement(spark, tmp_path):
    rows = [("a", "x", "1", "s", "p", "u", dt.date(2021, 1, 1), 1, Decimal("2.50"))]
    df = canonicalise(
        spark.createDataFrame(
            rows,
            "store string, city string, postal_code string, super_division string, product_division string, "
            "business_unit string, sale_date date, quantity long, amount decimal(18,2)",
        )
    )
    path = str(tmp_path / "out")
    write_csv(df, path)
    replace_file(df, path)
    back = read_sales(spark, path)
    assert back.schema == df.schema and back.collect() == df.collect()


class Writer:
    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


class Frame:
    def __init__(self):
        self.write = Writer()


def test_relational_sink_settings():
    """What reaches the writer; no database is started here."""
    frame = Frame()
    write_jdbc(frame, "jdbc:x", "t", 2500, {"user": "u"}, writers=4)
    assert frame.write.calls == [
        ("mode", ("overwrite",), {}),
        ("option", ("batchsize", 2500), {}),
        ("option", ("numPartitions", 4), {}),
        ("jdbc", ("jdbc:x", "t"), {"properties": {"user": "u"}}),
    ]
    predicted, historic = Frame(), Frame()
    publish_tables(predicted, historic, "jdbc:x")
    assert ("option", ("batchsize", 2500), {}) in predicted.write.calls
    assert ("option", ("batchsize", 50000), {}) in historic.write.calls


def test_checkpoint_folder_comes_from_the_session(spark):
    folder = session.checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() and folder
    df = session.materialise(spark.range(3))
    assert df.count() == 3 and "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_cluster_without_a_checkpoint_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())


def test_dates_of_other_forms_and_rejected_rows(spark):
    raw = spark.createDataFrame(
        [
            ("31.12.2021", "2"),
            ("12/31/2021", "2.0"),
            ("2021/12/31", "3"),
            ("2021-12-31", "-1"),
            ("31/12/2021", "1"),
            ("soon", "many"),
            (None, " "),
        ],
        "sale_date string, quantity string",
    )
    typed = readers.canonicalise(raw, {}).select("sale_date", "quantity").collect()
    assert [r["sale_date"] for r in typed] == [dt.date(2021, 12, 31)] * 4 + [None] * 3
    assert [r["quantity"] for r in typed] == [2, 2, 3, -1, 1, None, None]
    rejected = {r["sale_date"]: r["rejected"] for r in readers.rejected_rows(raw, {}).collect()}
    assert rejected == {"31/12/2021": ["sale_date"], "soon": ["sale_date", "quantity"]}
    day_first = readers.canonicalise(raw, {}, date_formats=("d/M/yyyy",)).collect()
    assert day_first[4]["sale_date"] == dt.date(2021, 12, 31)


def test_typed_and_rejected_rows_come_from_one_scan(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    schema = "sale_date string, store string, quantity string, rejected string, extra string"
    rows = [("31.12.2021", "A", "2.0", "own", "x"), ("soon", "B", "many", None, "y"), (None, "C", " ", None, None), ("2021-12-31", "D", "n/a", "z", None)]
    raw = spark.createDataFrame(rows, schema).drop("rejected")
    typed, rejects = readers.typed_and_rejected(raw.mapInArrow(count, raw.schema), {})
    plain = sorted(map(tuple, readers.canonicalise(raw, {}).collect()), key=repr)
    assert sorted(map(tuple, typed.collect()), key=repr) == plain and len(plain) == 4
    want = sorted(map(tuple, readers.rejected_rows(raw, {}).collect()), key=repr)
    assert sorted(map(tuple, rejects.collect()), key=repr) == want and len(want) == 2
    assert rejects.columns == [*raw.columns, "rejected"] and seen.value == 4
    typed, rejects = readers.typed_and_rejected(raw.limit(0), {})
    assert typed.count() == rejects.count() == 0
