from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import pytest

from shelfcast.operators.aggregate import densify
from shelfcast.sources.cells import append_cells, read_cells

D = dt.date
SCHEMA = "sale_date date, store string, business_unit string, quantity bigint, amount decimal(18,2)"


def sale(day, store="A", product="p", quantity=1, amount=Decimal(10)):
    return day, store, product, quantity, amount


JANUARY = [sale(D(2021, 1, 3)), sale(D(2021, 1, 9), quantity=4), sale(D(2021, 1, 9), "B", amount=None)]
FEBRUARY = [sale(D(2021, 2, 1)), sale(D(2021, 2, 27), "C", quantity=None)]
LATE = [sale(D(2021, 2, 3), quantity=2), sale(D(2021, 3, 5), "B"), sale(None), sale(D(2021, 3, 5), None)]


@pytest.fixture
def table(spark, tmp_path):
    path = f"file://{tmp_path}/cells"

    def add(rows, batch):
        return append_cells(spark.createDataFrame(rows, SCHEMA), path, batch)

    return add, path, tmp_path / "cells"


def content(spark, path):
    return sorted((tuple(r) for r in read_cells(spark, path).collect()), key=repr)


def files(folder: Path, month: str):
    return {f.name: f.stat().st_mtime_ns for f in (folder / f"month={month}").glob("*.parquet")}


def test_appended_files_equal_one_file(spark, table, tmp_path):
    add, path, _ = table
    assert add(JANUARY, "1") == [D(2021, 1, 31)]
    assert add(FEBRUARY, "2") == [D(2021, 2, 28)]
    assert add(LATE, "3") == [D(2021, 2, 28), D(2021, 3, 31)]
    whole = f"file://{tmp_path}/whole"
    both = spark.createDataFrame([], SCHEMA)
    for rows in (JANUARY, FEBRUARY, LATE):
        both = both.unionAll(spark.createDataFrame(rows, SCHEMA))
    append_cells(both, whole, "all")
    got = content(spark, path)
    assert got == content(spark, whole) and len(got) == 5
    monthly = densify(both, freq="M", measures=("quantity",)).collect()
    cells = read_cells(spark, path).withColumnRenamed("month", "sale_date")
    assert sorted(map(tuple, densify(cells, freq="M", measures=("quantity",)).collect())) == sorted(map(tuple, monthly))


def test_a_repeated_file_counts_once(spark, table):
    add, path, _ = table
    add(JANUARY, "1"), add(FEBRUARY, "2"), add(LATE, "3")
    once = content(spark, path)
    add(LATE, "3"), add(FEBRUARY, "2")
    assert content(spark, path) == once


def test_untouched_months_are_neither_read_nor_written(spark, table):
    add, path, folder = table
    add(JANUARY, "1"), add(FEBRUARY, "2")
    before = files(folder, "2021-01-31")
    part = next((folder / "month=2021-01-31").glob("*.parquet"))
    kept = part.read_bytes()
    part.write_bytes(b"not a parquet file")  # any reader of January fails
    add(LATE, "3")
    assert part.read_bytes() == b"not a parquet file" and set(files(folder, "2021-01-31")) == set(before)
    part.write_bytes(kept)
    assert len(content(spark, path)) == 5


def test_a_file_without_sales_changes_nothing(spark, table):
    add, path, folder = table
    assert add([], "0") == [] and not folder.exists()
    add(JANUARY, "1")
    before = content(spark, path)
    assert add([sale(None)], "2") == [] and content(spark, path) == before
