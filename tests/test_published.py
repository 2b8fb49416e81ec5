"""Versions of published frames, and writes that fail."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.sources import published

SCHEMA = "store string, ds date, y bigint, yhat double"
ROWS = [("a", dt.date(2021, 1, 31), 3, 2.5), ('q "x", y', None, None, None), ("", dt.date(2021, 2, 28), -1, 0.1)]


@pytest.mark.parametrize(("form", "options"), [("csv", {}), ("csv", {"nullValue": "NONE"}), ("parquet", {})])
def test_round_trip_with_types(spark, tmp_path, form, options):
    rows = ROWS
    if form == "csv" and not options:  # an empty text is a null there
        rows = [r for r in ROWS if r[0]] + [("b", *ROWS[2][1:])]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert published.publish(frame, str(tmp_path / "p"), form, options) == 1
    back = published.read_published(spark, str(tmp_path / "p"))
    assert back.dtypes == frame.dtypes
    assert sorted(map(repr, back.collect())) == sorted(map(repr, frame.collect()))
    assert published.publish(frame.limit(0), str(tmp_path / "p"), form) == 2
    assert published.read_published(spark, str(tmp_path / "p")).count() == 0
    assert published.read_published(spark, str(tmp_path / "p"), 1).count() == 3


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    path, frame = str(tmp_path), spark.range(0, 1000, 1, 8)
    published.publish(frame, path)
    broken = frame.withColumn("id", F.when(F.col("id") == 990, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(0))
    with pytest.raises(Exception, match="lost"):
        published.publish(broken, path)
    assert published.versions(spark, path) == [1]
    assert published.read_published(spark, path).agg(F.sum("id")).first()[0] == 499500
    assert published.publish(frame.filter("id < 10"), path) == 2
    assert published.read_published(spark, path).count() == 10


def test_readers_stay_on_their_version(spark, tmp_path):
    path = str(tmp_path)
    published.publish(spark.range(5), path)
    held = published.read_published(spark, path)
    published.publish(spark.range(7), path)
    assert (held.count(), published.read_published(spark, path).count()) == (5, 7)


def test_taken_number_is_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    published.publish(spark.range(5), path)
    monkeypatch.setattr(published, "versions", lambda *_: [])
    with pytest.raises(FileExistsError):
        published.publish(spark.range(7), path)
    monkeypatch.undo()
    assert published.read_published(spark, path).count() == 5
    assert not list(tmp_path.glob(".staged-data-*"))


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path)
    for n in range(1, 5):
        published.publish(spark.range(n), path, "parquet")
    assert published.forget_versions(spark, path, keep=2) == [1, 2]
    assert [published.read_published(spark, path, v).count() for v in published.versions(spark, path)] == [3, 4]
    assert len(list(tmp_path.glob("data-*"))) == 2
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, path, 1)
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, str(tmp_path / "nothing"))
