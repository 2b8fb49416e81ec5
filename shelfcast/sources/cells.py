"""Monthly sales kept as a table that new files are added to, month by month."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfcast.schema import MEASURES, SERIES
from shelfcast.session import materialise


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def append_cells(
    sales: DataFrame,
    path: str,
    batch: str,
    keys: Sequence[str] = SERIES,
    measures: Sequence[str] = MEASURES,
    date: str = "sale_date",
) -> list[dt.date]:
    """Add the sales of one file to the monthly table at ``path``; returns the month ends it touched.

    The new sales are summed to one row per month and series; only the months among them are read from the table and
    written again, by swapping whole month folders once all rows are written. The table holds a row per month,
    series and ``batch``, the name of the file, so adding a batch again replaces what it added before: after a lost driver
    the call is simply repeated. A batch added again must touch the months it touched before. One append at a time.
    Rows without a date or a key are left out.
    """
    spark = sales.sparkSession
    new = materialise(
        sales.dropna(subset=[date, *keys])
        .groupBy(*keys, F.last_day(date).alias("month"))
        .agg(
            *[F.sum(m).alias(m) for m in measures],
            F.count("*").alias("n_rows"),
            F.max(date).alias("last_date"),
        )
        .select(*keys, *measures, "n_rows", "last_date", F.lit(batch).alias("batch"), "month")
    )
    # No more than the months of the calendar.
    months = sorted(r["month"] for r in new.select("month").distinct().collect())
    if not months:
        return []
    rows = new
    if _exists(spark, path):
        held = spark.read.schema(new.schema).parquet(path)
        rows = held.filter(F.col("month").isin(months) & (F.col("batch") != batch)).unionByName(new)
    # A month of many series is split over several files, small months share a task.
    rows.hint("rebalance", "month").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("month").parquet(path)
    return months


def read_cells(
    spark: SparkSession, path: str, keys: Sequence[str] = SERIES, measures: Sequence[str] = MEASURES
) -> DataFrame:
    """The table of ``append_cells`` with one row per month and series; a filter on ``month`` prunes folders."""
    held = spark.read.parquet(path)
    kinds = {f.name: f.dataType for f in held.schema}
    month = F.col("month").cast(T.DateType()).alias("month")
    return held.groupBy(*keys, month).agg(
        *[F.sum(m).cast(kinds[m]).alias(m) for m in measures],
        F.sum("n_rows").alias("n_rows"),
        F.max("last_date").alias("last_date"),
    )
