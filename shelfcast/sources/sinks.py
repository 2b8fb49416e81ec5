"""Writers. Every one runs in parallel; a target is a folder or a table, never one driver-side file."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from shelfcast.fixed_values import (
    HISTORIC_BATCH,
    HISTORIC_TABLE,
    PREDICTION_BATCH,
    PREDICTION_TABLE,
)


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", options: Mapping[str, str] | None = None
) -> None:
    """CSV with a header and no index column, one part file per task."""
    df.write.mode(mode).options(**(options or {})).option("header", True).csv(path)


def replace_file(df: DataFrame, uri: str, options: Mapping[str, str] | None = None) -> None:
    """Replace a data set in object storage."""
    write_csv(df, uri, "overwrite", options)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    batchsize: int,
    properties: Mapping[str, str] | None = None,
    writers: int | None = None,
) -> None:
    """Replace a relational table in batches of ``batchsize`` rows over at most ``writers`` connections."""
    writer = df.write.mode("overwrite").option("batchsize", batchsize)
    if writers:
        writer = writer.option("numPartitions", writers)
    writer.jdbc(url, table, properties=dict(properties or {}))


def publish_tables(
    predicted: DataFrame,
    historic: DataFrame,
    url: str,
    properties: Mapping[str, str] | None = None,
    prediction_table: str = PREDICTION_TABLE,
    historic_table: str = HISTORIC_TABLE,
    writers: int | None = None,
) -> None:
    """Replace the prediction and the historic table."""
    write_jdbc(predicted, url, prediction_table, PREDICTION_BATCH, properties, writers)
    write_jdbc(historic, url, historic_table, HISTORIC_BATCH, properties, writers)
