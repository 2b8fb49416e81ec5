"""Canonical column names and types shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = ("store", "business_unit")
ATTRIBUTES = ("city", "super_division", "product_division")
MEASURES = ("quantity", "amount")

MONEY = T.DecimalType(18, 2)

SALES = T.StructType(
    [
        T.StructField("sale_date", T.DateType()),
        T.StructField("store", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("super_division", T.StringType()),
        T.StructField("product_division", T.StringType()),
        T.StructField("business_unit", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("amount", MONEY),
    ]
)

FORECAST = T.StructType(
    [
        T.StructField("ds", T.DateType()),
        T.StructField("store", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("super_division", T.StringType()),
        T.StructField("product_division", T.StringType()),
        T.StructField("business_unit", T.StringType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("yhat", T.DoubleType()),
        T.StructField("yhat_upper", T.DoubleType()),
        T.StructField("yhat_lower", T.DoubleType()),
        T.StructField("training_date", T.DateType()),
    ]
)
