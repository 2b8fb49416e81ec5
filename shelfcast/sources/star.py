"""Sales and promotions from a star schema of line items, parts, suppliers and places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.schema import MONEY


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical sales: the supplier's nation is the store, its region the city, the brand the product.

    Returned lines carry a negative quantity. No join is hinted. Each dimension is joined as a bare
    scan, so that Spark decides by its real file size: below the threshold it is broadcast, beyond it
    sort-merged, with AQE splitting hot keys.
    """
    line = _table(spark, sf_dir, "lineitem")
    part = _table(spark, sf_dir, "part")
    supplier = _table(spark, sf_dir, "supplier")
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("l_shipdate").cast("date").alias("sale_date"),
            F.col("n_name").alias("store"),
            F.col("r_name").alias("city"),
            F.lpad(F.col("l_suppkey").cast("string"), 5, "0").alias("postal_code"),
            F.when(F.col("p_size") > 25, "LARGE GOODS").otherwise("SMALL GOODS").alias("super_division"),
            F.col("p_type").alias("product_division"),
            F.col("p_brand").alias("business_unit"),
            signed.cast("bigint").alias("quantity"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
        )
    )


def promotions_from_star(spark: SparkSession, sf_dir: str, least: float = 0.09) -> DataFrame:
    """Promotion calendar: the lines sold at a discount of ``least`` or more."""
    line = _table(spark, sf_dir, "lineitem").filter(F.col("l_discount") >= least)
    part = _table(spark, sf_dir, "part")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("business_unit"),
        F.col("l_shipdate").cast("date").alias("sale_date"),
        F.col("l_discount").alias("discount_amount"),
    )
