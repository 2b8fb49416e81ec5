"""Typed readers. A path may be any URI Spark can open; credentials come in through ``options``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfcast.fixed_values import RAW_COLUMNS, RAW_PROMO_COLUMNS
from shelfcast.schema import SALES
from shelfcast.session import materialise

_CORRUPT = "_corrupt_line"


#: Read one after the other, after ISO dates; a date with slashes has its month first unless its year is.
DATE_FORMATS = ("d.M.yyyy", "M/d/yyyy", "yyyy/M/d")


def parsed_date(source: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The date a text names in ISO form or in one of ``formats``; null if none fits."""
    text = F.trim(source)
    tried = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats]
    return F.coalesce(text.try_cast(T.DateType()), *tried)


def _parsed(
    source: Column, was: T.DataType, wanted: T.DataType, formats: Sequence[str] = DATE_FORMATS
) -> Column:
    if isinstance(was, T.StringType) and isinstance(wanted, T.DateType):
        return parsed_date(source, formats)
    if isinstance(was, T.StringType) and isinstance(wanted, T.LongType):
        # "2.0" is a whole number too; a plain string-to-bigint cast would reject it.
        return source.try_cast(T.DecimalType(24, 4)).cast(wanted)
    if isinstance(was, T.StringType):
        return source.try_cast(wanted)
    return source.cast(wanted)


def _sources(df: DataFrame, mapping: Mapping[str, str]) -> dict[str, str]:
    """By canonical name, the column that it is read from."""
    source = {new: old for old, new in mapping.items() if old in df.columns}
    return source | {c: c for c in SALES.names if c in df.columns and c not in source}


def canonicalise(
    df: DataFrame,
    mapping: Mapping[str, str] = RAW_COLUMNS,
    keep: tuple[str, ...] = (),
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Pick, rename and type the sales columns; a canonical column without a source becomes null.

    So does a value that cannot be typed; ``rejected_rows`` has the rows with such values.
    """
    source = _sources(df, mapping)
    columns = []
    for field in SALES:
        if field.name in source:
            raw = source[field.name]
            value = _parsed(F.col(f"`{raw}`"), df.schema[raw].dataType, field.dataType, date_formats)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns, *keep)


def rejected_rows(
    df: DataFrame,
    mapping: Mapping[str, str] = RAW_COLUMNS,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Raw rows that hold a value ``canonicalise`` cannot type, with ``rejected``, the names of such columns.

    A null or blank value is missing, not rejected.
    """
    return df.withColumn("rejected", _rejected(df, mapping, date_formats)).filter(F.size("rejected") > 0)


def _rejected(df: DataFrame, mapping: Mapping[str, str], date_formats: Sequence[str]) -> Column:
    found = []
    for field in SALES:
        raw = _sources(df, mapping).get(field.name)
        if raw is not None:
            value = F.col(f"`{raw}`")
            typed = _parsed(value, df.schema[raw].dataType, field.dataType, date_formats)
            bad = (F.trim(value.cast("string")) != "") & typed.isNull()
            found.append(F.when(bad, F.lit(field.name)))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def typed_and_rejected(
    df: DataFrame,
    mapping: Mapping[str, str] = RAW_COLUMNS,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> tuple[DataFrame, DataFrame]:
    """The frames of ``canonicalise`` and ``rejected_rows`` from one scan of ``df``.

    The typed rows are written once to the checkpoint folder, and beside a row with a rejected value the raw row. A
    row with a rejected value stays among the typed ones, with null for that value.
    """
    marked = df.withColumn("_rejected", _rejected(df, mapping, date_formats))
    marked = marked.withColumn("_bad", F.size("_rejected") > 0)
    raw = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    kept = marked.withColumn("_raw", F.when(F.col("_bad"), raw))
    written = materialise(canonicalise(kept, mapping, ("_bad", "_rejected", "_raw"), date_formats))
    rejects = written.filter("_bad").select("_raw.*", F.col("_rejected").alias("rejected"))
    return written.select(*SALES.names), rejects


def read_raw(
    spark: SparkSession, path: str, fmt: str = "csv", options: Mapping[str, str] | None = None
) -> DataFrame:
    """A file as it is; CSV as text with a header, never inferred."""
    reader = spark.read.options(**(options or {}))
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)


def read_sales(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    mapping: Mapping[str, str] = RAW_COLUMNS,
    keep: tuple[str, ...] = (),
    options: Mapping[str, str] | None = None,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Sales in canonical form. CSV is read as text with a header and typed here, never inferred."""
    return canonicalise(read_raw(spark, path, fmt, options), mapping, keep, date_formats)


def read_dimension(
    spark: SparkSession,
    path: str,
    sep: str = ";",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Delimited dimension of text columns. Lines with too many fields are skipped, short ones padded."""
    options = dict(options or {})
    header = spark.read.options(**options).option("header", True).option("sep", sep).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, _CORRUPT)])
    # The whole line has to be parsed for the field count to be seen, hence no parser-side pruning.
    lines = (
        spark.read.options(**options)
        .schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("columnPruning", False)
        .csv(path)
    )
    fields = F.size(F.split(F.col(_CORRUPT), f"\\Q{sep}\\E", -1))
    # Always true, and needs every column: Spark refuses a scan of the corrupt-line column alone,
    # which a mere count would otherwise be reduced to.
    parsed = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in header])) >= 0
    whole = F.col(_CORRUPT).isNull() | (fields <= len(header))
    return lines.filter(parsed & whole).drop(_CORRUPT)


def read_promotions(
    spark: SparkSession,
    path: str,
    options: Mapping[str, str] | None = None,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Promotion calendar: product, date, discount."""
    raw = spark.read.options(**(options or {})).option("header", True).csv(path)
    source = {new: old for old, new in RAW_PROMO_COLUMNS.items() if old in raw.columns}
    return raw.select(
        F.col(f"`{source['business_unit']}`").alias("business_unit"),
        parsed_date(F.col(f"`{source['sale_date']}`"), date_formats).alias("sale_date"),
        F.col(f"`{source['discount_amount']}`").try_cast(T.DoubleType()).alias("discount_amount"),
    )
