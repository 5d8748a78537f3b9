"""File sources with explicit schemas.

CSV for the small seed-style inputs, parquet for quotes at scale. Both are
plain ``spark.read`` scans, so filters and column pruning reach the reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariff_engine import schemas
from tariff_engine.shared import written

#: The column that holds the text of a line that does not fit the schema.
RAW_LINE = "raw_line"


def _read(spark: SparkSession, path: str, schema, fmt: str | None, mode: str) -> DataFrame:
    """``mode`` says what a malformed CSV number does: FAILFAST ends the job, PERMISSIVE makes it NULL.

    A NULL reaches the not-null checks, but a quote with a NULL key leaves the market, so FAILFAST is the default.
    :func:`read_with_quarantine` keeps the good rows and sets the bad lines aside.
    """
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if fmt == "csv":
        return spark.read.schema(schema).option("header", "true").option("mode", mode).csv(path)
    return spark.read.schema(schema).format(fmt).load(path)


def read_with_quarantine(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines) of a CSV source.

    A line with a value that does not fit its type, or with more or fewer values than the schema, is a bad line:
    its whole text is in ``raw_line``, with the ``source_file`` that it came from. All other lines are good rows of ``schema``.
    Lines are parsed once, into a table in the shared folder, from which both are read.
    """
    parsed = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(RAW_LINE, T.StringType())]))
        .option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_LINE).csv(path)
    )
    table = written(parsed.select("*", F.col("_metadata.file_path").alias("source_file")), "parsed-lines")
    good = table.where(F.col(RAW_LINE).isNull()).select(*schema.names)
    return good, table.where(F.col(RAW_LINE).isNotNull()).select("source_file", RAW_LINE)


def read_cost_bands(spark: SparkSession, path: str, fmt: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Regional cost bands: one row per energy type, postcode and consumption band."""
    return _read(spark, path, schemas.RAW_COST_BANDS, fmt, mode)


def read_products(spark: SparkSession, path: str, fmt: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Own product catalogue."""
    return _read(spark, path, schemas.RAW_PRODUCTS, fmt, mode)


def read_quotes(spark: SparkSession, path: str, fmt: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Competitor quotes snapshot; the contract length stays text until staging."""
    return _read(spark, path, schemas.RAW_QUOTES, fmt, mode)


def read_market_analysis(spark: SparkSession, path: str, fmt: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """An exported market-analysis mart, read back with postcodes kept as text."""
    return _read(spark, path, schemas.MARKET_ANALYSIS, fmt, mode)


def read_price_list_export(spark: SparkSession, path: str, fmt: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """An exported price list, read back with postcodes kept as text."""
    return _read(spark, path, schemas.PRICE_LIST_EXPORT, fmt, mode)


def read_performance_summary(spark: SparkSession, path: str, fmt: str | None = None, mode: str = "FAILFAST") -> DataFrame:
    """An exported performance summary."""
    return _read(spark, path, schemas.PERFORMANCE_SUMMARY, fmt, mode)
