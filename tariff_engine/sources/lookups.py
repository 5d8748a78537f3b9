"""Lookup tables built from parameters (S4, S5) and inline product rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tariff_engine import schemas
from tariff_engine.params import DEFAULT_PARAMS, PricingParams


def _literal(value, dtype: T.DataType) -> str:
    if value is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    if isinstance(dtype, T.StringType):
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"CAST('{float(value)!r}' AS {dtype.simpleString()})"
    if isinstance(dtype, T.BooleanType):
        return "TRUE" if value else "FALSE"
    return f"CAST({int(value)} AS {dtype.simpleString()})"


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small literal table as an inline ``VALUES`` relation.

    Unlike ``createDataFrame`` (an RDD scan without statistics), the planner
    knows its exact row count and size, so joins against it are broadcast by
    Spark's own size check without running a job.
    """
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], schema)
    values = ", ".join("(" + ", ".join(_literal(v, f.dataType) for v, f in zip(r, schema.fields)) + ")"
                       for r in rows)
    names = ", ".join(f"`{f.name}`" for f in schema.fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def consumption_levels(spark: SparkSession, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """Reference consumption levels: energy_type, consumption_level_kwh (int), consumption_label."""
    return local_frame(spark, params.levels(), schemas.CONSUMPTION_LEVELS)


def margin_scenarios(spark: SparkSession, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """Margin scenarios: scenario, elec_margin_ct, gas_margin_ct (doubles)."""
    return local_frame(spark, params.scenarios(), schemas.MARGIN_SCENARIOS)


def products_from_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Raw product rows in the catalogue layout (``schemas.RAW_PRODUCTS``)."""
    return local_frame(spark, rows, schemas.RAW_PRODUCTS)
