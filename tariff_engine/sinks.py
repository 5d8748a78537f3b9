"""Sinks: marts as sorted parquet tables behind views, stored quotes as bucketed tables, and the CSV exports.

Marts and exports are sorted with a global ``orderBy`` (range partitioned), so the part files are in order one after
another, and a filter on the leading columns rules out most files and row groups by their statistics; no single
task has to hold the whole output. ``single_file=True`` gives one CSV for small marts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tariff_engine.plans.market import ANALYSIS_COLUMNS
from tariff_engine.plans.market import EXPORT_ORDER as ANALYSIS_ORDER
from tariff_engine.plans.price_list import price_list_export
from tariff_engine.plans.summary import SUMMARY_ORDER


def write_mart(df: DataFrame, path: str, order_by: Sequence[str] = (),
               watch: Callable[[DataFrame], DataFrame] = lambda df: df) -> str:
    """Write a mart as a parquet table to a path of its own, sorted by ``order_by`` over all its files.

    ``watch`` may add metrics of the write. They come after the sort, whose sampling would count rows twice.
    """
    watch(df.orderBy(*order_by) if order_by else df).write.parquet(path)
    return path


def new_version(root: str) -> str:
    """A folder under ``root`` for one run's marts: live marts are never written to."""
    return f"{root.rstrip('/')}/version={uuid.uuid4().hex}"


def publish(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """Let the catalog views of these names read the marts at these paths.

    Call it when all of a run's marts are written: until then, and if the run fails, readers of the views see the
    marts of the run before. Replacing a view is one atomic change of the catalog.
    """
    for name, path in paths.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """A catalog table bucketed and sorted by ``keys``: joins and aggregates on these keys read it without an exchange.

    Rows are shuffled by the buckets' own hash first, so each bucket is one file.
    """
    keys = list(keys)
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)


def _csv(df: DataFrame, path: str, single_file: bool) -> str:
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def export_price_list(price_list_df: DataFrame, path: str, single_file: bool = False) -> str:
    """Submission columns, ordered by energy type, product, postcode, band start."""
    return _csv(price_list_export(price_list_df), path, single_file)


def export_market_analysis(analysis: DataFrame, path: str, single_file: bool = False) -> str:
    """All columns, ordered by energy type, product, postcode, level and scenario."""
    return _csv(analysis.select(*ANALYSIS_COLUMNS).orderBy(*ANALYSIS_ORDER), path, single_file)


def export_summary(summary: DataFrame, path: str, single_file: bool = False) -> str:
    """All columns with an explicit order instead of relying on table order."""
    return _csv(summary.orderBy(*SUMMARY_ORDER), path, single_file)
