"""The model through files and catalog tables: CSV inputs, quarantined lines, stored quotes, views, exports read back.

Everything is written below the shared folder (``shared.new_path``) and read through explicit schemas.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariff_engine import schemas, sinks
from tariff_engine.operators.staging import QUOTE_BASE_COLUMNS
from tariff_engine.plans import market
from tariff_engine.plans.marts import build_marts
from tariff_engine.plans.model import PricingModel, register_views
from tariff_engine.shared import new_path
from tariff_engine.sources import files
from tariff_engine.sources.driver_tables import PricingInputs

#: Buckets of stored quotes: those that one provider and product quotes at one level in one postcode share one.
STORED_KEYS = [*market.MATCH_KEYS, *market.ENTITY, "consumption_level_kwh"]


def _spark(model: PricingModel) -> SparkSession:
    return model.inputs.quotes.sparkSession


def _new_name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


# ---- sources -------------------------------------------------------------------------------

def inputs_through_csv(model: PricingModel) -> PricingInputs:
    """The raw inputs written as CSV with headers and read back by the file sources."""
    spark = _spark(model)
    read = {"cost_bands": files.read_cost_bands, "products": files.read_products, "quotes": files.read_quotes}
    schema = {"cost_bands": schemas.RAW_COST_BANDS, "products": schemas.RAW_PRODUCTS, "quotes": schemas.RAW_QUOTES}
    found = {}
    for name, reader in read.items():
        path = new_path(spark, f"raw-{name}")
        getattr(model.inputs, name).select(*schema[name].names).write.option("header", "true").csv(path)
        found[name] = reader(spark, path)
    return PricingInputs(**found)


def analysis_from_csv(model: PricingModel) -> DataFrame:
    return PricingModel(inputs_through_csv(model), model.params).market_analysis


#: Which quotes reach the file with a price that is no number, and which without their last columns.
BAD_PRICE = "consumption_level_kwh = 2000 AND standing_charge_eur_per_year % 7 = 3"
CUT_LINE = "consumption_level_kwh = 3500 AND standing_charge_eur_per_year % 5 = 1"


def quote_lines(quotes: DataFrame) -> DataFrame:
    """The quotes as lines of a CSV file, some of them broken."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schemas.RAW_QUOTES.names]
    price = schemas.RAW_QUOTES.names.index("unit_rate_ct_per_kwh")
    broken = [F.lit("on request") if k == price else c for k, c in enumerate(columns)]
    line = lambda cells: F.concat_ws(",", *cells)
    return quotes.select(
        F.when(F.expr(BAD_PRICE), line(broken)).when(F.expr(CUT_LINE), line(columns[:price])).otherwise(line(columns)).alias("value"))


def quarantine(model: PricingModel) -> tuple[DataFrame, DataFrame]:
    """Good quotes and bad lines of files in which some lines are broken (S3)."""
    spark = _spark(model)
    path = new_path(spark, "quotes-with-bad-lines")
    quote_lines(model.inputs.quotes).write.text(path)
    return files.read_with_quarantine(spark, path, schemas.RAW_QUOTES, header=False)


def quarantine_counts(model: PricingModel) -> DataFrame:
    """Per kind of line and energy type: how many lines, and what the good ones' levels add up to."""
    good, bad = quarantine(model)
    cells = F.split(files.RAW_LINE, ",")
    kind = F.when(F.col(files.RAW_LINE).contains("on request"), "bad price").otherwise("cut line")
    lines = good.select(F.lit("good").alias("kind"), "energy_type", "consumption_level_kwh").unionByName(
        bad.select(kind.alias("kind"), cells[0].alias("energy_type"), F.lit(None).cast("int").alias("consumption_level_kwh")))
    return lines.groupBy("kind", "energy_type").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("consumption_level_kwh").alias("good_kwh"))


QUARANTINE_SQL = f"""
SELECT kind, energy_type, COUNT(*) AS n_lines,
       CAST(SUM(CASE WHEN kind = 'good' THEN consumption_level_kwh END) AS BIGINT) AS good_kwh
FROM (SELECT *, CASE WHEN {BAD_PRICE} THEN 'bad price' WHEN {CUT_LINE} THEN 'cut line' ELSE 'good' END AS kind FROM raw_quotes)
GROUP BY kind, energy_type"""


# ---- stored quotes -------------------------------------------------------------------------

def store_quotes(model: PricingModel, table: str, path: str, buckets: int | None = None) -> DataFrame:
    """The staged quotes as a catalog table in buckets of `STORED_KEYS`, at least as many as a shuffle has partitions.

    The ceiling match joins these quotes in place: neither the dedupe nor the join back shuffles them.
    """
    spark = _spark(model)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return sinks.write_bucketed(model.quotes, table, path, STORED_KEYS, buckets)


def competitors_from_stored(model: PricingModel, stored: DataFrame) -> DataFrame:
    """Every stored quote at its ceiling level, with its annual cost.

    Quotes of contract lengths that are not sold drop out in the join back; a join before it could only move the quotes.
    """
    return market.competitors_at_levels(stored.select(*QUOTE_BASE_COLUMNS), model.points, copies=False)


# ---- sinks ---------------------------------------------------------------------------------

def price_list_file(model: PricingModel) -> DataFrame:
    """The price list's export, read back from its files."""
    path = sinks.export_price_list(model.price_list, new_path(_spark(model), "price-lists"))
    return files.read_price_list_export(_spark(model), path)


def analysis_file(model: PricingModel) -> DataFrame:
    """The market analysis' export, read back from its files."""
    path = sinks.export_market_analysis(model.market_analysis, new_path(_spark(model), "market-analysis"))
    return files.read_market_analysis(_spark(model), path)


def summary_file(model: PricingModel) -> DataFrame:
    """The performance summary's export, read back from its files."""
    path = sinks.export_summary(model.performance_summary(), new_path(_spark(model), "performance-summary"))
    return files.read_performance_summary(_spark(model), path)


def summary_from_views(model: PricingModel) -> DataFrame:
    """The performance summary from the catalog view that a whole build of the marts leaves behind."""
    spark = _spark(model)
    prefix = _new_name("marts") + "_"
    build_marts(spark, model.inputs, new_path(spark, "marts"), model.params, export_csv=False, view_prefix=prefix)
    return spark.table(prefix + "performance_summary")


def write_pass_quality(model: PricingModel) -> DataFrame:
    """The not-null and accepted-values rows of the report that a whole build collects while it writes (Q1, Q3)."""
    spark = _spark(model)
    paths = build_marts(spark, model.inputs, new_path(spark, "marts"), model.params, export_csv=False)
    return spark.read.parquet(paths["quality_report"]).where("test IN ('not_null', 'accepted_values')")


def stored_quote_costs(model: PricingModel) -> DataFrame:
    """Competitor costs from quotes that are stored in buckets."""
    stored = store_quotes(model, _new_name("stored_quotes"), new_path(_spark(model), "stored-quotes"))
    return competitors_from_stored(model, stored)


def market_by_sql(model: PricingModel) -> DataFrame:
    """Spark SQL over the model's views."""
    prefix = _new_name("views") + "_"
    register_views(_spark(model), model, prefix)
    return _spark(model).sql(f"""
        SELECT s.scenario, a.energy_type, l.consumption_label, COUNT(*) AS n_offers, SUM(a.our_rank) AS sum_rank,
               COUNT_IF(a.is_cheapest) AS n_cheapest, MAX(s.gas_margin_ct) AS gas_margin_ct
        FROM {prefix}market_analysis a
        JOIN {prefix}margin_scenarios s ON s.scenario = a.scenario
        JOIN {prefix}consumption_levels l ON l.energy_type = a.energy_type AND l.consumption_level_kwh = a.consumption_level_kwh
        GROUP BY s.scenario, a.energy_type, l.consumption_label""")


MARKET_BY_SQL = """
SELECT s.scenario, a.energy_type, l.consumption_label, COUNT(*) AS n_offers, CAST(SUM(a.our_rank) AS BIGINT) AS sum_rank,
       COUNT(*) FILTER (a.is_cheapest) AS n_cheapest, MAX(s.gas_margin_ct) AS gas_margin_ct
FROM market_analysis a JOIN scenarios s ON s.scenario = a.scenario
JOIN levels l ON l.energy_type = a.energy_type AND l.consumption_level_kwh = a.consumption_level_kwh
GROUP BY s.scenario, a.energy_type, l.consumption_label"""
