"""Staging operators: typed projections, band collapse and quote dedupe."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariff_engine.functions.text import contract_months, norm_postcode
from tariff_engine.params import DEFAULT_PARAMS, PricingParams

COST_BAND_COLUMNS = [
    "energy_type", "postcode", "town", "consumption_from", "consumption_to",
    "basecost_net_unit_rate_eur_per_kwh", "basecost_net_standing_charge_eur_per_year",
]

# What makes two quotes copies of each other; the monthly standing charge is derived.
QUOTE_BASE_COLUMNS = [
    "energy_type", "postcode", "location_name", "consumption_level_kwh", "provider", "product_name",
    "unit_rate_ct_per_kwh", "standing_charge_eur_per_year", "signup_bonus_eur", "price_guarantee_months",
    "contract_length_months",
]


def stage_cost_bands(raw: DataFrame, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """Collapse bands that share a rate and standing charge into one band (A1).

    Grouping is on the exact rate values, so a rate that returns after a
    different one yields one wide band overlapping the other; that is kept.
    The aggregate runs partial (map-side) first, so even a postcode holding a
    third of all raw rows reaches the shuffle as a handful of rows per task.
    """
    return (
        raw.groupBy(
            F.col("energy_type"),
            norm_postcode(F.col("postcode"), params.postcode_width).alias("postcode"),
            F.col("town"),
            F.col("basecost_net_unit_rate_eur_per_kwh").cast("double").alias("basecost_net_unit_rate_eur_per_kwh"),
            F.col("basecost_net_standing_charge_eur_per_year").cast("double")
            .alias("basecost_net_standing_charge_eur_per_year"),
        )
        .agg(F.min(F.col("consumption_from").cast("int")).alias("consumption_from"),
             F.max(F.col("consumption_to").cast("int")).alias("consumption_to"))
        .select(*COST_BAND_COLUMNS)
    )


def stage_products(raw: DataFrame) -> DataFrame:
    """Typed, renamed product catalogue with procurement cost in EUR/kWh."""
    procurement_ct = F.col("net_procurement_cost_ct_per_kwh").cast("double")
    return raw.select(
        "product_code",
        "product_name",
        "energy_type",
        F.col("expected_customer_life_time").cast("double").alias("expected_customer_life_time_years"),
        F.col("lead_cost").cast("double").alias("lead_cost_eur"),
        F.col("vat").cast("double").alias("vat_rate"),
        procurement_ct.alias("procurement_cost_ct_per_kwh"),
        (procurement_ct / F.lit(100.0)).alias("procurement_cost_eur_per_kwh"),
        F.col("price_guarantee_months").cast("int").alias("price_guarantee_months"),
        F.col("contract_length_months").cast("int").alias("contract_length_months"),
    )


def project_quotes(raw: DataFrame, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """Typed base columns of the quotes with parsed contract months, copies included."""
    return raw.select(
        "energy_type",
        norm_postcode(F.col("postcode"), params.postcode_width).alias("postcode"),
        "location_name",
        F.col("consumption_level_kwh").cast("int").alias("consumption_level_kwh"),
        "provider",
        F.col("product").alias("product_name"),
        F.col("unit_rate_ct_per_kwh").cast("double").alias("unit_rate_ct_per_kwh"),
        F.col("standing_charge_eur_per_year").cast("double").alias("standing_charge_eur_per_year"),
        F.col("signup_bonus").cast("double").alias("signup_bonus_eur"),
        F.col("price_guarantee_months").cast("int").alias("price_guarantee_months"),
        contract_months(F.col("contract_length_months"), params).alias("contract_length_months"),
    )


def with_monthly_standing(quotes: DataFrame) -> DataFrame:
    return quotes.withColumn("standing_charge_eur_per_month", F.col("standing_charge_eur_per_year") / F.lit(12.0))


def stage_quotes(raw: DataFrame, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """Typed quotes, exact duplicate rows removed (A2).

    The dedupe groups on every base column, so the shuffle hashes all of them: one provider or postcode
    dominating the snapshot still spreads over many tasks, and copies collapse map-side before the exchange.
    """
    return with_monthly_standing(project_quotes(raw, params).dropDuplicates())
