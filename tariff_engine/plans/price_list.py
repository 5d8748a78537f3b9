"""Price list (E2): the baseline scenario's components as contiguous submission bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariff_engine.functions import pricing as P
from tariff_engine.functions.numeric import round_half_away as rnd
from tariff_engine.params import DEFAULT_PARAMS, PricingParams

PRICE_LIST_COLUMNS = [
    "consumption_level_kwh", "consumption_label", "energy_type", "product_name", "postcode", "town",
    "consumption_from", "consumption_to", "unit_rate_gross_ct_per_kwh", "standing_charge_gross_eur_per_month",
    "signup_bonus", "contract_length", "price_guarantee", "unit_rate_net_ct_per_kwh",
    "basecost_unit_rate_ct_per_kwh", "procurement_unit_rate_ct_per_kwh", "margin_ct_per_kwh", "annual_gross_eur",
    "annual_gross_at_from_eur", "annual_margin_eur",
]

EXPORT_COLUMNS = [
    "energy_type", "product_name", "postcode", "town", "consumption_from", "consumption_to",
    "unit_rate_gross_ct_per_kwh", "standing_charge_gross_eur_per_month", "signup_bonus", "contract_length",
    "price_guarantee",
]
#: The order of the mart's rows, and that of its export.
PRICE_LIST_ORDER = ["energy_type", "product_name", "postcode", "consumption_level_kwh"]
EXPORT_ORDER = ["energy_type", "product_name", "postcode", "consumption_from"]


def with_annual_margin(components: DataFrame, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """Adds ``annual_margin_eur``."""
    return components.withColumn("annual_margin_eur", P.annual_margin(
        F.col("margin_eur_per_kwh"), F.col("consumption_level_kwh"), P.standing_margin(F.col("energy_type"), params),
        F.col("signup_bonus_eur"), F.col("lead_cost_eur"), F.col("expected_customer_life_time_years")))


def price_list(components_with_bands: DataFrame, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """Rounded price list rows of the baseline scenario (sorting happens at the sink).

    The filter only matters for components of all scenarios; the model expands the baseline alone.
    """
    ct = F.lit(100.0)
    baseline = components_with_bands.where(F.col("scenario") == F.lit(params.baseline_scenario))
    base = with_annual_margin(baseline, params)
    return base.select(
        "consumption_level_kwh",
        "consumption_label",
        "energy_type",
        "product_name",
        "postcode",
        "town",
        F.col("pcw_consumption_from").alias("consumption_from"),
        F.col("pcw_consumption_to").alias("consumption_to"),
        rnd(F.col("gross_unit_rate_eur_per_kwh") * ct, 4).alias("unit_rate_gross_ct_per_kwh"),
        rnd(F.col("gross_standing_charge_eur_per_month"), 2).alias("standing_charge_gross_eur_per_month"),
        rnd(F.col("signup_bonus_eur"), 2).alias("signup_bonus"),
        F.col("contract_length_months").alias("contract_length"),
        F.col("price_guarantee_months").alias("price_guarantee"),
        rnd(F.col("net_unit_rate_eur_per_kwh") * ct, 4).alias("unit_rate_net_ct_per_kwh"),
        rnd(F.col("basecost_net_unit_rate_eur_per_kwh") * ct, 4).alias("basecost_unit_rate_ct_per_kwh"),
        rnd(F.col("procurement_cost_eur_per_kwh") * ct, 4).alias("procurement_unit_rate_ct_per_kwh"),
        rnd(F.col("margin_eur_per_kwh") * ct, 4).alias("margin_ct_per_kwh"),
        rnd(F.col("annual_gross_eur"), 2).alias("annual_gross_eur"),
        rnd(F.col("annual_gross_at_from_eur"), 2).alias("annual_gross_at_from_eur"),
        rnd(F.col("annual_margin_eur"), 2).alias("annual_margin_eur"),
    )


def price_list_export(price_list_df: DataFrame) -> DataFrame:
    """The 11 submission columns in submission order."""
    return price_list_df.select(*EXPORT_COLUMNS).orderBy(*EXPORT_ORDER)
