"""Price components (E1): cost bands x products x scenarios x reference levels.

Plan shape:

* the collapsed bands (one partial + final aggregate over the raw bands)
  explode the reference levels they contain: a narrow ``Generate``, no join;
* the band-edge windows (lowest tier, next tier, top band end) run on these
  band-level rows, partitioned by (energy_type, postcode) -- before the
  product and scenario fan-out, so one small shuffle serves all three windows
  and the price list's window needs no further exchange;
* products join on energy_type, without a hint: the planner broadcasts the
  catalogue by its statistics (exact for a literal one) and shuffles beyond;
* scenarios come from the parameters and explode in place; a caller that needs
  one scenario gets only that one expanded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariff_engine.functions import pricing as P
from tariff_engine.operators.band_join import expand_levels
from tariff_engine.params import DEFAULT_PARAMS, PricingParams

COMPONENT_COLUMNS = [
    "scenario", "elec_margin_ct", "gas_margin_ct", "product_code", "product_name", "energy_type", "postcode",
    "town", "consumption_from", "consumption_to", "basecost_net_unit_rate_eur_per_kwh",
    "procurement_cost_eur_per_kwh", "margin_eur_per_kwh", "basecost_net_standing_charge_eur_per_year", "vat_rate",
    "lead_cost_eur", "expected_customer_life_time_years", "price_guarantee_months", "contract_length_months",
    "net_unit_rate_eur_per_kwh", "gross_unit_rate_eur_per_kwh", "gross_standing_charge_eur_per_month",
    "target_signup_bonus_eur", "consumption_level_kwh", "consumption_label", "annual_gross_eur",
    "pcw_consumption_from", "annual_gross_at_from_eur", "signup_bonus_eur", "annual_cost_after_bonus_eur",
]


def band_levels(bands: DataFrame, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """Bands with the reference levels they contain and the submission band edges.

    ``pcw_consumption_from``: the band's lower bound for the lowest matched
    level of the postcode, else the level itself (D8). ``pcw_consumption_to``:
    next matched level - 1, or the largest matched band end for the top level
    (D12). Both depend only on (energy_type, postcode), not on product or scenario.
    """
    group = Window.partitionBy("energy_type", "postcode")
    ordered = group.orderBy("consumption_level_kwh", "consumption_from", "consumption_to")
    level = F.col("consumption_level_kwh")
    return (
        expand_levels(bands, params)
        .withColumn("pcw_consumption_from",
                    F.when(level == F.min(level).over(group), F.col("consumption_from")).otherwise(level))
        .withColumn("pcw_consumption_to",
                    F.coalesce(F.lead(level).over(ordered) - F.lit(1), F.max("consumption_to").over(group)))
    )


def _scenario_rows(params: PricingParams, only: str | None):
    return F.array(*[
        F.struct(F.lit(name).alias("scenario"), F.lit(elec).alias("elec_margin_ct"), F.lit(gas).alias("gas_margin_ct"))
        for name, elec, gas in params.scenarios() if only in (None, name)
    ])


def price_components_with_bands(bands: DataFrame, products: DataFrame, params: PricingParams = DEFAULT_PARAMS,
                                scenario: str | None = None) -> DataFrame:
    """All component columns plus ``pcw_consumption_to`` for the price list, of all scenarios or of one.

    The formulas are composed as column expressions and applied in one
    projection (Catalyst shares the common sub-expressions).
    """
    energy = F.col("energy_type")
    margin = P.effective_margin(energy, F.col("elec_margin_ct"), F.col("gas_margin_ct"),
                                params.margin_floor_eur_per_kwh)
    net = P.net_unit_rate(F.col("basecost_net_unit_rate_eur_per_kwh"), F.col("procurement_cost_eur_per_kwh"), margin)
    gross = P.gross_unit_rate(net, F.col("vat_rate"))
    standing = P.gross_standing_monthly(F.col("basecost_net_standing_charge_eur_per_year"),
                                        P.standing_margin(energy, params), F.col("vat_rate"))
    target = P.target_bonus(energy, params)
    at_level = P.annual_gross(gross, F.col("consumption_level_kwh"), standing)
    at_from = P.annual_gross(gross, F.col("pcw_consumption_from"), standing)
    bonus = P.capped_bonus(target, at_from, params.bonus_cap_share)
    derived = {
        "margin_eur_per_kwh": margin,
        "net_unit_rate_eur_per_kwh": net,
        "gross_unit_rate_eur_per_kwh": gross,
        "gross_standing_charge_eur_per_month": standing,
        "target_signup_bonus_eur": target,
        "annual_gross_eur": at_level,
        "annual_gross_at_from_eur": at_from,
        "signup_bonus_eur": bonus,
        "annual_cost_after_bonus_eur": at_level - bonus,
    }
    fanned_out = (
        band_levels(bands, params)
        .join(products, "energy_type", "inner")
        .select("*", F.inline(_scenario_rows(params, scenario)))
    )
    return fanned_out.select(
        *[derived[c].alias(c) if c in derived else F.col(c) for c in COMPONENT_COLUMNS], "pcw_consumption_to")


def price_components(bands: DataFrame, products: DataFrame, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """One row per (scenario, product, postcode, band, reference level) with every price component."""
    return price_components_with_bands(bands, products, params).select(*COMPONENT_COLUMNS)
