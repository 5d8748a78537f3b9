"""Pricing formulas as Spark column expressions (all JVM-side, codegen'd).

Each function is one line of the pricing model; the plans in
``tariff_engine.plans`` compose them. Argument order mirrors the arithmetic
order so that results are bit-identical to the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariff_engine.functions.numeric import round_half_away, safe_div
from tariff_engine.params import DEFAULT_PARAMS, ELECTRICITY, PricingParams


def by_energy(energy_type: Column, electricity: Column, other: Column) -> Column:
    """Electricity value for ELECTRICITY, the gas value for every other energy type."""
    return F.when(energy_type == F.lit(ELECTRICITY), electricity).otherwise(other)


def scenario_margin_ct(energy_type: Column, elec_margin_ct: Column, gas_margin_ct: Column) -> Column:
    """Configured scenario margin in ct/kWh, unfloored (as shown in the market analysis)."""
    return by_energy(energy_type, elec_margin_ct, gas_margin_ct)


def effective_margin(energy_type: Column, elec_margin_ct: Column, gas_margin_ct: Column,
                     floor_eur: float = DEFAULT_PARAMS.margin_floor_eur_per_kwh) -> Column:
    """Margin in EUR/kWh, never below the floor (no loss-leader prices)."""
    per_kwh = by_energy(energy_type, elec_margin_ct / F.lit(100.0), gas_margin_ct / F.lit(100.0))
    return F.greatest(per_kwh, F.lit(float(floor_eur)))


def net_unit_rate(basecost: Column, procurement: Column, margin: Column) -> Column:
    return basecost + procurement + margin


def gross_unit_rate(net_rate: Column, vat_rate: Column) -> Column:
    return net_rate * (F.lit(1.0) + vat_rate)


def standing_margin(energy_type: Column, params: PricingParams) -> Column:
    return by_energy(energy_type,
                     F.lit(float(params.electricity_standing_charge_margin_eur_per_year)),
                     F.lit(float(params.gas_standing_charge_margin_eur_per_year)))


def target_bonus(energy_type: Column, params: PricingParams) -> Column:
    return by_energy(energy_type,
                     F.lit(float(params.electricity_signup_bonus_eur)),
                     F.lit(float(params.gas_signup_bonus_eur)))


def gross_standing_monthly(standing_per_year: Column, margin_per_year: Column, vat_rate: Column) -> Column:
    """(net standing charge + standing margin) incl. VAT, per month."""
    return (standing_per_year + margin_per_year) * (F.lit(1.0) + vat_rate) / F.lit(12.0)


def annual_gross(gross_rate: Column, kwh: Column, standing_monthly: Column) -> Column:
    """Annual gross price at ``kwh`` consumption."""
    return gross_rate * kwh + standing_monthly * F.lit(12.0)


def capped_bonus(target: Column, annual_gross_at_from: Column, cap_share: float) -> Column:
    """Target bonus, capped at ``cap_share`` of the annual gross at the band's lower bound."""
    return F.least(target, annual_gross_at_from * F.lit(float(cap_share)))


def annual_margin(margin_eur: Column, kwh: Column, standing_margin_year: Column,
                  bonus: Column, lead_cost: Column, lifetime_years: Column) -> Column:
    """First-year margin per customer after amortised bonus and lead cost; NULL for zero lifetime."""
    return margin_eur * kwh + standing_margin_year - safe_div(bonus + lead_cost, lifetime_years)


def quote_annual_cost(unit_rate_ct: Column, kwh: Column, standing_per_year: Column, bonus: Column) -> Column:
    """Competitor annual cost at ``kwh``: quotes are gross already."""
    return unit_rate_ct / F.lit(100.0) * kwh + standing_per_year - bonus


def percentile_rank(rank: Column, total: Column) -> Column:
    """Share of the other offers that are cheaper, in percent, 1 dp; NULL for a lone offer."""
    return round_half_away(F.lit(100.0) * (rank - F.lit(1)) / F.nullif(total - F.lit(1), F.lit(0)), 1)


def break_even_kwh(standing_a: Column, bonus_a: Column, rate_a_ct: Column,
                   standing_b: Column, bonus_b: Column, rate_b_ct: Column) -> Column:
    """Consumption at which offers A and B cost the same; NULL for equal unit rates."""
    return safe_div(standing_a - standing_b + bonus_b - bonus_a, (rate_b_ct - rate_a_ct) / F.lit(100.0))
