"""Column-level functions: rounding, text normalisation and the pricing formulas."""

from tariff_engine.functions.numeric import exact_average, exact_parts, exact_total, round_half_away, safe_div
from tariff_engine.functions.pricing import (
    annual_gross,
    annual_margin,
    break_even_kwh,
    by_energy,
    capped_bonus,
    effective_margin,
    gross_standing_monthly,
    gross_unit_rate,
    net_unit_rate,
    percentile_rank,
    quote_annual_cost,
    scenario_margin_ct,
    standing_margin,
    target_bonus,
)
from tariff_engine.functions.text import contract_months, norm_postcode

__all__ = [
    "annual_gross", "annual_margin", "break_even_kwh", "by_energy", "capped_bonus", "contract_months",
    "effective_margin", "exact_average", "exact_parts", "exact_total", "gross_standing_monthly", "gross_unit_rate",
    "net_unit_rate", "norm_postcode", "percentile_rank", "quote_annual_cost", "round_half_away", "safe_div",
    "scenario_margin_ct", "standing_margin", "target_bonus",
]
