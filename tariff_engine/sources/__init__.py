"""Sources: file readers, parameter lookups and the benchmark-table mapping."""

from tariff_engine.sources.driver_tables import PricingInputs, load_inputs
from tariff_engine.sources.files import read_cost_bands, read_market_analysis, read_products, read_quotes
from tariff_engine.sources.lookups import consumption_levels, margin_scenarios, products_from_rows

__all__ = [
    "PricingInputs", "consumption_levels", "load_inputs", "margin_scenarios", "products_from_rows",
    "read_cost_bands", "read_market_analysis", "read_products", "read_quotes",
]
