"""Spark-native tariff pricing and market-position engine."""

from tariff_engine.params import DEFAULT_PARAMS, PricingParams

__all__ = ["DEFAULT_PARAMS", "PricingParams"]
