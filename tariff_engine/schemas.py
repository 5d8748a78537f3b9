"""Explicit schemas for every raw input and exported mart.

CSV inputs are never read with ``inferSchema``: a postcode such as ``01067``
must stay a string, and a duration such as ``12 Monate`` is text.
"""

from pyspark.sql import types as T

RAW_COST_BANDS = T.StructType([
    T.StructField("energy_type", T.StringType()),
    T.StructField("postcode", T.StringType()),
    T.StructField("town", T.StringType()),
    T.StructField("consumption_from", T.IntegerType()),
    T.StructField("consumption_to", T.IntegerType()),
    T.StructField("basecost_net_unit_rate_eur_per_kwh", T.DoubleType()),
    T.StructField("basecost_net_standing_charge_eur_per_year", T.DoubleType()),
])

RAW_PRODUCTS = T.StructType([
    T.StructField("product_code", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("energy_type", T.StringType()),
    T.StructField("expected_customer_life_time", T.DoubleType()),
    T.StructField("lead_cost", T.DoubleType()),
    T.StructField("vat", T.DoubleType()),
    T.StructField("net_procurement_cost_ct_per_kwh", T.DoubleType()),
    T.StructField("price_guarantee_months", T.IntegerType()),
    T.StructField("contract_length_months", T.IntegerType()),
])

RAW_QUOTES = T.StructType([
    T.StructField("energy_type", T.StringType()),
    T.StructField("postcode", T.StringType()),
    T.StructField("location_name", T.StringType()),
    T.StructField("consumption_level_kwh", T.IntegerType()),
    T.StructField("provider", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("unit_rate_ct_per_kwh", T.DoubleType()),
    T.StructField("standing_charge_eur_per_year", T.DoubleType()),
    T.StructField("signup_bonus", T.DoubleType()),
    T.StructField("price_guarantee_months", T.IntegerType()),
    T.StructField("contract_length_months", T.StringType()),
])

CONSUMPTION_LEVELS = T.StructType([
    T.StructField("energy_type", T.StringType(), False),
    T.StructField("consumption_level_kwh", T.IntegerType(), False),
    T.StructField("consumption_label", T.StringType(), False),
])

MARGIN_SCENARIOS = T.StructType([
    T.StructField("scenario", T.StringType(), False),
    T.StructField("elec_margin_ct", T.DoubleType(), False),
    T.StructField("gas_margin_ct", T.DoubleType(), False),
])

MARKET_ANALYSIS = T.StructType([
    T.StructField("scenario", T.StringType()),
    T.StructField("margin_ct_per_kwh", T.DoubleType()),
    T.StructField("energy_type", T.StringType()),
    T.StructField("postcode", T.StringType()),
    T.StructField("consumption_label", T.StringType()),
    T.StructField("consumption_level_kwh", T.IntegerType()),
    T.StructField("contract_length_months", T.IntegerType()),
    T.StructField("provider", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("our_unit_rate_ct_per_kwh", T.DoubleType()),
    T.StructField("our_standing_charge_eur_per_year", T.DoubleType()),
    T.StructField("our_signup_bonus_eur", T.DoubleType()),
    T.StructField("our_annual_cost_after_bonus_eur", T.DoubleType()),
    T.StructField("our_rank", T.LongType()),
    T.StructField("total_offers", T.LongType()),
    T.StructField("cheaper_offers_count", T.LongType()),
    T.StructField("percentile_rank", T.DoubleType()),
    T.StructField("is_cheapest", T.BooleanType()),
    T.StructField("is_top_3", T.BooleanType()),
    T.StructField("avg_competitor_unit_rate_ct", T.DoubleType()),
    T.StructField("avg_competitor_annual_cost_eur", T.DoubleType()),
    T.StructField("min_competitor_annual_cost_eur", T.DoubleType()),
    T.StructField("delta_vs_cheapest_competitor_eur", T.DoubleType()),
    T.StructField("delta_rank_vs_standard", T.LongType()),
])

PRICE_LIST_EXPORT = T.StructType([
    T.StructField("energy_type", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("postcode", T.StringType()),
    T.StructField("town", T.StringType()),
    T.StructField("consumption_from", T.IntegerType()),
    T.StructField("consumption_to", T.IntegerType()),
    T.StructField("unit_rate_gross_ct_per_kwh", T.DoubleType()),
    T.StructField("standing_charge_gross_eur_per_month", T.DoubleType()),
    T.StructField("signup_bonus", T.DoubleType()),
    T.StructField("contract_length", T.IntegerType()),
    T.StructField("price_guarantee", T.IntegerType()),
])

PERFORMANCE_SUMMARY = T.StructType([
    T.StructField("scenario", T.StringType()),
    T.StructField("energy_type", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("consumption_label", T.StringType()),
    T.StructField("consumption_level_kwh", T.IntegerType()),
    T.StructField("contract_length_months", T.IntegerType()),
    T.StructField("margin_ct_per_kwh", T.DoubleType()),
    T.StructField("total_market_segments", T.LongType()),
    T.StructField("segments_where_cheapest", T.LongType()),
    T.StructField("segments_where_top_3", T.LongType()),
    T.StructField("pct_cheapest", T.DoubleType()),
    T.StructField("pct_top_3", T.DoubleType()),
    T.StructField("avg_rank", T.DoubleType()),
    T.StructField("avg_percentile", T.DoubleType()),
    T.StructField("avg_delta_vs_cheapest_eur", T.DoubleType()),
    T.StructField("avg_our_annual_cost_eur", T.DoubleType()),
    T.StructField("avg_market_annual_cost_eur", T.DoubleType()),
])
