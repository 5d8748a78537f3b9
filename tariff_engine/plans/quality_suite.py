"""The model's data-quality suite (Q1-Q5) as Spark jobs.

Each suite returns one report row per test: (model, test, column_name,
failing_rows), where ``failing_rows`` is the number of records the check
returns (NULL rows, duplicated values or keys, unaccepted values, rows
below the margin floor). Zero means the test passes.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariff_engine.operators import quality as Q
from tariff_engine.params import ENERGY_TYPES, SCENARIO_NAMES
from tariff_engine.plans.model import PricingModel
from tariff_engine.sources.lookups import consumption_levels, local_frame, margin_scenarios

REPORT_COLUMNS = ["model", "test", "column_name", "failing_rows"]

# The columns each model declares NOT NULL.
NOT_NULL = {
    "cost_bands": ["energy_type", "postcode", "town", "consumption_from", "consumption_to",
                   "basecost_net_unit_rate_eur_per_kwh", "basecost_net_standing_charge_eur_per_year"],
    "products": ["product_code", "product_name", "energy_type", "expected_customer_life_time_years",
                 "lead_cost_eur", "vat_rate", "procurement_cost_ct_per_kwh", "procurement_cost_eur_per_kwh",
                 "price_guarantee_months", "contract_length_months"],
    "quotes": ["energy_type", "postcode", "location_name", "consumption_level_kwh", "provider", "product_name",
               "unit_rate_ct_per_kwh", "standing_charge_eur_per_year", "standing_charge_eur_per_month",
               "signup_bonus_eur", "price_guarantee_months", "contract_length_months"],
    "consumption_levels": ["energy_type", "consumption_level_kwh", "consumption_label"],
    "margin_scenarios": ["scenario", "elec_margin_ct", "gas_margin_ct"],
    "price_components": ["scenario", "elec_margin_ct", "gas_margin_ct", "product_code", "product_name",
                         "energy_type", "postcode", "consumption_from", "consumption_to",
                         "basecost_net_unit_rate_eur_per_kwh", "procurement_cost_eur_per_kwh",
                         "basecost_net_standing_charge_eur_per_year", "vat_rate", "lead_cost_eur",
                         "expected_customer_life_time_years", "price_guarantee_months", "contract_length_months",
                         "net_unit_rate_eur_per_kwh", "gross_unit_rate_eur_per_kwh",
                         "gross_standing_charge_eur_per_month", "target_signup_bonus_eur", "consumption_level_kwh",
                         "consumption_label", "annual_gross_eur", "signup_bonus_eur", "annual_cost_after_bonus_eur"],
    "price_list": ["energy_type", "consumption_level_kwh", "consumption_label", "product_name", "postcode",
                   "consumption_from", "consumption_to", "unit_rate_gross_ct_per_kwh",
                   "standing_charge_gross_eur_per_month", "signup_bonus", "contract_length", "price_guarantee"],
    "performance_summary": ["scenario", "energy_type", "product", "consumption_label", "consumption_level_kwh",
                            "contract_length_months"],
    "market_analysis": ["scenario", "energy_type", "postcode", "consumption_level_kwh", "contract_length_months"],
}

# Declared unique keys (single column and column combinations).
UNIQUE = {
    "products": ["product_code"],
    "margin_scenarios": ["scenario"],
    "price_components.products": ["product_code"],
    "price_components.scenarios": ["scenario"],
}
UNIQUE_COMBO = {
    "cost_bands": [["energy_type", "postcode", "consumption_from"]],
    "quotes": [["energy_type", "postcode", "provider", "product_name", "consumption_level_kwh",
                "contract_length_months"]],
    "consumption_levels": [["energy_type", "consumption_level_kwh"]],
    "price_components": [["scenario", "product_code", "postcode", "consumption_level_kwh"]],
    "price_list": [["energy_type", "product_name", "postcode", "consumption_level_kwh"]],
    "performance_summary": [["scenario", "energy_type", "product", "consumption_level_kwh",
                             "contract_length_months"]],
    "market_analysis": [["scenario", "energy_type", "product", "postcode", "consumption_level_kwh",
                         "contract_length_months"]],
}
ACCEPTED = {
    "cost_bands": [("energy_type", ENERGY_TYPES)],
    "products": [("energy_type", ENERGY_TYPES)],
    "quotes": [("energy_type", ENERGY_TYPES)],
    "consumption_levels": [("energy_type", ENERGY_TYPES)],
    "margin_scenarios": [("scenario", SCENARIO_NAMES)],
    "price_list": [("energy_type", ENERGY_TYPES)],
}

PRODUCT_DIMENSION = ["product_code", "product_name", "energy_type", "vat_rate", "lead_cost_eur",
                     "expected_customer_life_time_years", "procurement_cost_eur_per_kwh", "price_guarantee_months",
                     "contract_length_months"]


def model_frames(model: PricingModel, components: DataFrame | None = None,
                 analysis: DataFrame | None = None) -> dict[str, DataFrame]:
    """What the suite checks, by name; ``components`` and ``analysis`` may be the written marts instead of the model's."""
    components = model.components if components is None else components
    spark = model.inputs.quotes.sparkSession
    analysis = model.market_analysis if analysis is None else analysis
    return {
        "cost_bands": model.cost_bands,
        "products": model.products,
        "quotes": model.quotes,
        "consumption_levels": consumption_levels(spark, model.params),
        "margin_scenarios": margin_scenarios(spark, model.params),
        "price_components": components,
        "price_components.products": components.select(*PRODUCT_DIMENSION).distinct(),
        "price_components.scenarios": components.select("scenario", "elec_margin_ct", "gas_margin_ct").distinct(),
        "price_list": model.price_list,
        "performance_summary": model.performance_summary(analysis),
        "market_analysis": analysis,
    }


def _count(failing: DataFrame, model: str, test: str, column: str) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(column).alias("column_name"), "failing_rows")


def not_null_report(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [
        Q.check_not_null(frames[m], cols, m).select("model", F.lit("not_null").alias("test"), "column_name",
                                                      "failing_rows")
        for m, cols in NOT_NULL.items() if m in frames
    ]
    return reduce(DataFrame.unionByName, parts)


def write_pass_report(spark: SparkSession, checks: Q.WriteChecks, frames: Mapping[str, DataFrame]) -> DataFrame:
    """The not-null and accepted-values rows, from the metrics of the models' writes.

    Models that were not written (the literal lookups) are checked as they are, and so is a column with unaccepted
    values, of which the different ones have to be counted. All other rows need no scan.
    """
    rows, parts = [], []
    for model, columns in NOT_NULL.items():
        if model in checks.models:
            rows += [(model, "not_null", c, n) for c, n in checks.nulls(model)]
        else:
            parts.append(not_null_report({model: frames[model]}))
    for model, tests in ACCEPTED.items():
        found = dict(checks.unaccepted(model)) if model in checks.models else {}
        for column, values in tests:
            if found.get(column) == 0:
                rows.append((model, "accepted_values", column, 0))
            else:
                parts.append(_count(Q.check_accepted_values(frames[model], column, values, model), model, "accepted_values", column))
    report = local_frame(spark, rows, T.StructType([
        T.StructField("model", T.StringType()), T.StructField("test", T.StringType()),
        T.StructField("column_name", T.StringType()), T.StructField("failing_rows", T.LongType())]))
    return reduce(DataFrame.unionByName, [report, *parts])


def unique_report(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [_count(Q.check_unique(frames[m], c, m), m, "unique", c) for m, cols in UNIQUE.items() for c in cols]
    return reduce(DataFrame.unionByName, parts)


def unique_combo_report(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [_count(Q.check_unique_combo(frames[m], cols, m), m, "unique_combination", ",".join(cols))
             for m, combos in UNIQUE_COMBO.items() for cols in combos]
    return reduce(DataFrame.unionByName, parts)


def accepted_values_report(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [_count(Q.check_accepted_values(frames[m], c, vals, m), m, "accepted_values", c)
             for m, tests in ACCEPTED.items() for c, vals in tests]
    return reduce(DataFrame.unionByName, parts)


def margin_floor_report(components: dict[str, DataFrame]) -> DataFrame:
    """Rows below the margin floor, for each named set of components."""
    parts = [_count(Q.check_margin_floor(c), name, "margin_floor", "net_unit_rate_eur_per_kwh,margin_eur_per_kwh")
             for name, c in components.items()]
    return reduce(DataFrame.unionByName, parts)
