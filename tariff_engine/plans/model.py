"""The whole model wired together for one input set and one parameter set.

Every attribute is a lazy DataFrame without caches: building one runs no job,
and filters and column pruning reach the scans through all of them.
``marts.build_marts`` writes the marts, whose readers then start from files;
the query catalog picks single frames out of the model.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tariff_engine.operators.staging import QUOTE_BASE_COLUMNS, project_quotes, stage_cost_bands, stage_products, stage_quotes
from tariff_engine.params import DEFAULT_PARAMS, PricingParams
from tariff_engine.plans import market
from tariff_engine.plans.components import COMPONENT_COLUMNS, price_components_with_bands
from tariff_engine.plans.price_list import price_list
from tariff_engine.plans.summary import heatmap_matrix, performance_summary
from tariff_engine.sources.driver_tables import PricingInputs, load_inputs
from tariff_engine.sources.lookups import consumption_levels, margin_scenarios


class PricingModel:
    def __init__(self, inputs: PricingInputs, params: PricingParams = DEFAULT_PARAMS,
                 staged: Mapping[str, DataFrame] | None = None):
        """``staged`` holds frames that are read instead of derived: ``cost_bands``, ``products`` or ``quotes``, as staged."""
        self.inputs = inputs
        self.params = params
        self.staged = dict(staged or {})

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, params: PricingParams = DEFAULT_PARAMS,
                    dirty: bool = False) -> "PricingModel":
        return cls(load_inputs(spark, sf_dir, dirty), params)

    # staging
    @cached_property
    def cost_bands(self) -> DataFrame:
        if "cost_bands" in self.staged:
            return self.staged["cost_bands"]
        return stage_cost_bands(self.inputs.cost_bands, self.params)

    @cached_property
    def products(self) -> DataFrame:
        if "products" in self.staged:
            return self.staged["products"]
        return stage_products(self.inputs.products)

    @cached_property
    def quotes(self) -> DataFrame:
        if "quotes" in self.staged:
            return self.staged["quotes"]
        return stage_quotes(self.inputs.quotes, self.params)

    @cached_property
    def market_quotes(self) -> DataFrame:
        """Typed quotes for the contract lengths we sell (the market analysis needs no others).

        Copies are included unless the quotes come staged: the ceiling match removes them after it has dropped the
        quotes that serve no point.
        """
        sold = self.products.select("contract_length_months")
        if "quotes" in self.staged:
            typed = self.quotes.select(*QUOTE_BASE_COLUMNS)
        else:
            typed = project_quotes(self.inputs.quotes, self.params)
        return typed.join(sold, "contract_length_months", "left_semi")

    @property
    def copies(self) -> bool:
        """Whether ``market_quotes`` may hold copies."""
        return "quotes" not in self.staged

    @cached_property
    def points(self) -> DataFrame:
        return market.market_points(self.cost_bands, self.products, self.params)

    # intermediate
    @cached_property
    def components_with_bands(self) -> DataFrame:
        return price_components_with_bands(self.cost_bands, self.products, self.params)

    @cached_property
    def components(self) -> DataFrame:
        return self.components_with_bands.select(*COMPONENT_COLUMNS)

    # marts
    @cached_property
    def price_list(self) -> DataFrame:
        """From components of the baseline scenario alone: no other one is expanded."""
        baseline = price_components_with_bands(self.cost_bands, self.products, self.params, self.params.baseline_scenario)
        return price_list(baseline, self.params)

    @cached_property
    def market_analysis(self) -> DataFrame:
        return market.market_analysis(self.components, self.market_quotes, self.points, self.params, self.copies)

    def performance_summary(self, analysis: DataFrame | None = None) -> DataFrame:
        return performance_summary(self.market_analysis if analysis is None else analysis)

    def heatmap_matrix(self, analysis: DataFrame | None = None) -> DataFrame:
        return heatmap_matrix(self.market_analysis if analysis is None else analysis)


def register_views(spark: SparkSession, model: PricingModel, prefix: str = "") -> list[str]:
    """Expose the staging, intermediate, lookup and mart frames as temporary views.

    Views stay lazy: ``spark.sql`` over them plans against the same DataFrames,
    so filters and column pruning still reach the scans.
    """
    frames = {
        "cost_bands": model.cost_bands,
        "products": model.products,
        "quotes": model.quotes,
        "price_components": model.components,
        "price_list": model.price_list,
        "market_analysis": model.market_analysis,
        "performance_summary": model.performance_summary(),
        "consumption_levels": consumption_levels(spark, model.params),
        "margin_scenarios": margin_scenarios(spark, model.params),
    }
    names = []
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
