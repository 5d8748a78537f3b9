"""Market analysis (E3): own offers ranked against matched competitor quotes.

Competitor quotes do not depend on the margin scenario, so the ceiling match,
the competitor costs and the segment profile are computed once, scenario-free,
and only the (small) own-offer side carries the scenario. The points that
competitors are matched to come from bands and products, not from the
components. See ``operators.ranking`` for how ranks are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariff_engine.functions import pricing as P
from tariff_engine.functions.numeric import round_half_away as rnd
from tariff_engine.operators.band_join import expand_levels
from tariff_engine.operators.ceiling_match import MATCHED_LEVEL, ceiling_levels, ceiling_match
from tariff_engine.operators.ranking import rank_own_offers
from tariff_engine.operators.staging import with_monthly_standing
from tariff_engine.params import DEFAULT_PARAMS, PricingParams

# The postcode first: sorts tell most rows apart by their first key.
SEGMENT = ["postcode", "energy_type", "consumption_level_kwh", "contract_length_months"]
POINT = SEGMENT + ["consumption_label"]
MATCH_KEYS = ["postcode", "energy_type", "contract_length_months"]
ENTITY = ["provider", "product_name"]
QUOTED_LEVEL = "quoted_level_kwh"
COST = "annual_cost_after_bonus_eur"

OFFER_COLUMNS = [
    "scenario", "elec_margin_ct", "gas_margin_ct", "energy_type", "postcode", "consumption_level_kwh",
    "consumption_label", "contract_length_months", "provider", "product", "unit_rate_ct_per_kwh",
    "standing_charge_eur_per_year", "signup_bonus_eur", COST, "is_own",
]

# Fixed names: the output columns of the analysis, in order.
ANALYSIS_COLUMNS = [
    "scenario", "margin_ct_per_kwh", "energy_type", "postcode", "consumption_label", "consumption_level_kwh",
    "contract_length_months", "provider", "product", "our_unit_rate_ct_per_kwh", "our_standing_charge_eur_per_year",
    "our_signup_bonus_eur", "our_annual_cost_after_bonus_eur", "our_rank", "total_offers", "cheaper_offers_count",
    "percentile_rank", "is_cheapest", "is_top_3", "avg_competitor_unit_rate_ct", "avg_competitor_annual_cost_eur",
    "min_competitor_annual_cost_eur", "delta_vs_cheapest_competitor_eur", "delta_rank_vs_standard",
]


# ---- own side ----------------------------------------------------------------------------

def own_offers(components: DataFrame, params: PricingParams = DEFAULT_PARAMS,
               scenario: str | None = None) -> DataFrame:
    """Components as offers (D15): gross ct rate, annual standing charge (2 dp), our label.

    ``scenario`` keeps one scenario only (P9).
    """
    if scenario is not None:
        components = components.where(F.col("scenario") == F.lit(scenario))
    return components.select(
        "scenario", "elec_margin_ct", "gas_margin_ct", "energy_type", "postcode", "consumption_level_kwh",
        "consumption_label", "contract_length_months",
        F.lit(params.own_provider).alias("provider"),
        F.col("product_name").alias("product"),
        (F.col("gross_unit_rate_eur_per_kwh") * F.lit(100.0)).alias("unit_rate_ct_per_kwh"),
        rnd(F.col("gross_standing_charge_eur_per_month") * F.lit(12.0), 2).alias("standing_charge_eur_per_year"),
        "signup_bonus_eur",
        COST,
        F.lit(True).alias("is_own"),
    )


def segment_points(components: DataFrame) -> DataFrame:
    """Distinct own segment points per scenario (A3)."""
    return components.select("scenario", *POINT).distinct()


def market_points(bands: DataFrame, products: DataFrame, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """Distinct segment points of every scenario, from the bands and the contract lengths that are sold.

    The same points as those of the components, but without prices, scenarios and submission bands.
    """
    sold = products.select("energy_type", "contract_length_months")
    return expand_levels(bands, params).join(sold, "energy_type").select(*POINT).distinct()


# ---- competitor side -----------------------------------------------------------------------

def relevant_quotes(quotes: DataFrame) -> DataFrame:
    """Quotes with the level column renamed for the match."""
    return quotes.withColumnRenamed("consumption_level_kwh", QUOTED_LEVEL)


def ceiling_matches(quotes: DataFrame, points: DataFrame) -> DataFrame:
    """(point, provider, product) -> smallest quoted level >= the reference level."""
    return ceiling_levels(relevant_quotes(quotes), points, MATCH_KEYS, ENTITY, QUOTED_LEVEL, "consumption_level_kwh")


def competitor_offers(matched_quotes: DataFrame) -> DataFrame:
    """Matched quotes priced at the reference level (D14), scenario-free."""
    return matched_quotes.withColumn(COST, P.quote_annual_cost(
        F.col("unit_rate_ct_per_kwh"), F.col("consumption_level_kwh"), F.col("standing_charge_eur_per_year"),
        F.col("signup_bonus_eur")))


def competitors_at_levels(quotes: DataFrame, points: DataFrame, copies: bool = True) -> DataFrame:
    """Every distinct quote at its ceiling level for every point, with its annual cost.

    ``quotes`` are typed base columns; ``copies`` says whether they may hold copies.
    """
    matched = ceiling_match(
        relevant_quotes(quotes), points, MATCH_KEYS, ENTITY, QUOTED_LEVEL, "consumption_level_kwh", copies)
    return competitor_offers(with_monthly_standing(matched.drop(MATCHED_LEVEL)))


def all_offers(components: DataFrame, quotes: DataFrame, points: DataFrame,
               params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """Own and competitor offers per scenario in one table.

    Competitor rows repeat once per scenario, as the scenario-keyed ranking
    needs; the analysis itself never materialises this union.
    """
    comp = competitors_at_levels(quotes, points)
    scenarios = F.array(*[F.struct(F.lit(n).alias("scenario")) for n, _, _ in params.scenarios()])
    comp_rows = comp.select(
        F.inline(scenarios),
        F.lit(None).cast("double").alias("elec_margin_ct"),
        F.lit(None).cast("double").alias("gas_margin_ct"),
        "energy_type", "postcode", "consumption_level_kwh", "consumption_label", "contract_length_months",
        "provider",
        F.col("product_name").alias("product"),
        "unit_rate_ct_per_kwh",
        rnd(F.col("standing_charge_eur_per_year"), 2).alias("standing_charge_eur_per_year"),
        "signup_bonus_eur", COST,
        F.lit(False).alias("is_own"),
    )
    return own_offers(components, params).select(*OFFER_COLUMNS).unionByName(comp_rows.select(*OFFER_COLUMNS))


# ---- ranking -------------------------------------------------------------------------------

def ranked_own_offers(components: DataFrame, quotes: DataFrame, points: DataFrame,
                      params: PricingParams = DEFAULT_PARAMS, copies: bool = True) -> DataFrame:
    """Own offers with rank, segment size and the competitor context of their segment (W4, W5, W7 inputs)."""
    competitors = competitors_at_levels(quotes, points, copies)
    return rank_own_offers(own_offers(components, params), competitors, SEGMENT, "scenario", COST, "unit_rate_ct_per_kwh")


def with_rank_metrics(ranked: DataFrame, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """cheaper count, percentile, cheapest and top-k flags."""
    rank, total = F.col("offer_rank"), F.col("offers_in_segment")
    return ranked.withColumns({
        "cheaper_offers_count": rank - F.lit(1),
        "percentile_rank": P.percentile_rank(rank, total),
        "is_cheapest": rank == F.lit(1),
        "is_top_3": rank <= F.lit(params.top_k),
    })


def with_market_context(ranked: DataFrame) -> DataFrame:
    """Competitor averages and the gap to the cheapest competitor (W7), NULL without competitors."""
    return ranked.withColumns({
        "avg_competitor_unit_rate_ct": rnd(F.col("avg_competitor_rate"), 2),
        "avg_competitor_annual_cost_eur": rnd(F.col("avg_competitor_cost"), 2),
        "min_competitor_annual_cost_eur": rnd(F.col("min_competitor_cost"), 2),
        "delta_vs_cheapest_competitor_eur": rnd(F.col(COST) - F.col("min_competitor_cost"), 2),
    })


# Fixed names: what identifies an own offer across scenarios.
BASELINE_KEYS = ["postcode", "energy_type", "product", "consumption_level_kwh", "contract_length_months"]


def with_delta_vs_baseline(ranked: DataFrame, params: PricingParams = DEFAULT_PARAMS) -> DataFrame:
    """Rank change against the baseline scenario for the same product name and segment.

    Same rows as a left join of the offers to the baseline offers on
    (energy type, product name, postcode, level, contract), written as a
    window so the ranked offers are not computed twice: the baseline ranks of
    the key group are collected (a group holds at most scenarios x products
    sharing a name) and exploded, so a repeated product name fans out exactly
    as the join would, and a missing baseline leaves one row with NULL.
    """
    keys = Window.partitionBy(*[F.col(c) for c in BASELINE_KEYS])
    baseline_ranks = F.collect_list(
        F.when(F.col("scenario") == F.lit(params.baseline_scenario), F.col("offer_rank"))).over(keys)
    return (ranked.withColumn("_baseline_ranks", baseline_ranks)
            .withColumn("_baseline_rank", F.explode_outer("_baseline_ranks"))
            .withColumn("delta_rank_vs_standard", F.col("offer_rank") - F.col("_baseline_rank"))
            .drop("_baseline_ranks", "_baseline_rank"))


def market_analysis(components: DataFrame, quotes: DataFrame, points: DataFrame,
                    params: PricingParams = DEFAULT_PARAMS, copies: bool = True) -> DataFrame:
    """One row per own offer and scenario with its market position."""
    ranked = ranked_own_offers(components, quotes, points, params, copies)
    full = with_delta_vs_baseline(with_market_context(with_rank_metrics(ranked, params)), params)
    return full.select(
        "scenario",
        P.scenario_margin_ct(F.col("energy_type"), F.col("elec_margin_ct"), F.col("gas_margin_ct"))
        .alias("margin_ct_per_kwh"),
        "energy_type", "postcode", "consumption_label", "consumption_level_kwh", "contract_length_months",
        "provider", "product",
        F.col("unit_rate_ct_per_kwh").alias("our_unit_rate_ct_per_kwh"),
        F.col("standing_charge_eur_per_year").alias("our_standing_charge_eur_per_year"),
        F.col("signup_bonus_eur").alias("our_signup_bonus_eur"),
        F.col(COST).alias("our_annual_cost_after_bonus_eur"),
        F.col("offer_rank").alias("our_rank"),
        F.col("offers_in_segment").alias("total_offers"),
        "cheaper_offers_count", "percentile_rank", "is_cheapest", "is_top_3",
        "avg_competitor_unit_rate_ct", "avg_competitor_annual_cost_eur", "min_competitor_annual_cost_eur",
        "delta_vs_cheapest_competitor_eur", "delta_rank_vs_standard",
    )


#: The order of the mart's rows, and that of its export.
ANALYSIS_ORDER = ["energy_type", "postcode", "consumption_level_kwh", "scenario"]
EXPORT_ORDER = ["energy_type", "product", "postcode", "consumption_level_kwh", "scenario"]
